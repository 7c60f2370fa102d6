import datetime as dt

from pyspark.sql import functions as F

from skyroll.functions.time import ntz
from skyroll.operators import upsert as U
from skyroll.schema import STATE_SCHEMA

T0 = dt.datetime(2024, 7, 1, 12, 0)


def test_latest_wins_null_overwrites_and_last_arrival(spark):
    df = spark.createDataFrame([("a", T0, 1, 10.0, 5), ("a", T0, 2, None, 6), ("b", T0, 3, 7.0, None)],
                               "station string, dt timestamp_ntz, arrival long, v double, w long")
    out = {r.station: r for r in U.latest_wins(df, ["station", "dt"], ["arrival"]).collect()}
    assert out["a"].v is None and out["a"].w == 6 and out["a"].arrival == 2
    assert out["b"].v == 7.0


def test_merge_upsert_batch_beats_stored(spark):
    stored = spark.createDataFrame([("a", T0, 100.0)], "station string, dt timestamp_ntz, v double")
    batch = spark.createDataFrame([("a", T0, 1, None), ("a", T0, 0, 5.0), ("c", T0, 2, 9.0)],
                                  "station string, dt timestamp_ntz, arrival long, v double")
    out = {r.station: r.v for r in U.merge_upsert(stored, batch, ["station", "dt"]).collect()}
    assert out == {"a": None, "c": 9.0}


def _obs(spark, rows):
    return spark.createDataFrame(rows, "arrival long, station string, dt timestamp_ntz, temps_avg_f double, "
                                       "vel_avg_mph double, dir_avg_deg long, hum_avg_pct double, "
                                       "pres_avg_pa long, lux_avg_lx long, rain_inc_in double")


def test_latest_ties_and_out_of_order(spark):
    later = T0 + dt.timedelta(minutes=5)
    obs = _obs(spark, [(1, "a", later, 1.0, 0.0, 1, 1.0, 101325, 5, 0.0),
                       (2, "a", T0, 2.0, 0.0, 1, 1.0, 101325, 5, 0.0),       # older dt after newer
                       (3, "b", T0, 3.0, 0.0, 1, 1.0, 100000, 5, 0.0),
                       (4, "b", T0, 4.0, 0.0, 1, 1.0, None, 5, 0.0)])        # equal dt, later arrival
    out = {r.station: r for r in U.latest_per_station(obs).collect()}
    assert out["a"].temperature == 1.0 and out["a"].dt == later
    assert out["b"].temperature == 4.0 and out["b"].pressure is None
    stored = U.latest_per_station(obs)
    batch = _obs(spark, [(9, "b", T0, 9.0, 0.0, 1, 1.0, 102000, 5, 0.0),    # equal dt replaces (>=)
                         (8, "a", T0, 8.0, 0.0, 1, 1.0, 102000, 5, 0.0)])   # older never replaces
    merged = {r.station: r for r in U.merge_latest(stored, batch).collect()}
    assert merged["b"].temperature == 9.0 and merged["b"].pressure == 1020.0
    assert merged["a"].temperature == 1.0


def _state(spark, rows):
    return spark.createDataFrame(rows, STATE_SCHEMA)


def test_consumer_and_producer_marks(spark):
    t1, t2 = T0, T0 + dt.timedelta(hours=1)
    state = _state(spark, [("a", None, t1, t2, None, 0, 5, "streaming", None),
                           ("z", t1, t1, t1, t1, 0, 1, "healthy", None)])
    batch = spark.createDataFrame([("a", t1, 10, 0, 10), ("a", t1, 11, 1, 11), ("n", t2, 12, 0, 12)],
                                  "station string, dt timestamp_ntz, arrival long, partition int, offset long")
    out = {r.station: r for r in U.consumer_marks(state, batch).collect()}
    assert out["a"].consumer_latest_ts == t2 and out["a"].database_latest_ts == t1
    assert (out["a"].kafka_partition, out["a"].kafka_offset, out["a"].status) == (1, 11, "streaming")
    assert out["z"].status == "healthy" and out["n"].status == "streaming" and out["n"].database_latest_ts == t2
    prod = {r.station: r for r in U.producer_marks(state, batch).collect()}
    assert prod["a"].producer_latest_ts == t1 and prod["n"].status == "unknown"


def test_reconciliation_status_cases(spark):
    t1, t2 = T0, T0 + dt.timedelta(hours=1)
    rows = [(None, None, None, t1), (t2, None, None, None), (t2, None, None, t1), (t1, t2, None, t2),
            (None, None, None, None)]
    df = spark.createDataFrame(rows, "s timestamp_ntz, p timestamp_ntz, c timestamp_ntz, d timestamp_ntz")
    got = [r[0] for r in df.select(U.reconciliation_status(F.col("s"), F.col("p"), F.col("c"), F.col("d"))).collect()]
    assert got == ["healthy", "database_empty", "database_gap_detected", "healthy", "database_empty"]


def test_reconcile_keeps_old_marks_when_new_null(spark):
    t1, t2 = T0, T0 + dt.timedelta(hours=1)
    state = _state(spark, [("a", t1, t1, t1, t1, 0, 5, "streaming", None)])
    observed = spark.createDataFrame([("a", t2, t1)], "station string, source_latest_ts timestamp_ntz, "
                                                      "database_latest_ts timestamp_ntz")
    r = U.reconcile_marks(state, observed, ntz("2024-08-01 00:00:00")).collect()[0]
    assert (r.source_latest_ts, r.producer_latest_ts, r.database_latest_ts) == (t2, t1, t1)
    assert r.status == "database_gap_detected" and r.last_reconciliation_at == dt.datetime(2024, 8, 1)
