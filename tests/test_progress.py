import datetime as dt

import pytest

from skyroll.operators import progress as P

MARK = dt.datetime(2024, 7, 3, 12, 0)


def _lines(spark, dts):
    rows = [("wx_a", d.strftime("%Y%m%d") + ".txt", i, '{"dt":"' + d.isoformat() + '"}') for i, d in enumerate(dts)]
    return spark.createDataFrame(rows, "station_dir string, file_name string, arrival long, line string")


def test_incremental_is_strict_and_prunes_files(spark):
    lines = _lines(spark, [MARK - dt.timedelta(days=3), MARK, MARK + dt.timedelta(seconds=1)])
    resume = spark.createDataFrame([("wx_a", MARK), ("wx_b", None)], "station string, resume_ts timestamp_ntz")
    got = sorted(r.dt for r in P.incremental_rows(lines, resume).collect())
    assert got == [MARK + dt.timedelta(seconds=1)]


def test_repair_window_inclusive_cutoff_and_skip(spark):
    cutoff = MARK - dt.timedelta(days=2)
    dts = [cutoff - dt.timedelta(microseconds=1), cutoff, MARK, MARK + dt.timedelta(hours=1)]
    lines = _lines(spark, dts)
    stored = spark.createDataFrame([("wx_a", MARK)], "station string, table_latest_ts timestamp_ntz")
    src = P.source_latest(lines)
    got = sorted(r.dt for r in P.backfill_rows(lines, stored, src).collect())
    assert got == [cutoff, MARK, MARK + dt.timedelta(hours=1)]
    current = spark.createDataFrame([("wx_a", MARK + dt.timedelta(hours=1))], "station string, table_latest_ts timestamp_ntz")
    assert P.backfill_rows(lines, current, src).count() == 0
    empty = spark.createDataFrame([], "station string, table_latest_ts timestamp_ntz")
    assert P.backfill_rows(lines, empty, src).count() == len(dts)


def test_status_marks_null_in_turn(spark):
    t1, t2 = MARK, MARK + dt.timedelta(seconds=90)
    rows = [("a", t2, t2, t2, t1), ("b", None, t2, t1, t1), ("c", None, None, None, t1), ("d", t2, None, None, None)]
    state = spark.createDataFrame(rows, "station string, source_latest_ts timestamp_ntz, producer_latest_ts timestamp_ntz, "
                                        "consumer_latest_ts timestamp_ntz, database_latest_ts timestamp_ntz")
    for c in ("kafka_partition int", "kafka_offset long", "status string", "last_reconciliation_at timestamp_ntz"):
        name, typ = c.split()
        from pyspark.sql import functions as F
        state = state.withColumn(name, F.lit(None).cast(typ))
    out = {r.station: r for r in P.ingestion_status(state).collect()}
    assert (out["a"].source_database_gap_seconds, out["a"].producer_consumer_gap_seconds, out["a"].requires_backfill) == (90, 0, True)
    assert (out["b"].source_database_gap_seconds, out["b"].producer_consumer_gap_seconds, out["b"].requires_backfill) == (0, 90, True)
    assert out["c"].requires_backfill is None
    assert out["d"].requires_backfill is True and out["d"].source_database_gap_seconds == 0


def _join_lines(plan_of):
    """Joins in a plan, with estimates that never broadcast by themselves."""
    plan = plan_of()._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Join " in line]


@pytest.fixture
def no_estimates(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_incremental_lines_stay_where_they_are(spark, no_estimates, monkeypatch):
    lines = _lines(spark, [MARK - dt.timedelta(days=3), MARK, MARK + dt.timedelta(seconds=1)])
    resume = spark.createDataFrame([("wx_a", MARK), ("wx_b", None)], "station string, resume_ts timestamp_ntz")
    joins = _join_lines(lambda: P.incremental_rows(lines, resume))
    assert len(joins) == 1 and "BroadcastHashJoin" in joins[0]
    few = sorted(map(str, P.incremental_rows(lines, resume).collect()))
    monkeypatch.setattr(P, "MAX_STATIONS", 0)
    assert sorted(map(str, P.incremental_rows(lines, resume).collect())) == few and len(few) == 1


def test_newest_and_repair_lines_stay_where_they_are(spark, no_estimates, monkeypatch):
    lines = _lines(spark, [MARK - dt.timedelta(days=3), MARK, MARK + dt.timedelta(seconds=1), MARK + dt.timedelta(days=1)])
    stored = spark.createDataFrame([("wx_a", MARK)], "station string, table_latest_ts timestamp_ntz")
    assert any("BroadcastHashJoin" in x and "LeftSemi" in x for x in _join_lines(lambda: P.source_latest(lines)))
    src = spark.createDataFrame([("wx_a", MARK + dt.timedelta(days=1))], "station string, source_latest_ts timestamp_ntz")
    joins = _join_lines(lambda: P.backfill_rows(lines, stored, src))
    assert sorted("BroadcastHashJoin" in x for x in joins) == [False, True]  # the other one is of marks
    few = sorted(map(str, P.source_latest(lines).collect())), sorted(map(str, P.backfill_rows(lines, stored, src).collect()))
    monkeypatch.setattr(P, "MAX_STATIONS", 0)
    many = sorted(map(str, P.source_latest(lines).collect())), sorted(map(str, P.backfill_rows(lines, stored, src).collect()))
    assert many == few and (len(few[0]), len(few[1])) == (1, 3)
