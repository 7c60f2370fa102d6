"""Live views = batch: shuffled micro-batches with ties, corrections, repeated and late rows."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from skyroll.operators import rollup as R
from skyroll.operators import upsert as U
from skyroll.operators.parse import good_rows, parse_lines
from skyroll.schema import LATEST_COLUMNS, ROLLUP_MEASURES, WINDOWS_BY_NAME
from skyroll.sources import testtables as tt
from skyroll.streaming import ingest as I
from skyroll.streaming.live import live_latest, live_rollup, read_changes, write_changes

SF = "/root/testdata/sf0.001"


@pytest.fixture
def feed(spark):
    """Kafka rows, a fifth of the readings corrected later, dealt over three files in no order, a third of them again;
    and their streaming observations."""
    work = tempfile.mkdtemp(prefix="skyroll-live-", dir="/tmp")
    events = tt.events(spark, SF)
    corrected = events.filter("event_id % 5 = 0").withColumn("event_id", F.col("event_id") + 97_000).withColumn("value", F.col("value") + 9)
    rows = tt.kafka_rows(events.unionByName(corrected)).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for i in range(3):
        part = rows.filter(F.pmod(F.hash("offset"), F.lit(3)) == i)
        part.unionByName(rows.filter(F.col("offset") % 9 == i)).orderBy(F.rand(seed=i)).coalesce(1).write.parquet(os.path.join(work, "src", f"p{i}"))
    stream = (spark.readStream.schema(I.KAFKA_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(os.path.join(work, "src")))

    def observations(df):
        return good_rows(parse_lines(df.select(F.col("value").cast("string").alias("line"), "offset"), keep=["offset"])).withColumn("arrival", F.col("offset"))

    return work, observations(stream), observations(rows)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_latest_state_equals_batch(spark, feed):
    work, stream, batch = feed
    out, ckpt = os.path.join(work, "latest"), os.path.join(work, "ckpt")
    write_changes(live_latest(stream), out, ckpt, {"availableNow": True}).awaitTermination(300)
    assert _rows(read_changes(spark, out, ["station"]), LATEST_COLUMNS) == _rows(U.latest_per_station(batch), LATEST_COLUMNS)

    # One more file touches two stations: one with an older reading, one with a correction of its latest.
    latest = {r.station: r.dt for r in U.latest_per_station(batch).collect()}
    first, second = sorted(latest)[:2]
    line = '{{"dt":"{}","station":"{}","temps_avg_f":-40.5}}'
    more = [(None, line.format((latest[first] - dt.timedelta(days=3)).isoformat(), first).encode(), "t", 0, 10**9, None),
            (None, line.format(latest[second].isoformat(), second).encode(), "t", 0, 10**9 + 1, None)]
    spark.createDataFrame(more, I.KAFKA_SCHEMA).coalesce(1).write.parquet(os.path.join(work, "src", "p9"))
    write_changes(live_latest(stream), out, ckpt, {"availableNow": True}).awaitTermination(300)
    batches = {}
    for r in spark.read.parquet(out).select("_batch", "station").collect():
        batches.setdefault(r["_batch"], set()).add(r.station)
    assert len(batches) == 4 and batches[max(batches)] == {first, second}
    now = {r.station: r for r in read_changes(spark, out, ["station"]).collect()}
    assert now[first].dt == latest[first] and now[first].temperature != -40.5
    assert now[second].dt == latest[second] and now[second].temperature == -40.5


def test_rollup_with_corrections_equals_batch(spark, feed):
    work, stream, batch = feed
    window = WINDOWS_BY_NAME["year"]
    out = os.path.join(work, "rollup")
    write_changes(live_rollup(stream, window, "3650 days"), out, os.path.join(work, "ckpt"), {"availableNow": True}).awaitTermination(300)
    got = {(r.bucket_ts, r.station): r for r in read_changes(spark, out, ["bucket_ts", "station"]).collect()}
    weather = U.latest_wins(batch, ["station", "dt"], ["arrival"])
    assert weather.count() < batch.select("arrival").distinct().count()  # there are corrections
    want = {(r.bucket_ts, r.station): r for r in R.rollup_window(weather, window, R.global_max(weather)).collect()}
    assert want and set(want) == set(got)
    for k, w in want.items():
        for c in ROLLUP_MEASURES:
            a, b = got[k][c], w[c]
            assert (a is None and b is None) or abs(a - b) < 1e-9


def test_rollup_drops_rows_behind_the_watermark_and_ends_their_state(spark):
    work = tempfile.mkdtemp(prefix="skyroll-live-", dir="/tmp")
    src, out, ckpt = (os.path.join(work, d) for d in ("src", "out", "ckpt"))
    window = WINDOWS_BY_NAME["year"]  # buckets of an hour
    schema = "station string, dt timestamp_ntz, arrival long, " + ", ".join(f"{m} double" for m in ROLLUP_MEASURES)

    def send(*readings):
        rows = [("a", dt.datetime(2024, 1, 1, h, m), n, *[v] * len(ROLLUP_MEASURES)) for h, m, n, v in readings]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        live = live_rollup(spark.readStream.schema(schema).parquet(src), window, "1 hour")
        q = write_changes(live, out, ckpt, {"availableNow": True})
        q.awaitTermination(300)
        return {r.bucket_ts.hour: (r.temps_avg_f, r.rain_inc_in) for r in read_changes(spark, out, ["bucket_ts", "station"]).collect()}, q

    now, _ = send((1, 0, 1, 1.0), (1, 30, 2, 3.0), (1, 59, 3, None))
    assert now == {1: (2.0, 4.0)}
    now, _ = send((1, 30, 5, 7.0), (1, 30, 4, 100.0))  # a correction, and one that is older though it comes with it
    assert now == {1: (4.0, 8.0)}
    now, _ = send((9, 0, 6, 1.0))
    assert now == {1: (4.0, 8.0), 9: (1.0, 1.0)}
    now, q = send((1, 0, 7, 50.0), (9, 1, 8, 2.0))  # hour 1 is closed
    assert now == {1: (4.0, 8.0), 9: (1.5, 3.0)}
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1
