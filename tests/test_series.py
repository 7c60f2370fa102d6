"""The chunked series helpers must equal plain per-series windows for any chunk width."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyroll.operators import series as S

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def samples(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(1500):
        key = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        ts = BASE + dt.timedelta(seconds=rnd.randint(0, 3 * 86400))
        rows.append((i, key, ts, rnd.randint(-3, 9) * 1.0, rnd.random() < 0.7))
    return spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double, flag boolean")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("chunk", [600, 3600, 86400 * 10])
def test_running_sum(samples, chunk):
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = _rows(samples.withColumn("rs", F.sum("v").over(w)), ["id", "rs"])
    got = _rows(S.running_sum(samples, ["k"], "ts", ["id"], "v", "rs", chunk), ["id", "rs"])
    assert got == want


@pytest.mark.parametrize("chunk", [600, 86400])
def test_previous_values(samples, chunk):
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = _rows(samples.withColumn("p_v", F.lag("v").over(w)).withColumn("p_id", F.lag("id").over(w)),
                 ["id", "p_v", "p_id"])
    got = _rows(S.previous_values(samples, ["k"], "ts", ["id"], ["v", "id"], "p_", chunk), ["id", "p_v", "p_id"])
    assert got == want


@pytest.mark.parametrize("chunk", [900, 7200])
def test_trailing_sum(samples, chunk):
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    w = Window.partitionBy("k").orderBy(us).rangeBetween(-600 * 1_000_000, 0)
    want = _rows(samples.withColumn("t", F.sum("v").over(w)), ["id", "t"])
    got = _rows(S.trailing_sum(samples, ["k"], "ts", "v", "t", 600, chunk), ["id", "t"])
    assert got == want


def test_global_series_running_sum(samples):
    w = Window.orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = _rows(samples.withColumn("rs", F.sum("v").over(w)), ["id", "rs"])
    got = _rows(S.running_sum(samples, [], "ts", ["id"], "v", "rs", 3600), ["id", "rs"])
    assert got == want


def test_hot_key_is_spread_across_tasks(spark):
    """One series holds 90% of rows; after the chunked window no task holds
    more than a small share of them (a plain partitionBy(series) would put
    90% of all rows into one task)."""
    rnd = random.Random(3)
    rows = [(i, "hot" if rnd.random() < 0.9 else rnd.choice(["a", "b"]),
             BASE + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)), 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = S.running_sum(df, ["k"], "ts", ["id"], "v", "rs", 3600)
        # Use ``rs`` so the window is not pruned away; tag each row with its task.
        tagged = out.select("rs", F.spark_partition_id().alias("p"))
        shares = [r["n"] for r in tagged.groupBy("p").agg(F.count("rs").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(shares) / len(rows) < 0.25


def _dense_samples(spark, n=3000):
    """One series has 90 % of all rows, within one hour, a third of them within one second."""
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        if rnd.random() < 0.9:
            us = rnd.randint(0, 10**6) if rnd.random() < 0.33 else rnd.randint(0, 3600 * 10**6)
            rows.append((i, "hot", BASE + dt.timedelta(hours=30, microseconds=us), float(rnd.randint(-3, 9)), rnd.random() < 0.7))
        else:
            rows.append((i, rnd.choice(["hot", "a", None]), BASE + dt.timedelta(seconds=rnd.randint(0, 3 * 86400)), 1.0, rnd.random() < 0.7))
    return spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double, flag boolean")


@pytest.mark.parametrize("broadcast_rows", [S.MAX_BROADCAST_ROWS, 0])
def test_dense_hour_is_exact(spark, monkeypatch, broadcast_rows):
    df = _dense_samples(spark).persist()
    monkeypatch.setattr(S, "MAX_CHUNK_ROWS", 100)
    monkeypatch.setattr(S, "MAX_BROADCAST_ROWS", broadcast_rows)
    order = Window.partitionBy("k").orderBy("ts", "id")
    want = _rows(df.withColumn("rs", F.sum("v").over(order)), ["id", "rs"])
    assert _rows(S.running_sum(df, ["k"], "ts", ["id"], "v", "rs"), ["id", "rs"]) == want
    want = _rows(df.withColumn("p_id", F.lag("id").over(order)), ["id", "p_id"])
    assert _rows(S.previous_values(df, ["k"], "ts", ["id"], ["id"], "p_"), ["id", "p_id"]) == want
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    w = Window.partitionBy("k").orderBy(us).rangeBetween(-300 * 1_000_000, 0)
    want = _rows(df.withColumn("t", F.sum("v").over(w)), ["id", "t"])
    assert _rows(S.trailing_sum(df, ["k"], "ts", "v", "t", 300), ["id", "t"]) == want
    df.unpersist()


def test_dense_hour_is_spread_across_tasks(spark, monkeypatch):
    df = _dense_samples(spark)
    monkeypatch.setattr(S, "MAX_CHUNK_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = S.running_sum(df, ["k"], "ts", ["id"], "v", "rs")
        shares = [r["n"] for r in out.select("rs", F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("rs").alias("n")).collect()]
        chunks = S._keyed(df, ["k"], "ts", S.DEFAULT_CHUNK_SECONDS).groupBy(S._SK, S._CHUNK).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert chunks <= 100 and max(shares) / 3000 < 0.25
