"""Live alert transitions: ended runs = alert_rules over all samples, whatever the order of delivery."""

import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from skyroll.operators import monitor as M
from skyroll.streaming.alerts import FIRING, INACTIVE, PENDING, RESOLVED, ended_runs, live_alerts

BASE = dt.datetime(2024, 1, 1)
SAMPLE = "sample_id long, metric string, labels map<string,string>, instance string, ts timestamp_ntz, value double"
RULES = [("Down", "up", {"job": "api"}, "==", 0.0, 120, "critical"), ("Gap", "gap", {}, ">", 5.0, 0, "warning")]


def _feed(spark, batches, watermark="1 hour"):
    """Run the stream over one file for each batch of samples; its transitions in order."""
    work = tempfile.mkdtemp(prefix="skyroll-alerts-", dir="/tmp")
    out = []

    def keep(df, batch_id):
        out.extend((batch_id, r) for r in df.collect())

    for batch in batches:
        spark.createDataFrame(batch, SAMPLE).coalesce(1).write.mode("append").parquet(os.path.join(work, "src"))
        stream = spark.readStream.schema(SAMPLE).parquet(os.path.join(work, "src"))
        live = live_alerts(stream, M.rules_frame(spark, RULES), watermark, 300)
        (live.writeStream.outputMode("append").option("checkpointLocation", os.path.join(work, "ckpt")).foreachBatch(keep)
         .trigger(availableNow=True).start().awaitTermination(300))
    return out


def _sample(i, seconds, value, instance="x", metric="up", labels=None):
    return (i, metric, {"job": "api"} if labels is None else labels, instance, BASE + dt.timedelta(seconds=seconds), value)


def test_states_and_timers(spark):
    up = [_sample(i, 60 * i, v) for i, v in enumerate([1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0])]
    got = _feed(spark, [up, [_sample(90, 10 * 3600, 1.0, "other")], [_sample(91, 11 * 3600, 1.0, "other")]])
    assert [(r.state, int((r["at"] - BASE).total_seconds()), r.samples) for _, r in got] == [
        (PENDING, 60, 1), (FIRING, 180, 3), (RESOLVED, 240, 3),
        (PENDING, 300, 1), (INACTIVE, 360, 1),
        (PENDING, 420, 1), (INACTIVE, 480 + 300, 2)]  # the last by its timer, no sample came any more


def test_ended_runs_equal_alert_rules(spark):
    rng = random.Random(9)
    rows = []
    for name in ("x", "y", None):
        t = 0
        for _ in range(150):
            t += rng.choice([0, 15, 60, 60, 60, 290, 301, 900])
            metric = rng.choice(["up", "up", "up", "gap"])
            labels = rng.choice([None, None, None, {"job": "no"}])
            rows.append(_sample(len(rows), t, rng.choice([None, 0.0, 0.0, 0.0, 1.0, 9.0]), name, metric, labels))
    flush = [[_sample(10_000 + i, 10**6 + 10_000 * i, 1.0, "flush")] for i in range(2)]
    shuffled = list(rows)
    rng.shuffle(shuffled)
    got = _feed(spark, [shuffled[:200], shuffled[200:330], shuffled[330:], *flush], "30 days")
    assert not got  # the watermark is far behind: all samples wait
    shuffled = sorted(rows, key=lambda r: r[4] + dt.timedelta(seconds=rng.randint(0, 3000)))
    got = _feed(spark, [shuffled[:200], shuffled[200:330], shuffled[330:], *flush], "1 hour")
    schema = "alert string, severity string, instance string, state string, at timestamp_ntz, start_ts timestamp_ntz, end_ts timestamp_ntz, samples long"
    runs = ended_runs(spark.createDataFrame([r for _, r in got], schema))
    want = M.alert_rules(spark.createDataFrame(rows, SAMPLE), M.rules_frame(spark, RULES), 300)
    assert sorted(map(str, runs.collect())) == sorted(map(str, want.collect()))
    assert want.filter(F.col("fired")).count() > 3 and len({b for b, _ in got}) > 2
