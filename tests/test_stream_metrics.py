"""Counts observed on a running stream, read from the metrics table."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from skyroll.operators.parse import REASON, parse_lines
from skyroll.sources import testtables as tt
from skyroll.streaming import ingest as I
from skyroll.streaming.metrics import METRICS_SCHEMA, MetricsTable, metrics_row, observed, read_metrics

SF = "/root/testdata/sf0.001"


def test_counts_of_a_stream(spark):
    work = tempfile.mkdtemp(prefix="skyroll-metrics-", dir="/tmp")
    rows = tt.kafka_rows(tt.events(spark, SF)).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for i in range(3):
        rows.filter(F.pmod("offset", F.lit(3)) == i).coalesce(1).write.parquet(os.path.join(work, "src", f"p{i}"))
    stream = (spark.readStream.schema(I.KAFKA_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(os.path.join(work, "src")))

    def parse(df):
        return parse_lines(df.select(F.col("value").cast("string").alias("line"), "offset"), keep=["offset"])

    table = os.path.join(work, "metrics")
    listener = MetricsTable(spark, table)
    spark.streams.addListener(listener)
    try:
        query = (observed(parse(stream)).writeStream.format("parquet").option("checkpointLocation", os.path.join(work, "ckpt"))
                 .trigger(availableNow=True).start(os.path.join(work, "out")))
        query.awaitTermination(200)
        for _ in range(100):  # events come after the batch
            if os.path.isdir(table) and read_metrics(spark, table).count() == 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    got = read_metrics(spark, table).orderBy("batch_id").collect()
    parsed = parse(rows)
    rejects = parsed.filter(F.col(REASON).isNotNull()).count()
    assert [r.batch_id for r in got] == [0, 1, 2] and rejects > 0
    assert sum(r.rows for r in got) == rows.count() and sum(r.rejects for r in got) == rejects
    assert sum(r.delivered for r in got) == rows.count() - rejects
    assert all(r.query_id == query.id and r.event_lag_seconds > 0 for r in got)
    newest = parsed.filter(F.col(REASON).isNull()).agg(F.max(F.unix_micros(F.col("dt").cast("timestamp")) / 1e6)).first()[0]
    assert max(r.latest_epoch for r in got) == newest


def test_topic_lag_and_empty_batches(spark):
    progress = {"id": "q", "batchId": 4, "timestamp": "2024-01-01T00:02:00.000Z",
                "sources": [{"latestOffset": '{"t":{"0":12,"1":5}}', "endOffset": {"t": {"0": 10}}}]}
    row = metrics_row(progress, {"rows": 3, "rejects": 1, "delivered": 2, "latest_epoch": 1704067200.0})
    got = spark.createDataFrame([row], METRICS_SCHEMA).first()
    assert (got.topic_lag, got.event_lag_seconds, got.rejects) == (7, 120.0, 1)
    empty = metrics_row({**progress, "sources": []}, {"rows": 0, "rejects": 0, "delivered": 0, "latest_epoch": None})
    assert spark.createDataFrame([empty], METRICS_SCHEMA).first().event_lag_seconds is None
