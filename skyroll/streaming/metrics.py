"""Metrics of a running stream, observed while its rows pass and kept as a table.

``observed`` counts rows, rejects and delivered rows of parsed messages within
the job that reads them anyway. ``MetricsTable`` listens to a session's queries
and adds one row per micro-batch to a Parquet table: the counts, the newest
event time and how far it lies behind the trigger, and the topic lag, where
the source tells its end offsets. Event times are wall clocks, read as UTC.

Only streams with a plain sink count once: ``foreachBatch`` may read its batch
several times, and each reading counts. The ingest job therefore writes the counts
of a batch with its rows (``ingest.read_batch_counts``). A batch that is run again after a
failure has a second row; ``read_metrics`` keeps the last.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from skyroll.operators.parse import line_counts
from skyroll.operators.upsert import latest_wins
from skyroll.streaming.ingest import lag_from_progress

NAME = "ingest"
METRICS_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("triggered_at", T.TimestampType()), T.StructField("rows", T.LongType()),
    T.StructField("rejects", T.LongType()), T.StructField("delivered", T.LongType()),
    T.StructField("latest_epoch", T.DoubleType()), T.StructField("event_lag_seconds", T.DoubleType()),
    T.StructField("topic_lag", T.LongType()), T.StructField("written_at", T.TimestampType()),
])


def observed(parsed: DataFrame, name: str = NAME) -> DataFrame:
    """Parsed lines with their counts observed under ``name``. A reject has a reason; an empty batch counts 0."""
    return parsed.observe(name, *line_counts())


class MetricsTable(StreamingQueryListener):
    """Adds a row to the Parquet table at ``path`` for each micro-batch with counts observed under ``name``.

    Register with ``spark.streams.addListener``. The table must lie in shared storage.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = NAME):
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(self.name)
        if counts is not None:
            row = metrics_row(json.loads(event.progress.json), counts.asDict())
            self.spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def metrics_row(progress: dict, counts: dict) -> tuple:
    """One row of the table from a micro-batch's progress and its observed counts."""
    at = _dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    newest = counts.get("latest_epoch")
    behind = None if newest is None else at.timestamp() - newest
    return (progress["id"], progress["batchId"], at, counts["rows"], counts["rejects"], counts["delivered"],
            newest, behind, lag_from_progress(progress), _dt.datetime.now(_dt.timezone.utc))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and micro-batch, the last written one."""
    rows = spark.read.schema(METRICS_SCHEMA).parquet(path)
    return latest_wins(rows, ["query_id", "batch_id"], ["written_at"])
