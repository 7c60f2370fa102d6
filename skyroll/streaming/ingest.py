"""Micro-batch ingest: Kafka-shaped rows -> observations, station rows, rejects.

``readStream`` (Kafka, or any source with the Kafka row contract
``key, value, topic, partition, offset, timestamp``) -> ``foreachBatch``:

1. parse each message once; rejects go to their own table with the reason;
2. write the batch's observations, one row per (station, dt), later offset wins,
   into date partitions of the batch's own;
3. write one row per touched station: its latest reading and consumer marks;
4. write the batch's counts: rows, rejects, delivered, newest event time;
5. finish the run, which shows the four together (``streaming/tables.py``).

No stored row is read or rewritten. ``read_weather``, ``read_latest`` and
``read_state`` merge on (station, dt) or station; latest and marks read the
station rows only.

Offsets are committed by the checkpoint only after ``foreachBatch`` returns, so
a failure replays the batch; it overwrites its own partitions, and one that was
finished is skipped (at-least-once + idempotent write).
The roll-up refresh is a separate scheduled batch job (``refresh_rollup_table``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyroll.functions.time import epoch_seconds
from skyroll.operators import rollup as R
from skyroll.operators import upsert as U
from skyroll.operators.parse import REASON, good_rows, line_counts, parse_lines, reject_rows
from skyroll.schema import LATEST_COLUMNS, ROLLUP_MEASURES, ROLLUP_WINDOWS, WEATHER_COLUMNS, weather_schema
from skyroll.session import apply_session_defaults
from skyroll.streaming.tables import Tables

WEATHER = "weather"
STATIONS = "station_rows"
REJECTS = "rejects"
COUNTS = "batch_counts"
ROLLUPS = "weather_aggregates"
DATE_COL = "obs_date"

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
])


def _weather_schema() -> T.StructType:
    return T.StructType([*weather_schema().fields, T.StructField("arrival", T.LongType()),
                         T.StructField(DATE_COL, T.DateType())])


def _latest_fields() -> list[T.StructField]:
    fields = [T.StructField("station", T.StringType()), T.StructField("dt", T.TimestampNTZType())]
    return fields + [T.StructField(c, T.DoubleType()) for c in LATEST_COLUMNS[2:]]


def _stations_schema() -> T.StructType:
    return T.StructType([*_latest_fields(), T.StructField("arrival", T.LongType()),
                         T.StructField("kafka_partition", T.IntegerType()), T.StructField("kafka_offset", T.LongType())])


def _rejects_schema() -> T.StructType:
    return T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
                         T.StructField("line", T.StringType()), T.StructField(REASON, T.StringType())])


def station_rows(good: DataFrame) -> DataFrame:
    """One row per station of a batch: its latest reading (equal times: later
    arrival), and partition and offset of its last message."""
    last = good.groupBy("station").agg(
        F.max_by(F.struct("partition", "offset"), F.struct("timestamp", "offset")).alias("_at"))
    latest = U.latest_wins(U.latest_projection(good), ["station"], ["dt", "arrival"])
    return (latest.join(last, "station")
            .select(*latest.columns, F.col("_at.partition").alias("kafka_partition"), F.col("_at.offset").alias("kafka_offset")))


def ingest_batch(tables: Tables, batch: DataFrame, batch_id: int, writer: str = "batch") -> None:
    """Apply one micro-batch of Kafka-shaped rows, once for each ``batch_id``
    of a ``writer``. What is applied later wins."""
    if batch_id <= tables.last_run(writer):
        return
    msgs = batch.select(F.col("value").cast("string").alias("line"), "partition", "offset", "timestamp")
    parsed = parse_lines(msgs, keep=["partition", "offset", "timestamp"]).persist()
    try:
        tables.write(reject_rows(parsed, keep=["partition", "offset"]).select(*_rejects_schema().names),
                     REJECTS, writer, batch_id)
        good = good_rows(parsed).withColumn("arrival", F.col("offset"))
        rows = U.latest_wins(good.select(*WEATHER_COLUMNS, "arrival"), ["station", "dt"], ["arrival"])
        tables.write(rows.withColumn(DATE_COL, F.to_date("dt")).repartitionByRange(DATE_COL, "station", "dt")
                     .sortWithinPartitions(DATE_COL, "station", "dt"), WEATHER, writer, batch_id, by=(DATE_COL,))
        tables.write(station_rows(good), STATIONS, writer, batch_id)
        tables.write(parsed.agg(*line_counts()), COUNTS, writer, batch_id)
        tables.finish(writer, batch_id)
    finally:
        parsed.unpersist()


def start_ingest(spark: SparkSession, source: DataFrame, root: str, checkpoint: str,
                 trigger: dict | None = None):
    """Start the streaming ingest from a Kafka-shaped streaming DataFrame."""
    apply_session_defaults(spark)
    tables = Tables(spark, root)

    def apply(df: DataFrame, batch_id: int) -> None:
        # The checkpoint's own identity, which Spark wrote before the first batch.
        row = spark.read.json(f"{checkpoint.rstrip('/')}/metadata", schema="id string").first()
        ingest_batch(tables, df, batch_id, f"stream-{row.id}")

    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    writer = writer.trigger(**(trigger or {"processingTime": "120 seconds"}))
    return writer.start()


def kafka_source(spark: SparkSession, servers: str, topic: str, max_offsets: int | None) -> DataFrame:
    """Subscribe from the earliest offset; progress lives in the checkpoint.
    ``max_offsets`` bounds each micro-batch (backpressure; None: no bound), so a restart after a
    long outage drains the backlog in bounded batches instead of one huge one."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    return r.load()


def read_rejects(tables: Tables) -> DataFrame:
    """Rejects of finished batches, with the reason."""
    return tables.read(REJECTS, _rejects_schema()).drop("finished_at")


def read_batch_counts(tables: Tables) -> DataFrame:
    """One row per finished batch: writer, run, finished_at, rows, rejects, delivered, the newest event
    time, and the seconds that it lies behind the finish (wall clock, read as UTC; null without a reading)."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("rows", "rejects", "delivered")]
                          + [T.StructField("latest_epoch", T.DoubleType())])
    behind = epoch_seconds(F.to_utc_timestamp("finished_at", F.current_timezone()).cast("timestamp_ntz")) - F.col("latest_epoch")
    return tables.read(COUNTS, schema).withColumn("event_lag_seconds", behind)


def read_weather(tables: Tables, since: _dt.date | None = None) -> DataFrame:
    """The raw table, last write wins on (station, dt); ``since`` prunes to dates from then on.

    Offsets only order the rows of one batch, as a topic's offsets can start again.
    """
    rows = tables.read(WEATHER, _weather_schema())
    if since is not None:
        rows = rows.filter(F.col(DATE_COL) >= F.lit(since))
    order = {"_at": F.col("finished_at"), "_run": F.col("run")}
    return U.latest_wins(rows.select(*WEATHER_COLUMNS, "arrival", *[e.alias(n) for n, e in order.items()]),
                         ["station", "dt"], [*order, "arrival"])


def read_latest(tables: Tables) -> DataFrame:
    """The latest reading of each station (equal times: the later batch); ``updated_at``: when its batch was finished."""
    rows = tables.read(STATIONS, _stations_schema())
    names = [f.name for f in _latest_fields()]
    return U.latest_wins(rows.select(*names, F.col("finished_at").alias("updated_at"), F.col("run").alias("_run")),
                         ["station"], ["dt", "updated_at", "_run"])


def read_state(tables: Tables) -> DataFrame:
    """Consumer marks of each station: the newest time, and the last batch's partition and offset."""
    rows = tables.read(STATIONS, _stations_schema())
    return U.consumer_marks(U.empty_state(tables.spark), rows.withColumn("_order", F.struct("finished_at", "run")),
                            partition="kafka_partition", offset="kafka_offset", arrival="_order")


def refresh_rollup_table(spark: SparkSession, source: Tables, target: Tables, run_id: int | None = None,
                         single_pass: bool = True) -> DataFrame:
    """Full refresh of the roll-up table.

    The anchor ``MAX(dt)`` comes from the station rows, so only dates inside the
    widest trailing range are read of the raw table. The output is partitioned by
    window and sorted by (station, bucket) for the history lookups. Readers keep
    the previous run's rows until the new run is finished."""
    apply_session_defaults(spark)
    number = target.begin(ROLLUPS, run_id)
    max_dt = R.global_max(station_times(source))
    widest = max(w.range_days for w in ROLLUP_WINDOWS)
    since = None if max_dt is None else (max_dt - _dt.timedelta(days=widest)).date()
    roll = R.rollups_single_pass if single_pass else R.rollups_union
    out = roll(read_weather(source, since), max_dt).withColumn("updated_at", F.current_timestamp())
    target.write(out.repartition("window_name", "station")
                 .sortWithinPartitions("window_name", "station", "bucket_ts"), ROLLUPS, ROLLUPS, number, by=("window_name",))
    target.finish(ROLLUPS, number)
    return read_rollups(target)


def station_times(tables: Tables) -> DataFrame:
    """The newest time of each station row; their maximum is the raw table's."""
    return tables.read(STATIONS, _stations_schema()).select("dt")


def read_rollups(tables: Tables) -> DataFrame:
    """The roll-up rows of the last finished refresh."""
    return tables.newest(ROLLUPS, _rollup_schema(), ROLLUPS)


def _rollup_schema() -> T.StructType:
    fields = [T.StructField("window_name", T.StringType()), T.StructField("bucket_ts", T.TimestampNTZType()),
              T.StructField("station", T.StringType())]
    fields += [T.StructField(c, T.DoubleType()) for c in ROLLUP_MEASURES]
    return T.StructType(fields + [T.StructField("updated_at", T.TimestampType())])


def lag_from_progress(progress: dict | None) -> int | None:
    """Live topic lag from a ``StreamingQuery.lastProgress``: for each source,
    the sum over partitions of (latest offset - processed end offset)."""
    if not progress:
        return None
    total, seen = 0, False
    for src in progress.get("sources", []):
        latest, end = src.get("latestOffset"), src.get("endOffset")
        if isinstance(latest, str) or isinstance(end, str):
            import json
            latest = json.loads(latest) if isinstance(latest, str) else latest
            end = json.loads(end) if isinstance(end, str) else end
        if not isinstance(latest, dict) or not isinstance(end, dict):
            continue
        for topic, parts in latest.items():
            for part, off in parts.items():
                total += int(off) - int(end.get(topic, {}).get(part, 0))
                seen = True
    return total if seen else None
