"""Scheduled jobs: producer cycle, backfill / reconcile, roll-up refresh, state report.

Each job writes tables of its own, run by run (``streaming/tables.py``): the
consume job raw and station rows, the producer cycle producer marks, the
reconcile job reconcile marks, the refresh job roll-ups. Status views join them
per station. A job publishes first and saves its marks only after the sink returned, so a
failed or partial delivery leaves the marks where they were (the next run
republishes; the consumer's upserts make that harmless).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyroll.operators import progress as P
from skyroll.operators import upsert as U
from skyroll.schema import BACKFILL_MODE, RECONCILIATION_LOOKBACK_DAYS, STATE_SCHEMA
from skyroll.session import apply_session_defaults
from skyroll.sources.kafka import publish_rows
from skyroll.streaming import ingest as I
from skyroll.streaming.tables import Tables

PRODUCER = "producer_marks"
RECONCILE = "reconcile_marks"

Sink = Callable[[DataFrame], None]


def _producer_schema() -> T.StructType:
    return T.StructType([T.StructField("station", T.StringType()),
                         T.StructField("producer_latest_ts", T.TimestampNTZType())])


def _stations(lines: DataFrame, stations: DataFrame | None) -> DataFrame:
    if stations is not None:
        return stations.select("station")
    return lines.select(F.col("station_dir").alias("station")).distinct()


def publish_cycle(spark: SparkSession, lines: DataFrame, ingest: Tables, producer: Tables,
                  sink: Sink, run_id: int | None = None, stations: DataFrame | None = None) -> DataFrame:
    """One incremental producer cycle (R8). Returns the per-station summary;
    a station without a resume point is reported, not published.

    The rows are written to the producer's tables first; what is published, the
    marks and the summary all come from that copy, so a mark never passes a row
    that wasn't sent. A ``run_id`` that isn't newer than the last is refused."""
    apply_session_defaults(spark)
    run = producer.begin(PRODUCER, run_id)
    stored = I.read_latest(ingest).select("station", "dt")
    resume = P.resume_points(_stations(lines, stations), read_producer_marks(producer), stored)
    resume = producer.staged(resume, "resume", PRODUCER, run)
    rows = producer.staged(P.incremental_rows(lines, resume, keep_line=True), "outgoing", PRODUCER, run)
    sink(publish_rows(_last_per_key(rows)))
    newest = rows.groupBy(F.col("station_dir").alias("station")).agg(F.max("dt").alias("producer_latest_ts"))
    producer.write(newest, PRODUCER, PRODUCER, run)
    producer.finish(PRODUCER, run)
    return P.publish_summary(resume, rows).orderBy("station")


def read_producer_marks(producer: Tables) -> DataFrame:
    """The newest published time of each station: a run adds a row for each station that it published."""
    rows = producer.read(PRODUCER, _producer_schema())
    return rows.groupBy("station").agg(F.max("producer_latest_ts").alias("producer_latest_ts"))


def _last_per_key(rows: DataFrame) -> DataFrame:
    """The last row of each message key: a sink gives no order across its tasks."""
    return U.latest_wins(rows, ["station", "dt"], ["arrival"]) if "arrival" in rows.columns else rows


def backfill_cycle(spark: SparkSession, lines: DataFrame, ingest: Tables, reconcile: Tables,
                   sink: Sink, run_id: int | None = None, reconciled_at=None,
                   lookback_days: int = RECONCILIATION_LOOKBACK_DAYS) -> DataFrame:
    """Backfill / reconcile (R9 + U5): publish the repair window of every
    station that is behind its source, then record source and database marks
    with the computed status. Returns the reconcile marks. The newest stored
    reading of a station is its row of the latest table."""
    apply_session_defaults(spark)
    run = reconcile.begin(RECONCILE, run_id)
    stored = P.table_max(I.read_latest(ingest).select("station", "dt"))
    src = P.source_latest(lines)
    rows = reconcile.staged(P.backfill_rows(lines, stored, src, lookback_days, keep_line=True), "outgoing", RECONCILE, run)
    sink(publish_rows(_last_per_key(rows), {"ingestion_mode": F.lit(BACKFILL_MODE)}))
    before = reconcile.newest(RECONCILE, STATE_SCHEMA, RECONCILE)
    after = U.reconcile_marks(before, P.observed_marks(src, stored),
                              F.current_timestamp().cast("timestamp_ntz") if reconciled_at is None else reconciled_at)
    reconcile.write(after, RECONCILE, RECONCILE, run)
    reconcile.finish(RECONCILE, run)
    return reconcile.newest(RECONCILE, STATE_SCHEMA, RECONCILE)


def state_view(ingest: Tables, producer: Tables | None = None,
               reconcile: Tables | None = None) -> DataFrame:
    """The ``ingestion_state`` rows: consumer marks, with the producer mark and
    the reconcile source mark / status laid over them per station."""
    state = I.read_state(ingest)
    if producer is not None:
        p = read_producer_marks(producer).withColumnRenamed("producer_latest_ts", "_p")
        state = (state.join(p, "station", "full_outer")
                 .withColumn("producer_latest_ts", F.greatest("producer_latest_ts", "_p")).drop("_p"))
    if reconcile is not None:
        r = reconcile.newest(RECONCILE, STATE_SCHEMA, RECONCILE).select(
            "station", F.col("source_latest_ts").alias("_s"), F.col("status").alias("_st"),
            F.col("last_reconciliation_at").alias("_r"), F.col("database_latest_ts").alias("_d"))
        state = (state.join(r, "station", "full_outer")
                 .withColumn("source_latest_ts", F.coalesce("_s", "source_latest_ts"))
                 .withColumn("last_reconciliation_at", F.coalesce("_r", "last_reconciliation_at"))
                 # The reconcile job's status stands until the stream has committed a later reading.
                 .withColumn("database_latest_ts", F.greatest("database_latest_ts", "_d"))
                 .withColumn("status", F.when(F.col("_st").isNotNull() & (F.col("consumer_latest_ts").isNull()
                             | F.col("_s").isNull() | (F.col("consumer_latest_ts") < F.col("_s"))), F.col("_st"))
                             .otherwise(F.coalesce("status", "_st", F.lit("unknown"))))
                 .drop("_s", "_st", "_r", "_d"))
    return state.select(*[f.name for f in STATE_SCHEMA.fields])


def state_report(ingest: Tables, producer: Tables | None = None,
                 reconcile: Tables | None = None) -> DataFrame:
    """Marks, gaps and the backfill flag per station."""
    return P.ingestion_status(state_view(ingest, producer, reconcile))


def history_from_store(rollups: Tables, window: str, metric: str | None = None,
                       station: str | None = None) -> DataFrame:
    """R2 over the stored roll-up table: the window filter prunes to that
    window's partition directory; the station filter uses the row-group
    statistics of the (station, bucket) sort."""
    from skyroll.plans.queries import history
    return history(I.read_rollups(rollups), window, metric, station)
