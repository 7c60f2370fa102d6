"""Views kept current as observations stream in: the latest reading of each station and one window's roll-up.

Both are keyed state, so each micro-batch gives only the rows that it changed
(output mode ``update``), and neither depends on the order of delivery.
``write_changes`` keeps them as Parquet and ``read_changes`` reads the current rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skyroll.functions.time import floor_to_bucket
from skyroll.operators.upsert import latest_per_station, latest_wins
from skyroll.schema import BUCKET_ORIGIN, ROLLUP_MEASURES, ROLLUP_SUM_COLUMNS, RollupWindow

BATCH = "_batch"


def live_latest(observations: DataFrame) -> DataFrame:
    """Latest row of each station as streaming state: one row a station, replaced by a greater ``dt``, or by a later
    ``arrival`` at the same ``dt``. Late rows are compared like any other; a micro-batch gives the stations it touched."""
    return latest_per_station(observations)


def live_rollup(observations: DataFrame, window: RollupWindow, watermark: str) -> DataFrame:
    """Roll-up rows of the buckets that a micro-batch touched, equal to the batch roll-up of all rows so far.

    The state of a (station, bucket) holds each reading's last delivery, so a
    corrected reading (same station and ``dt``, later ``arrival``) takes the
    place of the old one, whichever comes first. A bucket's state ends when the
    watermark passes its end; a row later than the watermark is dropped here,
    and the batch refresh still has it. The trailing range isn't applied;
    readers filter by bucket time. NULL measures are skipped, as in the batch."""
    width_ms = window.bucket_seconds * 1000
    et = F.col("dt").cast("timestamp")  # event-time column for the watermark (session zone UTC)
    rows = observations.select("station", floor_to_bucket("dt", window.bucket_seconds, BUCKET_ORIGIN).alias("bucket_ts"),
                               F.unix_micros(et).alias("at"), "arrival", et.alias("_et"), *ROLLUP_MEASURES)
    rows = rows.withWatermark("_et", watermark)
    measures = list(ROLLUP_MEASURES)
    fields = ["at", "arrival", *measures]

    def bucket(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        station, start = key
        closes = int(pd.Timestamp(start).value // 1_000_000) + width_ms
        if closes <= state.getCurrentWatermarkMs():
            return
        known = [np.frombuffer(state.get[0], np.float64).reshape(-1, len(measures))] if state.exists else []
        ids = [np.frombuffer(state.get[1], np.int64).reshape(-1, 2)] if state.exists else []
        for b in batches:
            known.append(b[measures].to_numpy(np.float64))
            ids.append(b[["at", "arrival"]].to_numpy(np.int64))
        readings = pd.DataFrame(np.concatenate(ids), columns=fields[:2])
        readings[measures] = np.concatenate(known)
        readings = readings.sort_values(fields[:2], kind="stable").drop_duplicates("at", keep="last")
        state.update((readings[measures].to_numpy().tobytes(), readings[fields[:2]].to_numpy().tobytes()))
        state.setTimeoutTimestamp(closes)
        values = {m: readings[m].sum(min_count=1) if m in ROLLUP_SUM_COLUMNS else readings[m].mean() for m in measures}
        yield pd.DataFrame([{"station": station, "bucket_ts": start, **values}])

    out = "station string, bucket_ts timestamp_ntz, " + ", ".join(f"{m} double" for m in measures)
    g = rows.groupBy("station", "bucket_ts").applyInPandasWithState(
        bucket, out, "readings binary, ids binary", "update", GroupStateTimeout.EventTimeTimeout)
    return g.select(F.lit(window.name).alias("window_name"), "bucket_ts", "station", *measures)


def write_changes(changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Start a query that keeps each micro-batch's changed rows in a folder of its own; a replay rewrites that folder."""
    def apply(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(apply).trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def read_changes(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The current row of each key: that of the newest micro-batch which changed it."""
    rows = spark.read.parquet(path)
    return latest_wins(rows, keys, [BATCH]).drop(BATCH)
