"""Keyed merges: last-write-wins upsert, conditional latest, progress marks.

All merges are ``groupBy(key).agg(max_by(struct(row), struct(order)))``: a
partial aggregate, so map tasks combine a hot key before the shuffle and the
shuffle carries at most one row per key per map task. ``dropDuplicates`` would
keep an arbitrary row and is not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyroll.schema import (LATEST_PROJECTION, STATE_SCHEMA, STATUS_DATABASE_EMPTY, STATUS_DATABASE_GAP,
                            STATUS_HEALTHY, STATUS_SOURCE_GAP, STATUS_STREAMING)

_SRC = "_src"


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple. The whole row
    is taken, so NULLs in the winner overwrite older values. Order columns that
    are not part of the row are dropped from the output."""
    order_only = [c for c in order if c.startswith("_")]
    value_cols = [c for c in df.columns if c not in keys and c not in order_only]
    packed = F.struct(*[F.col(c) for c in value_cols])
    rank = F.struct(*[F.col(c) for c in order])
    out = df.groupBy(*keys).agg(F.max_by(packed, rank).alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in value_cols])


def merge_upsert(existing: DataFrame, batch: DataFrame, keys: Sequence[str],
                 order: Sequence[str] = ("arrival",)) -> DataFrame:
    """Upsert ``batch`` into ``existing`` on ``keys``: any batch row beats the
    stored row (stored rows are always older); within the batch, later ``order``
    wins. Output has ``existing``'s columns."""
    cols = existing.columns
    hidden = [f"_ord_{o}" for o in order]
    ex = existing.select(*cols, *[F.lit(None).cast(batch.schema[o].dataType).alias(h)
                                  for o, h in zip(order, hidden)], F.lit(0).alias(_SRC))
    bt = batch.select(*cols, *[F.col(o).alias(h) for o, h in zip(order, hidden)], F.lit(1).alias(_SRC))
    return latest_wins(ex.unionByName(bt), keys, [_SRC, *hidden])


def latest_projection(df: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Raw observation columns -> latest-table columns (pressure Pa -> hPa).
    ``arrival`` and hidden ``_`` columns are carried along for ordering."""
    cols = [F.col("station"), F.col("dt")]
    for name, src in LATEST_PROJECTION:
        e = F.col(src).cast("double")
        if name == "pressure":
            e = F.col(src) / F.lit(100)
        cols.append(e.alias(name))
    extra = [F.col(c) for c in df.columns if c.startswith("_") or c == "arrival"]
    if updated_at is not None:
        cols.append(updated_at.alias("updated_at"))
    return df.select(*cols, *extra)


def latest_per_station(observations: DataFrame, order: Sequence[str] = ("dt", "arrival"),
                       updated_at: Column | None = None) -> DataFrame:
    """Latest row per station: the greatest ``dt``; equal ``dt`` -> later arrival.
    Projects first so only the latest columns are shuffled."""
    proj = latest_projection(observations)
    out = latest_wins(proj, ["station"], order).drop(*[o for o in order if o not in ("dt",)])
    return out if updated_at is None else out.withColumn("updated_at", updated_at)


def merge_latest(stored: DataFrame, batch_observations: DataFrame,
                 updated_at: Column | None = None) -> DataFrame:
    """Conditional latest upsert: a batch row replaces the stored row when its
    ``dt >= stored.dt``; ties between batch rows go to the later arrival.
    With ``updated_at``, replaced rows get that value and kept rows keep theirs."""
    cols = [c for c in stored.columns if c != "updated_at"]
    keep_ts = updated_at is not None
    st = stored.select(*cols, *([F.col("updated_at").cast("timestamp")] if keep_ts and "updated_at" in stored.columns
                                else ([F.lit(None).cast("timestamp").alias("updated_at")] if keep_ts else [])),
                       F.lit(None).cast("long").alias("_arr"), F.lit(0).alias(_SRC))
    bt = latest_projection(batch_observations).select(
        *cols, *([updated_at.cast("timestamp").alias("updated_at")] if keep_ts else []),
        F.col("arrival").alias("_arr"), F.lit(1).alias(_SRC))
    out = latest_wins(st.unionByName(bt), ["station"], ["dt", _SRC, "_arr"])
    return out.select(*cols, *(["updated_at"] if keep_ts else []))


def evolve_schema(df: DataFrame, target_columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Add missing nullable columns (``ADD COLUMN IF NOT EXISTS``) and order to target."""
    have = set(df.columns)
    out = df
    for name, dtype in target_columns:
        if name not in have:
            out = out.withColumn(name, F.lit(None).cast(dtype))
    extra = [c for c in df.columns if c not in {n for n, _ in target_columns}]
    return out.select(*[n for n, _ in target_columns], *extra)


# ---------------------------------------------------------------------------
# Progress marks (ingestion_state)
# ---------------------------------------------------------------------------

def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def _state_select(j: DataFrame, overrides: dict[str, Column]) -> DataFrame:
    cols = []
    for f in STATE_SCHEMA.fields:
        e = overrides.get(f.name, F.col(f"s.{f.name}"))
        cols.append(e.cast(f.dataType).alias(f.name))
    return j.select(*cols)


def consumer_marks(state: DataFrame, batch: DataFrame, ts: str = "dt", partition: str = "partition",
                   offset: str = "offset", arrival: str = "arrival") -> DataFrame:
    """Consumer-side mark upsert per station from a batch of stored rows:
    consumer and database marks = GREATEST(old, batch max ts) (NULL-ignoring);
    partition and offset = the batch's last message; status = 'streaming'."""
    agg = batch.groupBy("station").agg(
        F.max(ts).alias("_new_ts"),
        F.max_by(F.struct(F.col(partition).alias("p"), F.col(offset).alias("o")), F.col(arrival)).alias("_pos"),
    )
    j = state.alias("s").join(agg.alias("b"), F.col("s.station") == F.col("b.station"), "full_outer")
    in_batch = F.col("b.station").isNotNull()
    return _state_select(j, {
        "station": F.coalesce(F.col("s.station"), F.col("b.station")),
        "consumer_latest_ts": F.greatest(F.col("s.consumer_latest_ts"), F.col("b._new_ts")),
        "database_latest_ts": F.greatest(F.col("s.database_latest_ts"), F.col("b._new_ts")),
        "kafka_partition": F.when(in_batch, F.col("b._pos.p")).otherwise(F.col("s.kafka_partition")),
        "kafka_offset": F.when(in_batch, F.col("b._pos.o")).otherwise(F.col("s.kafka_offset")),
        "status": F.when(in_batch, F.lit(STATUS_STREAMING)).otherwise(F.col("s.status")),
    })


def producer_marks(state: DataFrame, published: DataFrame, ts: str = "dt") -> DataFrame:
    """Producer mark upsert: producer mark = GREATEST(old, newest published);
    a station seen for the first time gets status 'unknown'."""
    agg = published.groupBy("station").agg(F.max(ts).alias("_new_ts"))
    j = state.alias("s").join(agg.alias("b"), F.col("s.station") == F.col("b.station"), "full_outer")
    return _state_select(j, {
        "station": F.coalesce(F.col("s.station"), F.col("b.station")),
        "producer_latest_ts": F.greatest(F.col("s.producer_latest_ts"), F.col("b._new_ts")),
        "status": F.coalesce(F.col("s.status"), F.lit("unknown")),
    })


def reconciliation_status(source: Column, producer: Column, consumer: Column, database: Column) -> Column:
    """database_empty / database_gap_detected / source_gap_detected / healthy."""
    upstream = F.greatest(source, producer, consumer)
    return (F.when(database.isNull(), F.lit(STATUS_DATABASE_EMPTY))
            .when(upstream.isNotNull() & (database < upstream), F.lit(STATUS_DATABASE_GAP))
            .when(source.isNotNull() & (database < source), F.lit(STATUS_SOURCE_GAP))
            .otherwise(F.lit(STATUS_HEALTHY)))


def reconcile_marks(state: DataFrame, observed: DataFrame, reconciled_at: Column) -> DataFrame:
    """Reconciliation upsert from ``observed(station, source_latest_ts,
    database_latest_ts[, producer_latest_ts, consumer_latest_ts])``: source and
    database marks are overwritten, producer/consumer keep the old value when
    the new one is NULL; status is computed from the observed values."""
    obs = observed
    for c in ("producer_latest_ts", "consumer_latest_ts"):
        if c not in obs.columns:
            obs = obs.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    j = state.alias("s").join(obs.alias("b"), F.col("s.station") == F.col("b.station"), "full_outer")
    in_new = F.col("b.station").isNotNull()

    def pick(new: Column, old: Column) -> Column:
        return F.when(in_new, new).otherwise(old)

    status = reconciliation_status(F.col("b.source_latest_ts"), F.col("b.producer_latest_ts"),
                                   F.col("b.consumer_latest_ts"), F.col("b.database_latest_ts"))
    return _state_select(j, {
        "station": F.coalesce(F.col("s.station"), F.col("b.station")),
        "source_latest_ts": pick(F.col("b.source_latest_ts"), F.col("s.source_latest_ts")),
        "producer_latest_ts": pick(F.coalesce(F.col("b.producer_latest_ts"), F.col("s.producer_latest_ts")),
                                   F.col("s.producer_latest_ts")),
        "consumer_latest_ts": pick(F.coalesce(F.col("b.consumer_latest_ts"), F.col("s.consumer_latest_ts")),
                                   F.col("s.consumer_latest_ts")),
        "database_latest_ts": pick(F.col("b.database_latest_ts"), F.col("s.database_latest_ts")),
        "status": pick(status, F.col("s.status")),
        "last_reconciliation_at": pick(reconciled_at, F.col("s.last_reconciliation_at")),
    })

