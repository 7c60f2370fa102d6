"""Ordered per-series computations that stay parallel when one series is huge.

A window ``partitionBy(series)`` puts a whole series into one task; with few
series (five stations, two HTTP methods, one global alert series) a series can
hold a third of all rows. Every helper here therefore cuts each series into
time chunks and partitions by ``(series, chunk)``:

* running sums: local running sum per chunk + the sum of all earlier chunks, taken
  from a per-chunk totals table (one row per series and chunk, partial-aggregated);
* previous row: local ``lag`` + the last row of the previous non-empty chunk;
* trailing range sums of width ``W <= chunk``: rows in the last ``W`` of a chunk
  are copied into the next chunk as context rows (``W / chunk`` extra rows).

A chunk that holds more than ``MAX_CHUNK_ROWS`` is split: fine bins of it are put
together up to that many rows, and a bin that is still too large is split the same
way. So one series that has most rows within one hour, or one second, is spread
like any other; only rows of one microsecond stay together.

The per-chunk tables have ``#series x #chunks`` rows; they are joined back with a
plain equi-join so AQE broadcasts them only when their measured size is small.
Results are exact and independent of the chunk width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyroll.functions.time import epoch_micros

DEFAULT_CHUNK_SECONDS = 6 * 3600
#: Rows of one chunk beyond which it is split, bins that it is counted in, and rows of a split's table that are broadcast.
MAX_CHUNK_ROWS = 1_000_000
BINS = 360
MAX_BROADCAST_ROWS = 1_000_000

_CHUNK = "_chunk"
_SK = "_sk"


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in names]


def _with_key(df: DataFrame, series: Sequence[str]) -> DataFrame:
    """One non-null series key. Struct equality treats NULL fields as equal, so a
    NULL series value stays one series, and plain equi-joins on (key, chunk)
    keep the hash partitioning the windows already have (no re-shuffle)."""
    return df.withColumn(_SK, F.struct(*_cols(series)) if series else F.struct(F.lit(0).alias("all")))


def with_chunk(df: DataFrame, ts: str, chunk_seconds: int) -> DataFrame:
    us = epoch_micros(ts)
    width = F.lit(int(chunk_seconds) * 1_000_000)
    return df.withColumn(_CHUNK, us - F.pmod(us, width))


def _keyed(df: DataFrame, series: Sequence[str], ts: str, chunk_seconds: int) -> DataFrame:
    """Add (series key, chunk); reuse them when a previous helper kept them, so
    chained helpers stay on one hash partitioning instead of re-shuffling."""
    if _SK in df.columns and _CHUNK in df.columns:
        return df
    return _split_dense(with_chunk(_with_key(df, series), ts, chunk_seconds), ts, chunk_seconds)


def _dense(d: DataFrame) -> DataFrame:
    """Chunks of more than MAX_CHUNK_ROWS rows; at most one for each so many rows of the input."""
    return d.groupBy(_SK, _CHUNK).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MAX_CHUNK_ROWS).select(_SK, _CHUNK)


def _split_dense(d: DataFrame, ts: str, chunk_seconds: int) -> DataFrame:
    """Chunks of more than MAX_CHUNK_ROWS rows as several, which keep the order of time."""
    width, us = int(chunk_seconds) * 1_000_000, epoch_micros(ts)
    while width > 1:
        dense = _dense(d)
        if dense.isEmpty():
            break
        width = -(-width // BINS)
        step = F.lit(width)
        fine = us - F.pmod(us - F.col(_CHUNK), step)
        bins = (d.join(dense, [_SK, _CHUNK], "left_semi").withColumn("_bin", fine)
                .groupBy(_SK, _CHUNK, "_bin").agg(F.count(F.lit(1)).alias("_n")))
        # At most BINS rows a chunk are ordered here. Pieces of whole bins hold half of the rows allowed and one bin more.
        half = F.lit(MAX_CHUNK_ROWS / 2)
        before = F.sum("_n").over(Window.partitionBy(_SK, _CHUNK).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
        bins = bins.withColumn("_piece", F.floor(F.coalesce(before, F.lit(0)) / half)).withColumn("_alone", F.col("_n") > half)
        first = F.min("_bin").over(Window.partitionBy(_SK, _CHUNK, "_piece", "_alone"))
        bins = bins.select(_SK, _CHUNK, "_bin", first.alias("_from"))
        few = bins.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
        d = d.withColumn("_bin", fine).join(F.broadcast(bins) if few else bins, [_SK, _CHUNK, "_bin"], "left")
        d = d.withColumn(_CHUNK, F.coalesce("_from", _CHUNK)).drop("_bin", "_from")
    return d


def _finish(df: DataFrame, keep_keys: bool) -> DataFrame:
    return df if keep_keys else df.drop(_CHUNK, _SK)


def running_sum(df: DataFrame, series: Sequence[str], ts: str, tiebreak: Sequence[str],
                value: Column | str, out: str, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                keep_keys: bool = False) -> DataFrame:
    """``sum(value) over (partition by series order by ts, *tiebreak rows
    unbounded preceding)`` computed chunk-parallel."""
    v = F.col(value) if isinstance(value, str) else value
    fresh = _SK not in df.columns or _CHUNK not in df.columns
    d = _keyed(df.withColumn("_v", v), series, ts, chunk_seconds)
    if fresh:
        # One shuffle on (series, chunk) feeds both the window and the per-chunk
        # totals (same exchange, reused), and the totals need no second exchange.
        d = d.repartition(_SK, _CHUNK)
    w_local = (Window.partitionBy(_SK, _CHUNK).orderBy(*_cols([ts, *tiebreak]))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = d.groupBy(_SK, _CHUNK).agg(F.sum("_v").alias("_tot"))
    d = d.withColumn("_local", F.sum("_v").over(w_local))
    w_prev = Window.partitionBy(_SK).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_SK, _CHUNK, F.coalesce(F.sum("_tot").over(w_prev), F.lit(0)).alias("_off"))
    res = d.join(offsets, [_SK, _CHUNK], "left")
    res = res.withColumn(out, F.col("_local") + F.coalesce(F.col("_off"), F.lit(0))).drop("_v", "_local", "_off")
    return _finish(res, keep_keys)


def previous_values(df: DataFrame, series: Sequence[str], ts: str, tiebreak: Sequence[str],
                    columns: Sequence[str], prefix: str = "prev_",
                    chunk_seconds: int = DEFAULT_CHUNK_SECONDS, keep_keys: bool = False) -> DataFrame:
    """``lag(c) over (partition by series order by ts, *tiebreak)`` for each
    column, chunk-parallel. Adds ``prefix + c`` columns (NULL for a series' first row)."""
    fresh = _SK not in df.columns or _CHUNK not in df.columns
    d = _keyed(df, series, ts, chunk_seconds)
    if fresh:
        d = d.repartition(_SK, _CHUNK)  # one shuffle for the window and the per-chunk last row
    order = _cols([ts, *tiebreak])
    packed = F.struct(*[F.col(c).alias(c) for c in columns])
    last = d.groupBy(_SK, _CHUNK).agg(F.max_by(packed, F.struct(*order)).alias("_last"))
    w_local = Window.partitionBy(_SK, _CHUNK).orderBy(*order)
    d = d.withColumn("_first", F.lag(F.lit(1)).over(w_local).isNull())
    for c in columns:
        d = d.withColumn(f"_lag_{c}", F.lag(F.col(c)).over(w_local))
    w_chunks = Window.partitionBy(_SK).orderBy(_CHUNK)
    prev_last = last.select(_SK, _CHUNK, F.lag("_last").over(w_chunks).alias("_prev_last"))
    res = d.join(prev_last, [_SK, _CHUNK], "left")
    for c in columns:
        res = res.withColumn(prefix + c, F.when(F.col("_first"), F.col("_prev_last")[c])
                             .otherwise(F.col(f"_lag_{c}")))
    return _finish(res.drop("_first", "_prev_last", *[f"_lag_{c}" for c in columns]), keep_keys)


def trailing_sum(df: DataFrame, series: Sequence[str], ts: str, value: Column | str, out: str,
                 range_seconds: int, chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """``sum(value) over (partition by series order by ts range between
    range_seconds preceding and current row)`` (both ends inclusive, peers
    included), chunk-parallel with context rows copied from the previous chunk."""
    if range_seconds > chunk_seconds:
        chunk_seconds = range_seconds
    elif not _dense(with_chunk(_with_key(df.drop(_SK, _CHUNK), series), ts, chunk_seconds)).isEmpty():
        chunk_seconds = range_seconds  # every row is copied once, but no chunk is longer than the range
    v = F.col(value) if isinstance(value, str) else value
    width = int(chunk_seconds) * 1_000_000
    rng = int(range_seconds) * 1_000_000
    d = _with_key(df.drop(_SK, _CHUNK), series).withColumn("_v", v).withColumn("_us", epoch_micros(ts))
    d = d.withColumn("_own", F.col("_us") - F.pmod(F.col("_us"), F.lit(width)))
    copies = F.array(
        F.struct(F.col("_own").alias("c"), F.lit(False).alias("ctx")),
        F.when(F.col("_us") >= F.col("_own") + F.lit(width - rng),
               F.struct((F.col("_own") + F.lit(width)).alias("c"), F.lit(True).alias("ctx"))),
    )
    d = d.withColumn("_cp", F.explode(F.filter(copies, lambda x: x.isNotNull())))
    d = d.withColumn(_CHUNK, F.col("_cp.c")).withColumn("_ctx", F.col("_cp.ctx")).drop("_cp", "_own")
    w = (Window.partitionBy(_SK, _CHUNK).orderBy("_us").rangeBetween(-rng, 0))
    d = d.withColumn(out, F.sum("_v").over(w))
    return d.filter(~F.col("_ctx")).drop("_v", "_us", "_ctx", _CHUNK, _SK)


def islands(df: DataFrame, series: Sequence[str], ts: str, tiebreak: Sequence[str], flag: str,
            max_gap_seconds: float | None = None,
            chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Runs of consecutive rows with ``flag`` true per series (gaps-and-islands).
    A false row, or more than ``max_gap_seconds`` since the previous row, ends
    a run. Returns one row per run: series, ``start_ts``, ``end_ts``, ``samples``."""
    d = previous_values(df.select(*series, ts, *tiebreak, flag), series, ts, tiebreak,
                        [flag, ts], prefix="_p_", chunk_seconds=chunk_seconds, keep_keys=True)
    f = F.coalesce(F.col(flag), F.lit(False))
    prev_f = F.coalesce(F.col(f"_p_{flag}"), F.lit(False))
    starts = f & (~prev_f)
    if max_gap_seconds is not None:
        gap = F.timestamp_diff("MICROSECOND", F.col(f"_p_{ts}"), F.col(ts))
        starts = starts | (f & gap.isNotNull() & (gap > F.lit(int(max_gap_seconds * 1_000_000))))
    d = d.withColumn("_start", starts.cast("int"))
    d = running_sum(d, series, ts, tiebreak, "_start", "_island", chunk_seconds)
    return (d.filter(f)
            .groupBy(*series, "_island")
            .agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count(F.lit(1)).alias("samples"))
            .drop("_island"))
