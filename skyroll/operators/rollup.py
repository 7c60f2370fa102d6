"""Trailing time-bucket roll-ups (day / week / month / year) and their profiles.

Semantics: for each window, rows with ``dt BETWEEN max(dt) - range AND max(dt)``
(both ends inclusive, anchored at the global max) are grouped by
``(bucket(dt), station)``; the six measures are AVG, rain is SUM; NULLs are
skipped and an all-NULL group gives NULL.

Plan: the global max is taken first as one scalar (a single-column aggregate)
and passed as a literal, so the range filter reaches the Parquet scan as a
pushed filter (row-group / partition skipping) instead of a join. The
single-pass form scans once and tags each row with every window it falls in,
so one partial aggregate and one shuffle serve all four windows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroll.functions.time import floor_to_bucket, minus_days
from skyroll.schema import (BUCKET_ORIGIN, ROLLUP_AVG_COLUMNS, ROLLUP_MEASURES, ROLLUP_SUM_COLUMNS,
                            ROLLUP_WINDOWS, RollupWindow)


def global_max(weather: DataFrame, ts: str = "dt"):
    """``MAX(dt)`` as a Python value (one scalar; NULL for an empty table)."""
    return weather.select(F.max(ts).alias("m")).first()["m"]


def lit_ts(value) -> "F.Column":
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def _measures():
    return ([F.avg(c).alias(c) for c in ROLLUP_AVG_COLUMNS]
            + [F.sum(c).alias(c) for c in ROLLUP_SUM_COLUMNS])


def rollup_window(weather: DataFrame, window: RollupWindow, max_dt) -> DataFrame:
    """One window's roll-up: ``window_name, bucket_ts, station`` + 7 measures."""
    hi = lit_ts(max_dt)
    lo = minus_days(hi, window.range_days)
    rows = weather.select("station", "dt", *ROLLUP_MEASURES).filter(
        (F.col("dt") >= lo) & (F.col("dt") <= hi))
    return (rows.groupBy(floor_to_bucket("dt", window.bucket_seconds, BUCKET_ORIGIN).alias("bucket_ts"),
                         "station")
            .agg(*_measures())
            .select(F.lit(window.name).alias("window_name"), "bucket_ts", "station", *ROLLUP_MEASURES))


def rollups_union(weather: DataFrame, max_dt, windows: Sequence[RollupWindow] = ROLLUP_WINDOWS) -> DataFrame:
    """UNION ALL of the per-window roll-ups (one scan and shuffle per window)."""
    parts = [rollup_window(weather, w, max_dt) for w in windows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rollups_single_pass(weather: DataFrame, max_dt,
                        windows: Sequence[RollupWindow] = ROLLUP_WINDOWS) -> DataFrame:
    """All windows from one scan: each row is tagged with ``(window, bucket)``
    for every window whose range holds it, then one grouped aggregate."""
    hi = lit_ts(max_dt)
    widest = max(w.range_days for w in windows)
    rows = weather.select("station", "dt", *ROLLUP_MEASURES).filter(
        (F.col("dt") >= minus_days(hi, widest)) & (F.col("dt") <= hi))
    tags = F.array(*[
        F.when(F.col("dt") >= minus_days(hi, w.range_days),
               F.struct(F.lit(w.name).alias("window_name"),
                        floor_to_bucket("dt", w.bucket_seconds, BUCKET_ORIGIN).alias("bucket_ts")))
        for w in windows])
    tagged = rows.select("station", *ROLLUP_MEASURES,
                         F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("_w"))
    return (tagged.groupBy(F.col("_w.window_name").alias("window_name"),
                           F.col("_w.bucket_ts").alias("bucket_ts"), "station")
            .agg(*_measures())
            .select("window_name", "bucket_ts", "station", *ROLLUP_MEASURES))


def refresh_rollups(weather: DataFrame, single_pass: bool = True, updated_at=None) -> DataFrame:
    """The full roll-up table for the current data (``updated_at`` optional)."""
    m = global_max(weather)
    out = rollups_single_pass(weather, m) if single_pass else rollups_union(weather, m)
    return out if updated_at is None else out.withColumn("updated_at", updated_at)


# ---------------------------------------------------------------------------
# Incremental refresh
# ---------------------------------------------------------------------------

def _sum(measure: str) -> str:
    return f"{measure}__sum"


def _n(measure: str) -> str:
    return f"{measure}__n"


def _tagged(rows: DataFrame, max_dt, windows: Sequence[RollupWindow], whole_first: bool) -> DataFrame:
    """Rows with each (window, bucket) that they fall in. ``whole_first`` keeps the whole bucket that the range begins in."""
    hi = lit_ts(max_dt)

    def tag(w: RollupWindow):
        bucket, lo = floor_to_bucket("dt", w.bucket_seconds, BUCKET_ORIGIN), minus_days(hi, w.range_days)
        inside = bucket >= floor_to_bucket(lo, w.bucket_seconds, BUCKET_ORIGIN) if whole_first else F.col("dt") >= lo
        return F.when(inside & (F.col("dt") <= hi), F.struct(F.lit(w.name).alias("window_name"), bucket.alias("bucket_ts")))

    tags = F.filter(F.array(*[tag(w) for w in windows]), lambda t: t.isNotNull())
    return rows.select("station", *ROLLUP_MEASURES, F.explode(tags).alias("_w")).select("_w.*", "station", *ROLLUP_MEASURES)


def _summed(tagged: DataFrame) -> DataFrame:
    aggs = [a for m in ROLLUP_MEASURES for a in (F.sum(m).alias(_sum(m)), F.count(m).alias(_n(m)))]
    return tagged.groupBy("window_name", "bucket_ts", "station").agg(*aggs)


def partials(weather: DataFrame, max_dt, windows: Sequence[RollupWindow] = ROLLUP_WINDOWS) -> DataFrame:
    """``window_name, bucket_ts, station`` and each measure's sum and non-NULL count, for every bucket that a
    window's trailing range touches. A bucket is whole: rows before the range's start are in it too."""
    return _summed(_tagged(weather, max_dt, windows, whole_first=True))


def refresh_partials(stored: DataFrame, weather: DataFrame, touched: DataFrame, max_dt,
                     windows: Sequence[RollupWindow] = ROLLUP_WINDOWS) -> DataFrame:
    """``partials`` of ``weather`` from those ``stored`` at an earlier refresh.

    ``touched`` has the (station, dt) of every row written since, corrections
    included. Only the buckets of the widest bucket around a touched row are
    computed again; the rest are kept, or dropped once their window has moved
    on. ``weather`` is joined by date first: where that is its partition column
    (``obs_date``), only the touched dates are read."""
    hi = lit_ts(max_dt)
    touched = touched.filter(F.col("dt") <= hi)  # all of them; a selective filter lets Spark prune partitions by the join
    widest = max(w.bucket_seconds for w in windows)
    around = lambda ts: floor_to_bucket(ts, widest, BUCKET_ORIGIN)
    changed = touched.select(F.col("station").alias("_s"), around("dt").alias("_b")).distinct()
    dates = touched.select(F.to_date("dt").alias("_d")).distinct()
    by_date = F.col("obs_date") if "obs_date" in weather.columns else F.to_date("dt")
    rows = weather.join(dates, by_date == F.col("_d"), "left_semi")
    rows = rows.join(changed, F.col("station").eqNullSafe(F.col("_s")) & (around("dt") == F.col("_b")), "left_semi")
    again = _summed(_tagged(rows, max_dt, windows, whole_first=True))
    kept = stored.join(changed, F.col("station").eqNullSafe(F.col("_s")) & (around("bucket_ts") == F.col("_b")), "left_anti")
    first = F.create_map(*[x for w in windows for x in (
        F.lit(w.name), floor_to_bucket(minus_days(hi, w.range_days), w.bucket_seconds, BUCKET_ORIGIN))])
    return kept.filter(F.col("bucket_ts") >= first[F.col("window_name")]).unionByName(again)


def rollups_from_partials(parts: DataFrame, weather: DataFrame, max_dt,
                          windows: Sequence[RollupWindow] = ROLLUP_WINDOWS) -> DataFrame:
    """The roll-up table from its ``partials``. Only the bucket in which a window's trailing range begins is computed
    from the rows, as the range may begin within it; ``weather`` is filtered to those buckets."""
    hi = lit_ts(max_dt)
    edges = [(w, minus_days(hi, w.range_days)) for w in windows]
    floors = [floor_to_bucket(lo, w.bucket_seconds, BUCKET_ORIGIN) for w, lo in edges]
    in_edge, at_edge = F.lit(False), F.lit(False)
    for (w, lo), start in zip(edges, floors, strict=True):
        end = F.timestamp_add("SECOND", F.lit(w.bucket_seconds), start)
        in_edge = in_edge | ((F.col("dt") >= lo) & (F.col("dt") < end))
        at_edge = at_edge | ((F.col("window_name") == w.name) & (F.col("bucket_ts") == start))
    edge = _summed(_tagged(weather.filter(in_edge), max_dt, windows, whole_first=False).filter(at_edge))
    both = parts.filter(~at_edge).unionByName(edge)
    values = [F.when(F.col(_n(m)) > 0, F.col(_sum(m)) / F.col(_n(m)) if m in ROLLUP_AVG_COLUMNS else F.col(_sum(m))).alias(m)
              for m in ROLLUP_MEASURES]
    return both.select("window_name", "bucket_ts", "station", *values)


def rollup_profile(rollups: DataFrame) -> DataFrame:
    """Rows and first/last bucket per (window, station), ordered."""
    aggs = [F.count(F.lit(1)).alias("row_count"), F.min("bucket_ts").alias("earliest_bucket"),
            F.max("bucket_ts").alias("latest_bucket")]
    if "updated_at" in rollups.columns:
        aggs.append(F.max("updated_at").alias("refreshed_at"))
    return rollups.groupBy("window_name", "station").agg(*aggs).orderBy("window_name", "station")


def recent_buckets(rollups: DataFrame, n: int = 10) -> DataFrame:
    """Most recent ``n`` roll-up rows (bucket desc, station, window as tie-break)."""
    return rollups.orderBy(F.col("bucket_ts").desc(), "station", "window_name").limit(n)


def latest_overall(weather: DataFrame, ts: str = "dt") -> DataFrame:
    """``COALESCE(MAX(dt)::text, 'empty')`` and the row count."""
    return weather.agg(F.coalesce(F.max(ts).cast("string"), F.lit("empty")).alias("latest_record"),
                       F.count(F.lit(1)).alias("row_count"))


def load_profile(weather: DataFrame, ts: str = "dt") -> DataFrame:
    """Rows, earliest and latest ``dt`` per station, ordered by station."""
    return (weather.groupBy("station")
            .agg(F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("earliest_dt"), F.max(ts).alias("latest_dt"))
            .orderBy("station"))


def check_loaded(weather: DataFrame) -> int:
    """Startup gate: the table must hold at least one row."""
    n = weather.count()
    if n <= 0:
        raise RuntimeError("weather table is empty")
    return n
