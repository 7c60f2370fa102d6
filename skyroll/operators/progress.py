"""Progress marks: status, gaps, resume points, incremental and repair windows.

Mark tables hold one row per station. They are joined with each other by plain
equi-joins. Lines are joined with marks by :func:`join_marks`: their own key, the
station, has few values, so lines are never dealt out by it alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyroll.functions.text import event_key
from skyroll.functions.time import epoch_seconds, minus_days, seconds_between, yyyymmdd
from skyroll.operators.parse import good_rows, parse_lines
from skyroll.operators.upsert import reconciliation_status
from skyroll.schema import BACKFILL_MODE, MARK_STAGES, RECONCILIATION_LOOKBACK_DAYS

# Stations (a row of a name and a time or two each) that a join of lines broadcasts, and the parts that a
# station's lines are dealt into beyond that.
MAX_STATIONS = 500_000
STATION_PARTS = 64


def join_marks(lines: DataFrame, marks: DataFrame, on: list[str], how: str = "inner",
               bound: DataFrame | None = None) -> DataFrame:
    """Join lines with ``marks``, one row per station, without dealing a whole station to one task.

    Marks are broadcast up to a counted number. Beyond it they are repeated for
    each part of a station's lines. ``bound`` has at least as many rows as
    ``marks`` and is counted in its place where that is cheaper."""
    counted = marks if bound is None else bound
    if counted.select(counted.columns[0]).limit(MAX_STATIONS + 1).count() <= MAX_STATIONS:
        return lines.join(F.broadcast(marks), on, how)
    part = F.pmod(F.xxhash64(*lines.columns), F.lit(STATION_PARTS))
    parts = F.sequence(F.lit(0).cast("bigint"), F.lit(STATION_PARTS - 1).cast("bigint"))
    return (lines.withColumn("_part", part)
            .join(marks.withColumn("_part", F.explode(parts)), [*on, "_part"], how).drop("_part"))


# ---------------------------------------------------------------------------
# Status and gaps
# ---------------------------------------------------------------------------


def gap_seconds(later: Column, earlier: Column) -> Column:
    """``GREATEST(EXTRACT(EPOCH FROM later - earlier), 0)``: DOUBLE, NULL marks -> 0."""
    return F.greatest(seconds_between(later, earlier), F.lit(0.0))


def gap_seconds_bigint(later: Column, earlier: Column) -> Column:
    """The status form: cast to BIGINT rounds half away from zero."""
    return F.round(gap_seconds(later, earlier)).cast("bigint")


def requires_backfill(s: Column, p: Column, c: Column, db: Column) -> Column:
    """``db IS NULL OR db < GREATEST(s, p, c)``, three-valued."""
    return db.isNull() | (db < F.greatest(s, p, c))


def _marks():
    return (F.col("source_latest_ts"), F.col("producer_latest_ts"),
            F.col("consumer_latest_ts"), F.col("database_latest_ts"))


def ingestion_status(state: DataFrame) -> DataFrame:
    """Marks, position, status and the two gaps per station, ordered by station."""
    s, p, c, db = _marks()
    return state.select(
        "station", "source_latest_ts", "producer_latest_ts", "consumer_latest_ts", "database_latest_ts",
        "kafka_partition", "kafka_offset", "status", "last_reconciliation_at",
        gap_seconds_bigint(s, db).alias("source_database_gap_seconds"),
        gap_seconds_bigint(p, c).alias("producer_consumer_gap_seconds"),
        requires_backfill(s, p, c, db).alias("requires_backfill"),
    ).orderBy("station")


def reconciliation_report(state: DataFrame) -> DataFrame:
    s, p, c, db = _marks()
    return state.select("station", reconciliation_status(s, p, c, db).alias("status")).orderBy("station")


def latest_epochs(state: DataFrame) -> DataFrame:
    """Long form ``(station, stage, epoch_seconds)``; NULL marks are omitted."""
    stacked = state.select("station", F.explode(F.array(*[
        F.struct(F.lit(stage).alias("stage"), F.col(col).alias("ts")) for stage, col in MARK_STAGES
    ])).alias("m"))
    return (stacked.filter(F.col("m.ts").isNotNull())
            .select("station", F.col("m.stage").alias("stage"), epoch_seconds(F.col("m.ts")).alias("epoch_seconds")))


def gaps_long(state: DataFrame) -> DataFrame:
    """Long form ``(station, stage, gap_seconds)`` for the two gap gauges (float,
    NULL -> 0) plus the backfill flag as 0/1 per station."""
    s, p, c, db = _marks()
    return state.select("station", F.explode(F.array(
        F.struct(F.lit("source_database").alias("stage"), gap_seconds(s, db).alias("gap")),
        F.struct(F.lit("producer_consumer").alias("stage"), gap_seconds(p, c).alias("gap")),
    )).alias("g"), F.coalesce(requires_backfill(s, p, c, db).cast("int"), F.lit(0)).alias("requires_backfill")
    ).select("station", F.col("g.stage").alias("stage"), F.col("g.gap").alias("gap_seconds"), "requires_backfill")


# ---------------------------------------------------------------------------
# Resume points and publish windows
# ---------------------------------------------------------------------------


def table_max(weather: DataFrame, ts: str = "dt") -> DataFrame:
    return weather.groupBy("station").agg(F.max(ts).alias("table_latest_ts"))


def resume_points(stations: DataFrame, state: DataFrame, weather: DataFrame) -> DataFrame:
    """Per configured station: max(producer mark, newest stored dt); NULL if
    neither exists (that station must be backfilled first)."""
    marks = state.select("station", "producer_latest_ts")
    return (stations.select("station").join(marks, "station", "left")
            .join(table_max(weather), "station", "left")
            .select("station", "producer_latest_ts", "table_latest_ts",
                    F.greatest("producer_latest_ts", "table_latest_ts").alias("resume_ts")))


def prune_files(files: DataFrame, cutoff: DataFrame, cutoff_col: str) -> DataFrame:
    """Keep ``(station_dir, file_name)`` whose 8-char date prefix >=
    ``yyyymmdd(cutoff)`` (string compare). NULL cutoff keeps every file."""
    j = files.join(cutoff.select(F.col("station").alias("station_dir"), F.col(cutoff_col).alias("_cut")),
                   "station_dir", "left")
    keep = F.col("_cut").isNull() | (F.substring("file_name", 1, 8) >= yyyymmdd(F.col("_cut")))
    return j.filter(keep).drop("_cut")


def _parse_writer(lines: DataFrame, keep_line: bool = False) -> DataFrame:
    """Parse source lines as the writer does (station = hostname or the station dir).
    ``keep_line`` carries the original text along for republishing."""
    keep = [c for c in lines.columns if keep_line or c != "line"]
    return good_rows(parse_lines(lines, default_station="station_dir", keep=keep))


def incremental_rows(lines: DataFrame, resume: DataFrame, keep_line: bool = False) -> DataFrame:
    """Rows to publish incrementally from raw source lines: only files dated on
    or after the resume day are parsed, then ``dt > resume`` (strict).
    Stations without a resume point publish nothing."""
    r = resume.select(F.col("station").alias("station_dir"), F.col("resume_ts").alias("_resume"))
    cand = join_marks(lines, r.filter(F.col("_resume").isNotNull()), ["station_dir"])
    cand = cand.filter(F.substring("file_name", 1, 8) >= yyyymmdd(F.col("_resume")))
    return _parse_writer(cand, keep_line).filter(F.col("dt") > F.col("_resume")).drop("_resume")


def publish_summary(resume: DataFrame, published: DataFrame) -> DataFrame:
    """Per station: rows published and the new producer mark
    (max of the old resume point and the newest published ``dt``)."""
    agg = published.groupBy(F.col("station_dir").alias("station")).agg(
        F.count(F.lit(1)).alias("published_count"), F.max("dt").alias("_newest"))
    j = resume.select("station", "resume_ts").join(agg, "station", "left")
    return j.select(
        "station",
        F.coalesce(F.col("published_count"), F.lit(0)).alias("published_count"),
        F.greatest("resume_ts", "_newest").alias("new_mark_ts"),
        F.when(F.col("resume_ts").isNull(), F.lit("run_backfill_first")).otherwise(F.lit("ok")).alias("outcome"),
    )


def source_latest(lines: DataFrame) -> DataFrame:
    """Per station: the newest file (greatest name) and the greatest parsed
    ``dt`` inside that file only. The newest name comes from a two-column
    aggregate over the raw lines, so only that file's lines are parsed."""
    newest = lines.groupBy(F.col("station_dir").alias("_nd")).agg(F.max("file_name").alias("newest_file"))
    in_newest = join_marks(lines, newest.select(F.col("_nd").alias("station_dir"), F.col("newest_file").alias("file_name")),
                           ["station_dir", "file_name"], "left_semi")
    parsed = _parse_writer(in_newest.select("station_dir", "file_name", "line"))
    latest = parsed.groupBy(F.col("station_dir").alias("_nd")).agg(F.max("dt").alias("source_latest_ts"))
    return (newest.join(latest, "_nd", "left")
            .select(F.col("_nd").alias("station"), "newest_file", "source_latest_ts"))


def backfill_rows(lines: DataFrame, stored_latest: DataFrame, src_latest: DataFrame,
                  lookback_days: int = RECONCILIATION_LOOKBACK_DAYS, keep_line: bool = False) -> DataFrame:
    """Repair window per station from raw source lines. Skip when
    ``stored >= source`` (both known); no stored data -> whole history; else
    only files dated on or after ``stored - lookback`` are parsed and rows with
    ``dt >= stored - lookback`` (inclusive) kept. Rows are tagged
    ``ingestion_mode = 'backfill'`` and keyed ``station|iso(dt)``."""
    plan = (src_latest.select("station", "source_latest_ts")
            .join(stored_latest.select("station", F.col("table_latest_ts").alias("_stored")), "station", "full_outer"))
    plan = plan.filter(~(F.col("_stored").isNotNull() & F.col("source_latest_ts").isNotNull()
                         & (F.col("_stored") >= F.col("source_latest_ts"))))
    plan = plan.select(F.col("station").alias("station_dir"),
                       F.when(F.col("_stored").isNotNull(), minus_days(F.col("_stored"), lookback_days)).alias("_cutoff"))
    # counted without the newest times, for which lines would be parsed once more
    stations = src_latest.select("station").distinct().union(stored_latest.select("station"))
    cand = join_marks(lines, plan, ["station_dir"], bound=stations).filter(
        F.col("_cutoff").isNull() | (F.substring("file_name", 1, 8) >= yyyymmdd(F.col("_cutoff"))))
    rows = _parse_writer(cand, keep_line).filter(F.col("_cutoff").isNull() | (F.col("dt") >= F.col("_cutoff")))
    return (rows.drop("_cutoff")
            .withColumn("ingestion_mode", F.lit(BACKFILL_MODE))
            .withColumn("event_key", event_key(F.col("station"), F.col("dt"))))


def observed_marks(src_latest: DataFrame, stored_latest: DataFrame) -> DataFrame:
    """Inputs for a reconciliation upsert: source and database marks per station."""
    return (src_latest.select("station", "source_latest_ts")
            .join(stored_latest.select("station", F.col("table_latest_ts").alias("database_latest_ts")),
                  "station", "full_outer"))
