"""Station line files: ``<root>/<station>/<YYYYMMDD>....txt``, one JSON object per line.

Listing goes through Spark's file index (parallel listing on large trees).
Predicates on ``_metadata.file_name`` are evaluated against the listing, so
files outside the date range are never opened. Data is only read by executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A daily file name starts with 8 digits (YYYYMMDD) and ends with ".txt".
NAME_RULE = "^[0-9]{8}.*[.]txt$"
# Folders (named by a station and a date, some 30 bytes) that a join broadcasts.
MAX_FOLDERS = 500_000
_EMPTY = ("station_dir string, file_name string, arrival struct<file_name:string,start:bigint,id:bigint>, "
          "line string")


def _name() -> Column:
    return F.col("_metadata.file_name")


def _arrival() -> Column:
    """Order of a station's lines: file name, then place within the file. Splits of a file are in order
    of their start, and the id grows within a split; how Spark packs files into tasks doesn't matter."""
    return F.struct(_name().alias("file_name"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("id"))


def _station_of_path(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def station_files(spark: SparkSession, root: str) -> DataFrame:
    """``(station_dir, file_name, path)`` of the daily files, listed by Spark
    without reading file contents (only the binary source's path column is used)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt")
          .load(f"{root.rstrip('/')}/*").select("path"))
    name = F.element_at(F.split("path", "/"), -1)
    return (df.select(_station_of_path(F.col("path")).alias("station_dir"), name.alias("file_name"), "path")
            .filter(F.col("file_name").rlike(NAME_RULE)))


def list_station_files(spark: SparkSession, root: str) -> list[tuple[str, str, str]]:
    """Sorted ``(station_dir, file_name, path)`` (small trees and tests)."""
    return sorted(tuple(r) for r in station_files(spark, root).collect())


def read_station_lines(spark: SparkSession, root: str, min_date: dict[str, str | None] | None = None) -> DataFrame:
    """Lines of the station files as ``station_dir, file_name, arrival, line``.

    ``min_date`` maps station -> ``yyyymmdd`` (or None for all files): other
    stations are skipped, and the earliest cutoff is a file-name predicate the
    file index applies before any file is opened; the exact per-station cutoff
    follows as a row filter. ``arrival`` orders a station's lines for last-wins
    merges: by file name, then by place in the file."""
    df = spark.read.option("pathGlobFilter", "*.txt").text(f"{root.rstrip('/')}/*")
    df = df.filter(_name().rlike(NAME_RULE))
    if min_date is not None:
        if not min_date:
            return spark.createDataFrame([], _EMPTY)
        cutoffs = [v for v in min_date.values() if v is not None]
        if cutoffs and len(cutoffs) == len(min_date):
            df = df.filter(F.substring(_name(), 1, 8) >= F.lit(min(cutoffs)))
    out = df.select(_station_of_path(F.col("_metadata.file_path")).alias("station_dir"),
                    _name().alias("file_name"),
                    _arrival().alias("arrival"),
                    F.col("value").alias("line"))
    if min_date is not None:
        pairs = []
        for k, v in min_date.items():
            pairs += [F.lit(k), F.lit(v if v is not None else "")]
        cut = F.create_map(*pairs)[F.col("station_dir")]
        out = out.filter(cut.isNotNull() & (F.substring("file_name", 1, 8) >= cut))
    return out


def newest_files_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of each station's newest file only: the newest name per station is
    found on the listing (one path per station comes back), and only those
    files are opened. Feed to ``progress.source_latest``."""
    newest = (station_files(spark, root).groupBy("station_dir")
              .agg(F.max_by("path", "file_name").alias("path")).collect())
    if not newest:
        return spark.createDataFrame([], _EMPTY)
    df = spark.read.text([r.path for r in newest])
    return df.select(_station_of_path(F.col("_metadata.file_path")).alias("station_dir"),
                     _name().alias("file_name"),
                     _arrival().alias("arrival"), F.col("value").alias("line"))


def land_lines(lines: DataFrame, path: str) -> None:
    """Append lines to a table laid out by station and ``file_day`` (``station|yyyymmdd``), whose folders joins can
    prune: one column names station and date, as Spark prunes each column by itself. Names that don't follow the rule
    are left out, as in the listing."""
    day = F.concat_ws("|", "station_dir", F.substring("file_name", 1, 8))
    rows = lines.filter(F.col("file_name").rlike(NAME_RULE)).withColumn("file_day", day)
    rows.repartition("file_day").write.mode("append").partitionBy("station_dir", "file_day").parquet(path)


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """The landed table; its partition columns are text."""
    schema = spark.read.parquet(path).schema
    for f in schema.fields:
        if f.name in ("station_dir", "file_day"):
            f.dataType = T.StringType()
    return spark.read.schema(schema).parquet(path)


def _folders(landed: DataFrame) -> DataFrame:
    """Folders of the landed table, by station and date; no column of its files is read. The filter drops nothing: Spark
    prunes by a join whose other side is filtered."""
    folders = landed.filter(F.col("file_day") > "").select(F.col("station_dir").alias("_s"), F.col("file_day").alias("_f")).distinct()
    return folders.withColumn("_d", F.right("_f", F.lit(8)))


def _pruned(landed: DataFrame, folders: DataFrame) -> DataFrame:
    """The lines of some folders. Their names are broadcast up to a counted number, and that broadcast reaches
    the scan as a partition filter (dynamic pruning); beyond it the join is a shuffle."""
    folders = folders.select("_f")
    few = folders.limit(MAX_FOLDERS + 1).count() <= MAX_FOLDERS
    return landed.join(F.broadcast(folders) if few else folders, F.col("file_day") == F.col("_f"), "left_semi")


def lines_since(landed: DataFrame, cutoffs: DataFrame, column: str = "cutoff") -> DataFrame:
    """Lines of each station's files dated on or after its own cutoff (a timestamp; NULL takes all its files).

    ``cutoffs`` has one row a station and may hold any number of them: it is
    joined, never collected, and stations without a row are skipped."""
    c = cutoffs.select(F.col("station").alias("_cs"), F.date_format(F.col(column), "yyyyMMdd").alias("_cut"))
    wanted = _folders(landed).join(c, F.col("_s") == F.col("_cs")).filter(F.col("_d") >= F.coalesce("_cut", F.lit("")))
    return _pruned(landed, wanted)


def newest_lines(landed: DataFrame) -> DataFrame:
    """Lines of each station's newest file (greatest name), from the folder of its newest date alone."""
    newest = _folders(landed).groupBy("_s").agg(F.max_by("_f", "_d").alias("_f"))
    rows = _pruned(landed, newest)
    names = rows.groupBy(F.col("station_dir").alias("_ns")).agg(F.max("file_name").alias("_name"))
    return rows.join(names, (F.col("station_dir") == F.col("_ns")) & (F.col("file_name") == F.col("_name")), "left_semi")
