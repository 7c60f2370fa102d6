"""JSON-line parsing into typed observations, with a reject reason per bad line.

One ``from_json`` per line; good rows and rejects come from the same parsed
frame (``good_rows`` / ``reject_rows``), so a bad line never stops a job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyroll.functions.text import first_present, present
from skyroll.functions.time import epoch_seconds, parse_local_ts
from skyroll.schema import BIGINT_METRICS, DOUBLE_METRICS, LINE_JSON_SCHEMA, WEATHER_COLUMNS

REASON = "reject_reason"

# The line is parsed inside ``{"_o":[<line>],"_end":1}``: text after the object then either breaks the
# wrapper or shows as a second element or key.
_PARSE_SCHEMA = T.StructType([T.StructField("_o", T.ArrayType(LINE_JSON_SCHEMA)), T.StructField("_end", T.LongType()),
                              T.StructField("_corrupt_record", T.StringType())])

# Reject reasons.
BLANK = "blank_line"
MALFORMED = "malformed_json"
BAD_DT = "bad_dt"
NO_STATION = "no_station"
BAD_NUMBER = "bad_number"


def strip_space(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_bigint(text: Column) -> Column:
    """Whole numbers exactly; fractions rounded half-to-even like a float8 ->
    bigint assignment cast; anything else NULL."""
    return F.coalesce(text.try_cast("bigint"), F.bround(text.try_cast("double"), 0).cast("bigint"))


def parse_lines(df: DataFrame, line_col: str = "line", default_station: str | None = None,
                keep: Sequence[str] | None = None) -> DataFrame:
    """Parse JSON lines to the 30 observation columns plus ``ingestion_mode``
    and ``reject_reason`` (NULL for a good row).

    Station resolution: with ``default_station`` (a column holding the configured
    station, writer side) the station is ``node.hostname`` or that default;
    otherwise (reader side) ``station`` or ``node.hostname``. Empty text counts
    as missing. The stored hostname is ``node.hostname`` or the station.
    """
    keep = list(keep if keep is not None else [c for c in df.columns if c != line_col])
    raw = strip_space(F.col(line_col))
    # Parse once per line: the parsed struct comes out of a one-element
    # generator, so the optimizer cannot copy ``from_json`` into the pushed
    # reject filter or into each of the 30 field extractions.
    # A malformed line lands in ``_corrupt_record`` and a value that is not an
    # object becomes NULL, so one parser pass also classifies the line.
    wrapped = F.concat(F.lit('{"_o":['), raw, F.lit('],"_end":1}'))
    o = F.from_json(wrapped, _PARSE_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record", "allowSingleQuotes": "false"})
    pinned = F.inline(F.array(F.struct(raw.alias("_line"), o.alias("_p"))))
    whole = (F.col("_p._corrupt_record").isNull() & (F.col("_p._end") == 1) & (F.size("_p._o") == 1)
             & (~F.col("_line").contains("]") | (F.size(F.json_object_keys(F.concat(F.lit('{"_o":['), F.col("_line"), F.lit('],"_end":1}')))) == 2)))
    d = df.select(*keep, pinned).select(*keep, "_line", F.when(whole, F.get("_p._o", F.lit(0))).alias("_o"))
    # The two times are bound the same way: as columns of the wide projection below their
    # rare forms would make its code too large to compile.
    times = F.struct(parse_local_ts("_o.dt").alias("_dt"), parse_local_ts("_o.server.svr_dt").alias("_svr_dt"))
    d = d.select(*keep, "_line", "_o", F.inline(F.array(times)))
    if default_station is not None:
        station = first_present("_o.node.hostname", default_station)
    else:
        station = first_present("_o.station", "_o.node.hostname")
    dt = F.col("_dt")
    is_object = F.col("_o").isNotNull()
    numbers = [F.col(f"_o.{c}") for c in WEATHER_COLUMNS if c in DOUBLE_METRICS or c in BIGINT_METRICS]
    numbers += [F.col("_o.node.uptime_seconds"), F.col("_o.node.millis")]
    bad_number = F.lit(False)
    for n in numbers:
        bad_number = bad_number | (n.isNotNull() & n.try_cast("double").isNull())
    reason = (F.when((F.col("_line").isNull()) | (F.col("_line") == ""), F.lit(BLANK))
              .when(~is_object, F.lit(MALFORMED))
              .when(dt.isNull(), F.lit(BAD_DT))
              .when(station.isNull(), F.lit(NO_STATION))
              .when(bad_number, F.lit(BAD_NUMBER)))
    cols = []
    for c in WEATHER_COLUMNS:
        if c == "station":
            e = station
        elif c == "dt":
            e = dt
        elif c in DOUBLE_METRICS:
            e = to_double(F.col(f"_o.{c}"))
        elif c in BIGINT_METRICS:
            e = to_bigint(F.col(f"_o.{c}"))
        elif c in ("uptime_seconds", "millis"):
            e = to_bigint(F.col(f"_o.node.{c}"))
        elif c == "node_ip":
            e = F.col("_o.node.ip")
        elif c == "wifi_ssid":
            e = F.col("_o.node.wifi_ssid")
        elif c == "hostname":
            e = F.coalesce(present("_o.node.hostname"), station)
        elif c == "server_rmt_ip":
            e = F.col("_o.server.rmt_ip")
        elif c == "server_svr_dt":
            e = F.col("_svr_dt")
        else:  # pragma: no cover - every column is listed above
            raise KeyError(c)
        cols.append(e.alias(c))
    return d.select(*keep, *cols, F.col("_o.ingestion_mode").alias("ingestion_mode"),
                    reason.alias(REASON), F.col("_line").alias("_line"))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REASON).isNull()).drop(REASON, "_line")


def reject_rows(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return parsed.filter(F.col(REASON).isNotNull()).select(
        *keep, F.col("_line").alias("line"), F.col(REASON))


def line_counts() -> list[Column]:
    """Aggregates over parsed lines: rows, rejects, delivered and the newest event time. No lines count 0."""
    rejected = F.col(REASON).isNotNull()
    return [F.count(F.lit(1)).alias("rows"), F.count_if(rejected).alias("rejects"), F.count_if(~rejected).alias("delivered"),
            F.max(F.when(~rejected, epoch_seconds("dt"))).alias("latest_epoch")]
