"""Timestamp column expressions. All work on TIMESTAMP_NTZ (wall clock, no zone)
and stay independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyroll.schema import BUCKET_ORIGIN

EPOCH_NTZ = "1970-01-01 00:00:00"

# Extended ISO-8601 accepted by the parse: a full date, optional time with optional
# minutes, seconds and fraction, optional zone (Z, +HH, +HHMM, +HH:MM, +HH:MM:SS).
# Group 1 is the wall clock; the zone is checked and dropped.
_EXTENDED = (r"^(\d{4}-\d{2}-\d{2}"
             r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?)?)\d*"
             r"(Z|[+-]([01]\d|2[0-3])(:?\d{2}(:?\d{2}(\.\d{1,6})?)?)?)?$")
# ISO week dates, with and without separators: year, week, optional day of the week; then the rest of the text.
_WEEK = r"(?s)^(\d{4})(?:-W(\d{2})(?:-([1-7]))?|W(\d{2})([1-7])?)(?![\dW-])(.*)$"
# A week date taken apart; no time text starts like this.
_PARTS = "week|"
# Basic forms (no separators) rewritten to the extended form first.
_BASIC_REWRITES = (
    (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})", "$1-$2-$3T$4:$5:$6"),
    (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(?![\d:])", "$1-$2-$3T$4:$5"),
    (r"^(\d{4})(\d{2})(\d{2})(?=T|$)", "$1-$2-$3"),
    # A comma may stand before the fraction.
    (r"(:\d{2}),(?=\d)", "$1."),
    # Any single character may separate date and time.
    (r"^(\d{4}-\d{2}-\d{2})[^\d](\d{2})", "$1T$2"),
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(literal: str) -> Column:
    return F.lit(literal).cast("timestamp_ntz")


def parse_local_ts(text) -> Column:
    """Parse an ISO-8601 text to TIMESTAMP_NTZ keeping the wall clock and
    dropping any zone offset; empty, malformed or date-less text gives NULL.

    ``try_cast`` alone also accepts a bare year (``'2024'``), so only text matching
    the extended pattern is cast (a non-match extracts ``''`` -> NULL). Most
    texts do as they are; only others are rewritten, week dates and basic forms
    (``20240701T120000``) to the extended one.
    """
    t = _col(text)
    return F.coalesce(_cast_extended(t), wall_clock(week_parts(t)))


def _cast_extended(text: Column) -> Column:
    return F.regexp_extract(text, _EXTENDED, 1).try_cast("timestamp_ntz")


def week_parts(text) -> Column:
    """A text that starts with an ISO week date as marked parts; other texts as they are."""
    return F.regexp_replace(_col(text), _WEEK, _PARTS + "$1|$2$4|$3$5|$6")


def wall_clock(parts) -> Column:
    """The timestamp of ``week_parts``; a week that its year doesn't have is NULL."""
    m = _col(parts)
    part = lambda i: F.split(m, r"\|", 5)[i]
    week, day = part(2).cast("int"), F.coalesce(part(3).try_cast("int"), F.lit(1))
    monday = F.date_trunc("week", F.make_date(part(1).cast("int"), F.lit(1), F.lit(4))).cast("date")
    date = F.date_add(monday, (week - 1) * 7 + day - 1)
    s = F.when(m.startswith(_PARTS), F.when(F.weekofyear(date) == week, F.concat(date.cast("string"), part(4)))).otherwise(m)
    for pattern, repl in _BASIC_REWRITES:
        s = F.regexp_replace(s, pattern, repl)
    return _cast_extended(s)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp (BIGINT)."""
    return F.timestamp_diff("MICROSECOND", ntz(EPOCH_NTZ), _col(ts))


def epoch_seconds(ts) -> Column:
    """Unix seconds (DOUBLE) of a wall-clock timestamp read as UTC."""
    return epoch_micros(ts) / F.lit(1_000_000.0)


def seconds_between(later, earlier) -> Column:
    """``later - earlier`` in fractional seconds (DOUBLE); NULL if either is NULL.
    ``timestamp_diff(SECOND)`` truncates, so go through microseconds."""
    return F.timestamp_diff("MICROSECOND", _col(earlier), _col(later)) / F.lit(1_000_000.0)


def floor_to_bucket(ts, seconds: int, origin: str = BUCKET_ORIGIN) -> Column:
    """Floor ``ts`` to a ``seconds``-wide bucket aligned at ``origin`` (also
    before the origin). Minute and hour buckets equal calendar truncation."""
    t = _col(ts)
    width = F.lit(int(seconds) * 1_000_000)
    offset = F.pmod(F.timestamp_diff("MICROSECOND", ntz(origin), t), width)
    return F.timestamp_add("MICROSECOND", -offset, t)


def iso_text(ts) -> Column:
    """``datetime.isoformat()`` text: ``YYYY-MM-DDTHH:MM:SS`` plus ``.ffffff``
    only when the fraction is non-zero."""
    full = F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.000000$", "")


def minus_days(ts, days: int) -> Column:
    """``ts - INTERVAL days DAY`` keeping TIMESTAMP_NTZ."""
    return F.timestamp_add("DAY", F.lit(-int(days)), _col(ts))


def yyyymmdd(ts) -> Column:
    return F.date_format(_col(ts), "yyyyMMdd")
