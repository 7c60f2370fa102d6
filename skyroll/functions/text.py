"""Text column expressions: station resolution, event keys, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyroll.functions.time import iso_text


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c) -> Column:
    """NULL for NULL or empty text (a falsy value in the source's ``a or b``)."""
    return F.nullif(_col(c), F.lit(""))


def first_present(*cols) -> Column:
    return F.coalesce(*[present(c) for c in cols])


def event_key(station, dt) -> Column:
    """Message key ``station|isoformat(dt)``."""
    return F.concat_ws("|", _col(station), iso_text(dt))


def format_number(value, unit: str, decimals: int) -> Column:
    """``f"{v:,.{d}f} {unit}"``; NULL gives ``N/A``."""
    v = _col(value).cast("double")
    return F.when(v.isNull(), F.lit("N/A")).otherwise(
        F.concat(F.format_number(v, int(decimals)), F.lit(" " + unit)))


def format_clock(ts) -> Column:
    """``%I:%M %p`` of a timestamp; NULL gives ``N/A``."""
    t = _col(ts)
    return F.when(t.isNull(), F.lit("N/A")).otherwise(F.date_format(t, "hh:mm a"))


def label_for(key, labels: dict) -> Column:
    """Map lookup with fallback to the key itself."""
    k = _col(key)
    if not labels:
        return k
    pairs = []
    for a, b in labels.items():
        pairs += [F.lit(a), F.lit(b)]
    return F.coalesce(F.create_map(*pairs)[k], k)
