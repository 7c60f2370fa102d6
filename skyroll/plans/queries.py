"""User-level queries: latest conditions, history by window, chart series and
the current-conditions card. Arguments are validated against closed sets;
an empty result is returned as an empty DataFrame (callers report not-found)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroll.functions.text import format_clock, format_number, label_for
from skyroll.functions.time import parse_local_ts
from skyroll.schema import (CARD_FIELDS, HISTORY_METRIC_MAP, LATEST_COLUMNS, LATEST_METRIC_MAP,
                            ROLLUP_MEASURES, STATION_LABELS, WINDOWS_BY_NAME)


def _station_arg(station: str | None) -> str | None:
    return None if station in (None, "", "all") else station


def _check_metric(metric: str | None, allowed: dict, what: str) -> None:
    if metric is not None and metric not in allowed:
        raise ValueError(f"Unsupported {what} metric: {metric}; valid metrics: {list(allowed)}")


def latest(latest_table: DataFrame, station: str | None = None, metric: str | None = None) -> DataFrame:
    """Latest conditions, optionally for one station and/or one metric."""
    _check_metric(metric, LATEST_METRIC_MAP, "latest")
    st = _station_arg(station)
    df = latest_table if st is None else latest_table.filter(F.col("station") == st)
    if metric is not None:
        df = df.select("station", "dt", F.col(LATEST_METRIC_MAP[metric]).alias(metric))
    else:
        df = df.select(*LATEST_COLUMNS, *(["updated_at"] if "updated_at" in df.columns else []))
    return df.orderBy("station")


def history(rollups: DataFrame, window: str, metric: str | None = None,
            station: str | None = None) -> DataFrame:
    """Bucketed history for one window, optionally one metric and one station."""
    if window not in WINDOWS_BY_NAME:
        raise ValueError(f"Unsupported window: {window}; valid windows: {sorted(WINDOWS_BY_NAME)}")
    _check_metric(metric, HISTORY_METRIC_MAP, "history")
    st = _station_arg(station)
    df = rollups.filter(F.col("window_name") == window)
    if st is not None:
        df = df.filter(F.col("station") == st)
    if metric is not None:
        df = df.select("bucket_ts", "station", F.col(HISTORY_METRIC_MAP[metric]).alias(metric))
    else:
        df = df.select("window_name", "bucket_ts", "station", *ROLLUP_MEASURES,
                       *(["updated_at"] if "updated_at" in df.columns else []))
    return df.orderBy("bucket_ts", "station")


def chart_series(history_rows: DataFrame, metric: str, labels: dict | None = None) -> DataFrame:
    """Chart-ready series: coerce types (bad values -> NULL), drop rows without
    time or value, label stations (fallback: the id), pressure Pa -> hPa, and
    sort by station then time."""
    required = {"bucket_ts", "station", metric}
    missing = required - set(history_rows.columns)
    if missing:
        raise ValueError("history rows are missing columns: " + ", ".join(sorted(missing)))
    labels = STATION_LABELS if labels is None else labels
    ts_type = history_rows.schema["bucket_ts"].dataType.typeName()
    ts = F.col("bucket_ts") if ts_type.startswith("timestamp") else parse_local_ts(F.col("bucket_ts").cast("string"))
    value = F.col(metric).try_cast("double")
    df = history_rows.select(ts.alias("bucket_ts"), F.col("station"), value.alias(metric))
    df = df.dropna(subset=["bucket_ts", metric])
    df = df.withColumn("station_label", label_for("station", labels))
    if metric == "pressure":
        df = df.withColumn(metric, F.col(metric) / F.lit(100))
    return df.orderBy("station", "bucket_ts")


#: Bytes of a label table up to which it is broadcast.
MAX_LABEL_BYTES = 16 << 20


def with_labels(rows: DataFrame, labels: DataFrame, key: str = "station", out: str = "station_label") -> DataFrame:
    """``rows`` with the label of their key from a table ``(key, label)`` as it is now; an unknown key, or one whose
    label is NULL, shows itself. Keys should be unique in ``labels``; of repeated ones the greatest label counts.
    In a stream, call it on each micro-batch with the table read again, so that changed labels show. The table is
    broadcast when its measured size allows it, and otherwise joined by a shuffle."""
    known = labels.groupBy(F.col(key).alias("_key")).agg(F.max("label").alias("_label"))
    size = known.agg(F.sum(F.octet_length(F.col("_key").cast("string")) + F.coalesce(F.octet_length("_label"), F.lit(0)))).first()[0]
    side = F.broadcast(known) if (size or 0) <= MAX_LABEL_BYTES else known
    return rows.join(side, F.col(key) == F.col("_key"), "left").withColumn(out, F.coalesce("_label", F.col(key).cast("string"))).drop("_key", "_label")


def conditions_card(latest_table: DataFrame, station: str | None = None) -> DataFrame:
    """Formatted current conditions per station (NULL -> ``N/A``)."""
    st = _station_arg(station)
    df = latest_table if st is None else latest_table.filter(F.col("station") == st)
    cols = [F.col("station")]
    for out, src, unit, dec in CARD_FIELDS:
        cols.append(format_number(F.col(src), unit, dec).alias(out))
    cols.append(format_clock(F.col("dt")).alias("time_text"))
    return df.select(*cols).orderBy("station")
