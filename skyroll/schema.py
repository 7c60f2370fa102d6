"""Table schemas, metric maps and roll-up windows.

The column names, friendly metric names, window names, bucket widths, ranges and
labels below are fixed values: they must equal the source system's for results to
match, so they are stated plainly here and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw observation columns, in stored order.
# ---------------------------------------------------------------------------

KEY_COLUMNS = ("station", "dt")

DOUBLE_METRICS = (
    "vel_avg_mph", "vel_min_mph", "vel_max_mph",
    "temps_avg_f", "temps_min_f", "temps_max_f",
    "tempb_avg_f", "tempb_min_f", "tempb_max_f",
    "hum_avg_pct", "hum_min_pct", "hum_max_pct",
    "rain_inc_in",
)

# Columns stored as BIGINT; fractional JSON input is rounded half-to-even.
BIGINT_METRICS = (
    "dir_avg_deg",
    "pres_avg_pa", "pres_min_pa", "pres_max_pa",
    "lux_avg_lx", "lux_min_lx", "lux_max_lx",
    "rain_inc_count",
)

NODE_BIGINT_FIELDS = ("uptime_seconds", "millis")

WEATHER_COLUMNS = (
    "station", "dt",
    "vel_avg_mph", "vel_min_mph", "vel_max_mph", "dir_avg_deg",
    "temps_avg_f", "temps_min_f", "temps_max_f",
    "tempb_avg_f", "tempb_min_f", "tempb_max_f",
    "hum_avg_pct", "hum_min_pct", "hum_max_pct",
    "pres_avg_pa", "pres_min_pa", "pres_max_pa",
    "lux_avg_lx", "lux_min_lx", "lux_max_lx",
    "rain_inc_count", "rain_inc_in",
    "uptime_seconds", "millis", "node_ip", "wifi_ssid", "hostname",
    "server_rmt_ip", "server_svr_dt",
)

# The latest-table projection (stored column <- raw column).
LATEST_PROJECTION = (
    ("temperature", "temps_avg_f"),
    ("wind_speed", "vel_avg_mph"),
    ("wind_direction", "dir_avg_deg"),
    ("humidity", "hum_avg_pct"),
    ("pressure", "pres_avg_pa"),  # stored in hPa: divided by 100
    ("lux", "lux_avg_lx"),
    ("rain_inches", "rain_inc_in"),
)
LATEST_COLUMNS = ("station", "dt") + tuple(name for name, _ in LATEST_PROJECTION)

# Friendly metric name -> roll-up column.
HISTORY_METRIC_MAP = {
    "temperature": "temps_avg_f",
    "wind_speed": "vel_avg_mph",
    "humidity": "hum_avg_pct",
    "pressure": "pres_avg_pa",
    "lux": "lux_avg_lx",
    "rainfall": "rain_inc_in",
}

# Friendly metric name -> latest-table column.
LATEST_METRIC_MAP = {
    "temperature": "temperature",
    "wind_speed": "wind_speed",
    "wind_direction": "wind_direction",
    "humidity": "humidity",
    "pressure": "pressure",
    "lux": "lux",
    "rainfall": "rain_inches",
}

# Roll-up measures. Rain is an increment (SUM); the rest are AVG.
ROLLUP_AVG_COLUMNS = (
    "vel_avg_mph", "temps_avg_f", "tempb_avg_f", "hum_avg_pct", "pres_avg_pa", "lux_avg_lx",
)
ROLLUP_SUM_COLUMNS = ("rain_inc_in",)
ROLLUP_MEASURES = ROLLUP_AVG_COLUMNS + ROLLUP_SUM_COLUMNS
ROLLUP_COLUMNS = ("window_name", "bucket_ts", "station") + ROLLUP_MEASURES


@dataclass(frozen=True)
class RollupWindow:
    """A trailing range ``[max - range_days, max]`` cut into fixed buckets."""

    name: str
    bucket_seconds: int
    range_days: int


# Window name, bucket width, trailing range. Buckets are floored
# from the origin below (minute and hour buckets equal calendar truncation).
BUCKET_ORIGIN = "2000-01-01 00:00:00"
ROLLUP_WINDOWS = (
    RollupWindow("day", 60, 1),
    RollupWindow("week", 300, 7),
    RollupWindow("month", 900, 30),
    RollupWindow("year", 3600, 365),
)
WINDOWS_BY_NAME = {w.name: w for w in ROLLUP_WINDOWS}

# Station display labels (fallback is the station id).
STATION_LABELS = {
    "all": "All Stations",
    "wx_waverly": "Waverly",
    "wx_east_st": "East Street",
}

# Current-conditions card (output column, latest column, unit, decimals).
CARD_FIELDS = (
    ("temperature_text", "temperature", "°F", 1),
    ("wind_speed_text", "wind_speed", "mph", 1),
    ("wind_direction_text", "wind_direction", "°", 0),
    ("rainfall_text", "rain_inches", "in", 2),
    ("humidity_text", "humidity", "%", 1),
    ("pressure_text", "pressure", "hPa", 1),
    ("lux_text", "lux", "lx", 0),
)

# Progress-mark stages and reconciliation status words.
MARK_STAGES = (
    ("source", "source_latest_ts"),
    ("producer", "producer_latest_ts"),
    ("consumer", "consumer_latest_ts"),
    ("database", "database_latest_ts"),
)
STATUS_STREAMING = "streaming"
STATUS_DATABASE_EMPTY = "database_empty"
STATUS_DATABASE_GAP = "database_gap_detected"
STATUS_SOURCE_GAP = "source_gap_detected"
STATUS_HEALTHY = "healthy"
BACKFILL_MODE = "backfill"
RECONCILIATION_LOOKBACK_DAYS = 2

# Request-duration histogram bounds (seconds), cumulative "le" buckets.
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


# JSON read schema: every scalar as STRING so a quoted or fractional number is
# kept as text and converted by ``try_cast`` (a typed schema would null it).
LINE_JSON_SCHEMA = T.StructType(
    [_f("dt", T.StringType()), _f("station", T.StringType()), _f("ingestion_mode", T.StringType())]
    + [_f(c, T.StringType()) for c in WEATHER_COLUMNS[2:23]]
    + [
        _f("node", T.StructType([
            _f("uptime_seconds", T.StringType()),
            _f("millis", T.StringType()),
            _f("ip", T.StringType()),
            _f("wifi_ssid", T.StringType()),
            _f("hostname", T.StringType()),
        ])),
        _f("server", T.StructType([
            _f("rmt_ip", T.StringType()),
            _f("svr_dt", T.StringType()),
        ])),
    ]
)


def weather_schema() -> T.StructType:
    fields = []
    for c in WEATHER_COLUMNS:
        if c in ("dt", "server_svr_dt"):
            t = T.TimestampNTZType()
        elif c in DOUBLE_METRICS:
            t = T.DoubleType()
        elif c in BIGINT_METRICS or c in NODE_BIGINT_FIELDS:
            t = T.LongType()
        else:
            t = T.StringType()
        fields.append(T.StructField(c, t, c not in KEY_COLUMNS))
    return T.StructType(fields)


STATE_SCHEMA = T.StructType([
    T.StructField("station", T.StringType(), False),
    _f("source_latest_ts", T.TimestampNTZType()),
    _f("producer_latest_ts", T.TimestampNTZType()),
    _f("consumer_latest_ts", T.TimestampNTZType()),
    _f("database_latest_ts", T.TimestampNTZType()),
    _f("kafka_partition", T.IntegerType()),
    _f("kafka_offset", T.LongType()),
    _f("status", T.StringType()),
    _f("last_reconciliation_at", T.TimestampNTZType()),
])
STATE_COLUMNS = tuple(f.name for f in STATE_SCHEMA.fields)

# Alert rules on metric samples (name, metric, label matchers,
# comparison, threshold, for seconds, severity). The error-ratio rule is a ratio
# of sums (``monitor.error_ratio``), the restart rule an increase of a counter
# (``monitor.restart_alerts``).
ALERT_RULES = (
    ("WeatherApiDown", "up", {"job": "weather-api"}, "==", 0.0, 120, "critical"),
    ("WeatherDatabaseDown", "weather_database_up", {}, "==", 0.0, 120, "critical"),
    ("WeatherIngestionNeedsBackfill", "weather_ingestion_requires_backfill", {}, "==", 1.0, 300, "warning"),
    ("WeatherProducerConsumerGap", "weather_ingestion_gap_seconds", {"stage": "producer_consumer"}, ">", 120.0, 300, "warning"),
    ("KubernetesDeploymentUnavailable", "kube_deployment_status_replicas_unavailable", {}, ">", 0.0, 300, "warning"),
)
# A counter's increase over this range above 0 for so long is a restart alert.
RESTART_RANGE_SECONDS, RESTART_FOR_SECONDS = 600, 300
# A series without a sample for this long is stale: a run of true samples ends.
STALENESS_SECONDS = 300
