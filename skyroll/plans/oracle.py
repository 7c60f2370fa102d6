"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Each statement starts from the raw test tables and applies the same fixed
reshaping rules as :mod:`skyroll.sources.testtables`, then the reference
semantics written the plain SQL way (window ``row_number`` for last-wins,
``UNION ALL`` of four roll-ups, ``lag`` / running sums for the monitors).
DOUBLE outputs are rounded as ``round(x * 1e6) / 1e6`` like the Spark side.
"""

from __future__ import annotations

from skyroll.schema import DOUBLE_METRICS, ROLLUP_MEASURES, STALENESS_SECONDS, WEATHER_COLUMNS


def R(expr: str, alias: str) -> str:
    return f"round(({expr}) * 1e6) / 1e6 AS {alias}"


def _weather_cols(prefix: str = "") -> str:
    out = []
    for c in WEATHER_COLUMNS:
        out.append(R(prefix + c, c) if c in DOUBLE_METRICS else prefix + c)
    return ", ".join(out)


OBS = """obs AS (
  SELECT event_id AS arrival, event_type AS station, date_trunc('minute', ts) AS dt,
    value / 10 AS vel_avg_mph, value / 20 AS vel_min_mph, value / 5 AS vel_max_mph,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS dir_avg_deg,
    value AS temps_avg_f, value - 1 AS temps_min_f, value + 1 AS temps_max_f,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / 2 END AS tempb_avg_f,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / 2 - 0.5 END AS tempb_min_f,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / 2 + 0.5 END AS tempb_max_f,
    CAST(user_id % 100 AS DOUBLE) AS hum_avg_pct, CAST(user_id % 100 AS DOUBLE) - 1 AS hum_min_pct,
    CAST(user_id % 100 AS DOUBLE) + 1 AS hum_max_pct,
    CAST(101325 + event_id % 500 AS BIGINT) AS pres_avg_pa, CAST(101325 + event_id % 500 AS BIGINT) - 10 AS pres_min_pa,
    CAST(101325 + event_id % 500 AS BIGINT) + 10 AS pres_max_pa,
    event_id % 1000 AS lux_avg_lx, event_id % 1000 - 5 AS lux_min_lx, event_id % 1000 + 5 AS lux_max_lx,
    event_id % 3 AS rain_inc_count, value / 1000 AS rain_inc_in,
    event_id AS uptime_seconds, event_id * 1000 AS millis,
    '10.0.0.' || CAST(user_id % 250 AS VARCHAR) AS node_ip, 'net' AS wifi_ssid, event_type AS hostname,
    '127.0.0.1' AS server_rmt_ip, ts AS server_svr_dt
  FROM events)"""

WEATHER = """weather AS (
  SELECT * EXCLUDE (arrival, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station, dt ORDER BY arrival DESC) AS rn FROM obs) WHERE rn = 1)"""

_AGGS = ", ".join([f"avg({c}) AS {c}" for c in ROLLUP_MEASURES[:-1]] + ["sum(rain_inc_in) AS rain_inc_in"])


def _rollup_branch(name: str, bucket: str, days: int) -> str:
    return (f"SELECT '{name}' AS window_name, {bucket} AS bucket_ts, station, {_AGGS} "
            f"FROM weather CROSS JOIN mx WHERE dt BETWEEN m - INTERVAL {days} DAY AND m GROUP BY ALL")


ROLLUPS = "mx AS (SELECT max(dt) AS m FROM weather),\nru AS (\n" + "\nUNION ALL\n".join([
    _rollup_branch("day", "date_trunc('minute', dt)", 1),
    _rollup_branch("week", "time_bucket(INTERVAL 5 MINUTE, dt, TIMESTAMP '2000-01-01 00:00:00')", 7),
    _rollup_branch("month", "time_bucket(INTERVAL 15 MINUTE, dt, TIMESTAMP '2000-01-01 00:00:00')", 30),
    _rollup_branch("year", "date_trunc('hour', dt)", 365),
]) + ")"

RU_COLS = "window_name, bucket_ts, station, " + ", ".join(R(c, c) for c in ROLLUP_MEASURES)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_RU = _with(OBS, WEATHER, ROLLUPS)

STORED = "stored AS (SELECT * FROM obs WHERE arrival % 10 < 7)"
BATCH = "batch AS (SELECT * FROM obs WHERE arrival % 10 >= 7)"


def _latest_proj(src: str, with_arrival: bool = True) -> str:
    arr = ", arrival" if with_arrival else ""
    return (f"SELECT station, dt, temps_avg_f AS temperature, vel_avg_mph AS wind_speed, "
            f"CAST(dir_avg_deg AS DOUBLE) AS wind_direction, hum_avg_pct AS humidity, pres_avg_pa / 100 AS pressure, "
            f"CAST(lux_avg_lx AS DOUBLE) AS lux, rain_inc_in AS rain_inches{arr} FROM {src}")


def _latest_of(src: str) -> str:
    return (f"SELECT * EXCLUDE (rn, arrival) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY station ORDER BY dt DESC, arrival DESC) AS rn FROM ({_latest_proj(src)})) WHERE rn = 1")


LATEST_COLS = ("station, dt, " + ", ".join(R(c, c) for c in (
    "temperature", "wind_speed", "wind_direction", "humidity", "pressure", "lux", "rain_inches")))

STATE = """st AS (
  SELECT event_type AS station,
    max(CASE WHEN event_type <> 'view' THEN ts END) AS source_latest_ts,
    max(CASE WHEN event_type <> 'view' AND event_id % 7 <> 1 THEN ts END) AS producer_latest_ts,
    max(CASE WHEN event_type <> 'view' AND (event_type <> 'error' OR ts < TIMESTAMP '2024-01-29 00:00:00') THEN ts END)
      AS consumer_latest_ts,
    max(CASE WHEN event_type = 'signup' THEN NULL
             WHEN event_type IN ('click', 'error') AND ts >= TIMESTAMP '2024-01-28 00:00:00' THEN NULL
             ELSE ts END) AS database_latest_ts,
    CAST(0 AS INTEGER) AS kafka_partition,
    max(CASE WHEN event_type <> 'view' AND (event_type <> 'error' OR ts < TIMESTAMP '2024-01-29 00:00:00')
             THEN event_id END) AS kafka_offset,
    'streaming' AS status,
    CAST(NULL AS TIMESTAMP) AS last_reconciliation_at
  FROM events GROUP BY event_type)"""

STATE_COLS = ("station, source_latest_ts, producer_latest_ts, consumer_latest_ts, database_latest_ts, "
              "kafka_partition, kafka_offset, status, last_reconciliation_at")


def _status(s: str, p: str, c: str, db: str) -> str:
    up = f"greatest({s}, {p}, {c})"
    return (f"CASE WHEN {db} IS NULL THEN 'database_empty' "
            f"WHEN {up} IS NOT NULL AND {db} < {up} THEN 'database_gap_detected' "
            f"WHEN {s} IS NOT NULL AND {db} < {s} THEN 'source_gap_detected' ELSE 'healthy' END")


def _gap(later: str, earlier: str) -> str:
    return f"greatest(date_diff('microsecond', {earlier}, {later}) / 1e6, 0.0)"


def _iso(ts: str) -> str:
    return (f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({ts}) = 0 THEN '' "
            f"ELSE strftime({ts}, '.%f') END")


# Writer-side source rows: parseable lines with a dt (no-station lines keep the station dir).
SRC = """src AS (
  SELECT arrival, station, dt, strftime(dt, '%Y%m%d') || '.txt' AS file_name FROM obs
  WHERE arrival % 97 NOT IN (0, 1))"""
FILES = "files AS (SELECT DISTINCT station AS station_dir, strftime(dt, '%Y%m%d') || '.txt' AS file_name FROM obs)"
SRC_LATEST = """srclatest AS (
  SELECT station, max(file_name) AS newest_file, arg_max(file_max, file_name) AS source_latest_ts
  FROM (SELECT station, file_name, max(dt) AS file_max FROM src GROUP BY ALL) GROUP BY station)"""
HELD = """held AS (
  SELECT station, max(dt) AS table_latest_ts FROM obs
  WHERE station <> 'signup' AND NOT (station IN ('click', 'error') AND server_svr_dt >= TIMESTAMP '2024-01-28 00:00:00')
  GROUP BY station)"""
RESUME = """resume AS (
  SELECT s.station, st.producer_latest_ts, t.table_latest_ts,
         greatest(st.producer_latest_ts, t.table_latest_ts) AS resume_ts
  FROM (SELECT DISTINCT station FROM obs) s
  LEFT JOIN st ON st.station = s.station
  LEFT JOIN (SELECT station, max(dt) AS table_latest_ts FROM obs WHERE arrival % 10 < 7 GROUP BY station) t
    ON t.station = s.station)"""
INCR = """incr AS (
  SELECT src.* FROM src JOIN resume r ON r.station = src.station
  WHERE r.resume_ts IS NOT NULL AND substr(src.file_name, 1, 8) >= strftime(r.resume_ts, '%Y%m%d')
    AND src.dt > r.resume_ts)"""

LOG = """log AS (
  SELECT event_id AS request_id, ts,
    CASE WHEN user_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method,
    event_type AS route,
    CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status,
    value / 100 AS duration_seconds
  FROM events)"""

COUNTER = """cs AS (
  SELECT route, request_id, ts,
    CAST((row_number() OVER (PARTITION BY route ORDER BY ts, request_id)) % 50 AS DOUBLE) AS counter FROM log),
dl AS (SELECT *, lag(counter) OVER (PARTITION BY route ORDER BY ts, request_id) AS p FROM cs),
d2 AS (SELECT route, request_id, ts, counter,
         CASE WHEN p IS NULL THEN 0.0 WHEN counter < p THEN counter ELSE counter - p END AS delta FROM dl)"""

RATIO = """tagged AS (
  SELECT date_trunc('minute', ts) - to_minutes(CAST(k AS BIGINT)) AS window_start,
         CAST(starts_with(status, '5') AS INTEGER) AS err
  FROM log CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS k)),
agg AS (SELECT window_start, count(*) AS requests, CAST(sum(err) AS BIGINT) AS errors FROM tagged GROUP BY window_start),
ratio AS (
  SELECT window_start, window_start + INTERVAL 300 SECOND AS window_end, requests, errors,
         errors / greatest(CAST(requests AS DOUBLE), CAST(0.001 AS DOUBLE)) AS error_ratio,
         errors / greatest(CAST(requests AS DOUBLE), CAST(0.001 AS DOUBLE)) > 0.05 AS firing
  FROM agg)"""

_BOUNDS = ("0.005", "0.01", "0.025", "0.05", "0.075", "0.1", "0.25", "0.5", "0.75", "1.0", "2.5", "5.0",
           "7.5", "10.0")
BOUNDS = ("bnd AS (SELECT * FROM (VALUES " + ", ".join(f"('{b}', CAST({b} AS DOUBLE))" for b in _BOUNDS)
          + ", ('+Inf', CAST('inf' AS DOUBLE))) t(le, bound))")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for w in ("day", "week", "month", "year"):
        q[f"rollup_{w}"] = BASE_RU + f"SELECT {RU_COLS} FROM ru WHERE window_name = '{w}'"
    q["rollup_all"] = BASE_RU + f"SELECT {RU_COLS} FROM ru"
    q["rollup_incremental"] = q["rollup_all"]
    q["rollup_profile"] = BASE_RU + (
        "SELECT window_name, station, count(*) AS row_count, min(bucket_ts) AS earliest_bucket, "
        "max(bucket_ts) AS latest_bucket FROM ru GROUP BY window_name, station")
    q["recent_buckets"] = BASE_RU + f"SELECT {RU_COLS} FROM ru ORDER BY bucket_ts DESC, station, window_name LIMIT 10"
    q["latest_overall"] = _with(OBS, WEATHER) + (
        "SELECT COALESCE(CAST(max(dt) AS VARCHAR), 'empty') AS latest_record, count(*) AS row_count FROM weather")
    q["load_profile"] = _with(OBS, WEATHER) + (
        "SELECT station, count(*) AS row_count, min(dt) AS earliest_dt, max(dt) AS latest_dt FROM weather GROUP BY station")
    q["history_window"] = BASE_RU + f"SELECT {RU_COLS} FROM ru WHERE window_name = 'week'"
    q["history_metric"] = BASE_RU + (
        f"SELECT bucket_ts, station, {R('hum_avg_pct', 'humidity')} FROM ru "
        "WHERE window_name = 'month' AND station = 'error'")
    q["history_chart"] = BASE_RU + (
        f"SELECT bucket_ts, station, {R('pres_avg_pa / 100', 'pressure')}, "
        "CASE station WHEN 'all' THEN 'All Stations' WHEN 'wx_waverly' THEN 'Waverly' "
        "WHEN 'wx_east_st' THEN 'East Street' ELSE station END AS station_label "
        "FROM ru WHERE window_name = 'day' AND bucket_ts IS NOT NULL AND pres_avg_pa IS NOT NULL")
    q["latest_per_station"] = _with(OBS) + f"SELECT {LATEST_COLS} FROM ({_latest_of('obs')})"
    q["latest_metric"] = _with(OBS) + f"SELECT station, dt, {R('temperature', 'temperature')} FROM ({_latest_of('obs')})"

    def fmt(col, unit, dec):
        return f"CASE WHEN {col} IS NULL THEN 'N/A' ELSE format('{{:,.{dec}f}} {unit}', {col}) END"
    q["conditions_card"] = _with(OBS) + (
        "SELECT station, "
        f"{fmt('temperature', '°F', 1)} AS temperature_text, {fmt('wind_speed', 'mph', 1)} AS wind_speed_text, "
        f"{fmt('wind_direction', '°', 0)} AS wind_direction_text, {fmt('rain_inches', 'in', 2)} AS rainfall_text, "
        f"{fmt('humidity', '%', 1)} AS humidity_text, {fmt('pressure', 'hPa', 1)} AS pressure_text, "
        f"{fmt('lux', 'lx', 0)} AS lux_text, "
        "CASE WHEN dt IS NULL THEN 'N/A' ELSE strftime(dt, '%I:%M %p') END AS time_text "
        f"FROM ({_latest_of('obs')})")

    q["upsert_observations"] = _with(OBS, STORED, BATCH) + (
        f"SELECT {_weather_cols()} FROM (SELECT *, row_number() OVER (PARTITION BY station, dt "
        "ORDER BY src DESC, arrival DESC) AS rn FROM (SELECT *, 0 AS src FROM stored UNION ALL "
        "SELECT *, 1 AS src FROM batch)) WHERE rn = 1")
    merge_tail = (
        "SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY dt DESC, src DESC, "
        "arrival DESC) AS rn FROM (SELECT *, CAST(NULL AS BIGINT) AS arrival, 0 AS src FROM ({stored}) "
        f"UNION ALL SELECT *, 1 AS src FROM ({_latest_proj('batch')}))) WHERE rn = 1")
    q["latest_merge"] = _with(OBS, STORED, BATCH) + merge_tail.format(cols=LATEST_COLS, stored=_latest_of("stored"))
    q["schema_evolve"] = _with(OBS, STORED, BATCH) + merge_tail.format(
        cols=LATEST_COLS,
        stored=("SELECT station, dt, temperature, wind_speed, wind_direction, CAST(NULL AS DOUBLE) AS humidity, "
                f"CAST(NULL AS DOUBLE) AS pressure, lux, rain_inches FROM ({_latest_of('stored')})"))

    q["schema_generations"] = (
        "SELECT event_id AS arrival, event_type AS station, "
        + R("CASE WHEN event_id % 10 >= 7 THEN value WHEN event_id % 5 <> 0 THEN CAST(user_id % 100 AS DOUBLE) END", "wind_avg") + ", "
        "CASE WHEN event_id % 10 >= 7 THEN 5000000000 + event_id WHEN event_id % 5 <> 0 THEN event_id % 360 END AS wind_dir_deg, "
        "CASE WHEN event_id % 10 >= 7 THEN event_id % 7 = 0 END AS wind_dir_gust, event_id % 10 < 7 AS no_rain, "
        + R("CASE WHEN event_id % 10 >= 7 THEN value / 2 ELSE CAST(event_id % 1000 AS DOUBLE) END", "lux") + ", "
        "CASE WHEN event_id % 10 >= 7 THEN 2 ELSE 1 END AS n_lux, "
        "CASE WHEN event_id % 10 >= 7 THEN event_type END AS power FROM events")

    q["consumer_marks"] = _with(OBS, STATE, BATCH) + (
        "SELECT coalesce(s.station, b.station) AS station, s.source_latest_ts, s.producer_latest_ts, "
        "greatest(s.consumer_latest_ts, b.new_ts) AS consumer_latest_ts, "
        "greatest(s.database_latest_ts, b.new_ts) AS database_latest_ts, "
        "CAST(CASE WHEN b.station IS NOT NULL THEN 0 ELSE s.kafka_partition END AS INTEGER) AS kafka_partition, "
        "CASE WHEN b.station IS NOT NULL THEN b.off ELSE s.kafka_offset END AS kafka_offset, "
        "CASE WHEN b.station IS NOT NULL THEN 'streaming' ELSE s.status END AS status, s.last_reconciliation_at "
        "FROM st s FULL OUTER JOIN "
        "(SELECT CASE WHEN station = 'signup' THEN 'signup-new' ELSE station END AS station, max(dt) AS new_ts, "
        "max(arrival) AS off FROM batch GROUP BY 1) b "
        "ON s.station = b.station")
    q["producer_marks"] = _with(OBS, STATE, BATCH) + (
        "SELECT coalesce(s.station, b.station) AS station, s.source_latest_ts, "
        "greatest(s.producer_latest_ts, b.new_ts) AS producer_latest_ts, s.consumer_latest_ts, s.database_latest_ts, "
        "s.kafka_partition, s.kafka_offset, coalesce(s.status, 'unknown') AS status, s.last_reconciliation_at "
        "FROM st s FULL OUTER JOIN "
        "(SELECT CASE WHEN station = 'view' THEN 'view-new' ELSE station END AS station, max(dt) AS new_ts "
        "FROM batch GROUP BY 1) b ON s.station = b.station")
    null_ts = "CAST(NULL AS TIMESTAMP)"
    q["reconcile_merge"] = _with(OBS, STATE, SRC, SRC_LATEST, HELD) + (
        "SELECT coalesce(s.station, o.station) AS station, "
        "CASE WHEN o.station IS NOT NULL THEN o.source_latest_ts ELSE s.source_latest_ts END AS source_latest_ts, "
        "s.producer_latest_ts, s.consumer_latest_ts, "
        "CASE WHEN o.station IS NOT NULL THEN o.database_latest_ts ELSE s.database_latest_ts END AS database_latest_ts, "
        "s.kafka_partition, s.kafka_offset, "
        f"CASE WHEN o.station IS NOT NULL THEN {_status('o.source_latest_ts', null_ts, null_ts, 'o.database_latest_ts')} "
        "ELSE s.status END AS status, "
        "CASE WHEN o.station IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE s.last_reconciliation_at END "
        "AS last_reconciliation_at "
        "FROM st s FULL OUTER JOIN "
        "(SELECT replace(coalesce(a.station, h.station), 'purchase', 'purchase-new') AS station, a.source_latest_ts, h.table_latest_ts AS database_latest_ts "
        " FROM srclatest a FULL OUTER JOIN held h ON a.station = h.station) o ON s.station = o.station")

    q["parse_observations"] = _with(OBS) + (
        f"SELECT arrival, {_weather_cols()} FROM obs WHERE arrival % 97 NOT IN (0, 1, 2)")
    q["reject_rows"] = _with(OBS) + (
        "SELECT arrival, CASE arrival % 97 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'bad_dt' ELSE 'no_station' END "
        "AS reject_reason FROM obs WHERE arrival % 97 IN (0, 1, 2)")
    q["event_keys"] = _with(OBS, SRC) + f"SELECT arrival, station, dt, station || '|' || {_iso('dt')} AS event_key FROM src"
    base = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
    q["parse_local_ts"] = (
        "SELECT event_id AS arrival, "
        "CASE WHEN event_id % 97 = 1 THEN 'junk' WHEN event_id % 97 = 2 THEN strftime(ts, '%Y') "
        "WHEN event_id % 97 = 3 THEN '' "
        f"WHEN event_id % 6 = 0 THEN {base} || '-0400' WHEN event_id % 6 = 1 THEN {base} || '-04:00' "
        f"WHEN event_id % 6 = 2 THEN {base} || 'Z' WHEN event_id % 6 = 3 THEN {base} || strftime(ts, '.%f') || '+05:30' "
        f"WHEN event_id % 6 = 4 THEN {base} || strftime(ts, '.%f') ELSE strftime(ts, '%Y%m%dT%H%M%S') END AS dt_text, "
        "CASE WHEN event_id % 97 IN (1, 2, 3) THEN NULL WHEN event_id % 6 IN (3, 4) THEN ts "
        "ELSE date_trunc('second', ts) END AS parsed_dt FROM events")
    st_expr = "CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN NULL ELSE event_type END"
    host_expr = ("CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 7 = 0 THEN NULL "
                 "ELSE event_type || '-node' END")
    q["resolve_station"] = (
        f"SELECT arrival, reader AS station, coalesce(nullif(h, ''), reader) AS hostname, "
        f"coalesce(nullif(h, ''), nullif(et, '')) AS writer_station FROM ("
        f"SELECT event_id AS arrival, event_type AS et, {host_expr} AS h, "
        f"coalesce(nullif({st_expr}, ''), nullif({host_expr}, '')) AS reader FROM events)")

    gap_b = "CAST(round({g}) AS BIGINT)"
    q["ingestion_status"] = _with(STATE) + (
        f"SELECT {STATE_COLS}, "
        f"{gap_b.format(g=_gap('source_latest_ts', 'database_latest_ts'))} AS source_database_gap_seconds, "
        f"{gap_b.format(g=_gap('producer_latest_ts', 'consumer_latest_ts'))} AS producer_consumer_gap_seconds, "
        "(database_latest_ts IS NULL OR database_latest_ts < greatest(source_latest_ts, producer_latest_ts, "
        "consumer_latest_ts)) AS requires_backfill FROM st")
    q["reconciliation_status"] = _with(STATE) + (
        f"SELECT station, {_status('source_latest_ts', 'producer_latest_ts', 'consumer_latest_ts', 'database_latest_ts')}"
        " AS status FROM st")
    q["ingestion_latest_epoch"] = _with(STATE) + " UNION ALL ".join(
        f"SELECT station, '{stage}' AS stage, {R(f'epoch_us({col}) / 1e6', 'epoch_seconds')} FROM st "
        f"WHERE {col} IS NOT NULL"
        for stage, col in (("source", "source_latest_ts"), ("producer", "producer_latest_ts"),
                           ("consumer", "consumer_latest_ts"), ("database", "database_latest_ts")))
    req = ("CAST(coalesce(CAST((database_latest_ts IS NULL OR database_latest_ts < greatest(source_latest_ts, "
           "producer_latest_ts, consumer_latest_ts)) AS INTEGER), 0) AS INTEGER)")
    q["ingestion_gaps_long"] = _with(STATE) + (
        f"SELECT station, 'source_database' AS stage, {R(_gap('source_latest_ts', 'database_latest_ts'), 'gap_seconds')}, "
        f"{req} AS requires_backfill FROM st UNION ALL "
        f"SELECT station, 'producer_consumer' AS stage, {R(_gap('producer_latest_ts', 'consumer_latest_ts'), 'gap_seconds')}, "
        f"{req} AS requires_backfill FROM st")
    q["resume_points"] = _with(OBS, STATE, RESUME) + "SELECT * FROM resume"
    q["pruned_files"] = _with(OBS, STATE, RESUME, FILES) + (
        "SELECT f.station_dir, f.file_name FROM files f LEFT JOIN resume r ON r.station = f.station_dir "
        "WHERE r.resume_ts IS NULL OR substr(f.file_name, 1, 8) >= strftime(r.resume_ts, '%Y%m%d')")
    q["incremental_new"] = _with(OBS, STATE, RESUME, SRC, INCR) + (
        f"SELECT arrival, station, dt, station || '|' || {_iso('dt')} AS event_key FROM incr")
    q["publish_summary"] = _with(OBS, STATE, RESUME, SRC, INCR) + (
        "SELECT r.station, coalesce(p.n, 0) AS published_count, greatest(r.resume_ts, p.newest) AS new_mark_ts, "
        "CASE WHEN r.resume_ts IS NULL THEN 'run_backfill_first' ELSE 'ok' END AS outcome "
        "FROM resume r LEFT JOIN (SELECT station, count(*) AS n, max(dt) AS newest FROM incr GROUP BY station) p "
        "ON p.station = r.station")
    q["source_latest"] = _with(OBS, SRC, SRC_LATEST) + "SELECT station, newest_file, source_latest_ts FROM srclatest"
    q["backfill_window"] = _with(OBS, SRC, SRC_LATEST, HELD) + (
        "SELECT s.arrival, s.station, s.dt, 'backfill' AS ingestion_mode, "
        f"s.station || '|' || {_iso('s.dt')} AS event_key FROM src s JOIN ("
        " SELECT coalesce(a.station, h.station) AS station,"
        "   CASE WHEN h.table_latest_ts IS NOT NULL THEN h.table_latest_ts - INTERVAL 2 DAY END AS cutoff"
        " FROM srclatest a FULL OUTER JOIN held h ON a.station = h.station"
        " WHERE NOT (h.table_latest_ts IS NOT NULL AND a.source_latest_ts IS NOT NULL"
        "            AND h.table_latest_ts >= a.source_latest_ts)) p ON p.station = s.station "
        "WHERE p.cutoff IS NULL OR (substr(s.file_name, 1, 8) >= strftime(p.cutoff, '%Y%m%d') AND s.dt >= p.cutoff)")

    q["listing_links"] = (
        "SELECT page_id, href FROM (SELECT page_id, unnest(regexp_extract_all(html, "
        "'<a\\b[^>]*\\bhref=\"([^\"]*)\"', 1)) AS href FROM pages) "
        "WHERE href <> ''")

    q["daily_file_links"] = (
        "SELECT page_id, href FROM (SELECT event_id AS page_id, unnest([d || '.txt', d || '_a&b.txt', d || '.csv', 'old/' || d || '.txt', "
        "substr(d, 1, 7) || '.txt', d || '.txt.gz', d || event_type || '.txt']) AS href "
        "FROM (SELECT event_id, event_type, strftime(ts, '%Y%m%d') AS d FROM events)) "
        "WHERE href SIMILAR TO '[0-9]{8}.*' AND href LIKE '%.txt'")

    q["request_counts"] = _with(LOG) + "SELECT method, route, status, count(*) AS requests_total FROM log GROUP BY ALL"
    q["duration_histogram"] = _with(LOG, BOUNDS) + (
        "SELECT t.method, t.route, b.le, "
        "CAST(sum(CASE WHEN l.duration_seconds <= b.bound THEN 1 ELSE 0 END) AS BIGINT) AS bucket_count, "
        f"{R('t.duration_sum', 'duration_sum')}, t.duration_count "
        "FROM (SELECT method, route, sum(duration_seconds) AS duration_sum, count(*) AS duration_count "
        "      FROM log GROUP BY ALL) t CROSS JOIN bnd b JOIN log l ON l.method = t.method AND l.route = t.route "
        "GROUP BY t.method, t.route, b.le, t.duration_sum, t.duration_count")
    q["inflight_gauge"] = _with(LOG) + (
        "SELECT method, request_id, edge_ts, delta, CAST(sum(delta) OVER (PARTITION BY method ORDER BY edge_ts, delta, request_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS in_flight FROM ("
        "SELECT method, request_id, ts AS edge_ts, 1 AS delta FROM log UNION ALL "
        "SELECT method, request_id, ts + to_microseconds(CAST(round(duration_seconds * 1000000) AS BIGINT)) AS edge_ts, "
        "-1 AS delta FROM log)")
    q["counter_increase"] = _with(LOG, COUNTER) + (
        "SELECT route, request_id, ts, counter, " + R(
            "sum(delta) OVER (PARTITION BY route ORDER BY ts RANGE BETWEEN INTERVAL 900 SECOND PRECEDING "
            "AND CURRENT ROW)", "increase_15m") + " FROM d2")
    q["counter_rate"] = _with(LOG, COUNTER) + (
        "SELECT route, request_id, ts, counter, " + R(
            "sum(delta) OVER (PARTITION BY route ORDER BY ts RANGE BETWEEN INTERVAL 300 SECOND PRECEDING "
            "AND CURRENT ROW) / 300.0", "rate_5m") + " FROM d2")
    q["request_rate"] = _with(LOG).rstrip() + ",\n" + (
        "cs AS (SELECT method, route, status, request_id, ts, CAST((row_number() OVER "
        "  (PARTITION BY method, route, status ORDER BY ts, request_id)) % 50 AS DOUBLE) AS counter FROM log), "
        "dl AS (SELECT *, lag(counter) OVER (PARTITION BY method, route, status ORDER BY ts, request_id) AS p FROM cs), "
        "d2 AS (SELECT route, status, ts, CASE WHEN p IS NULL THEN 0.0 WHEN counter < p THEN counter "
        "  ELSE counter - p END AS delta FROM dl), "
        "d3 AS (SELECT *, CASE WHEN date_trunc('minute', ts) = ts THEN date_trunc('minute', ts) "
        "  ELSE date_trunc('minute', ts) + INTERVAL 1 MINUTE END AS e0 FROM d2) "
        "SELECT route, status, e0 + to_minutes(CAST(k AS BIGINT)) AS eval_ts, "
        + R("sum(delta) / 300.0", "rate_5m") +
        " FROM d3 CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY ALL")
    q["rate_range"] = _with(LOG).rstrip() + ",\n" + (
        "cs AS (SELECT method, route, status, request_id, ts, CAST((row_number() OVER "
        "  (PARTITION BY method, route, status ORDER BY ts, request_id)) % 50 AS DOUBLE) AS v FROM log), "
        "dl AS (SELECT *, lag(v) OVER (PARTITION BY method, route, status ORDER BY ts, request_id) AS p FROM cs), "
        "ds AS (SELECT *, CASE WHEN p IS NULL THEN 0.0 WHEN v < p THEN v ELSE v - p END AS delta, "
        "  time_bucket(INTERVAL 15 MINUTE, ts - INTERVAL 1 MICROSECOND, TIMESTAMP '2000-01-01 00:00:00') + INTERVAL 15 MINUTE AS step_end FROM dl), "
        "span AS (SELECT method, route, status, min(step_end) AS lo, max(step_end) + INTERVAL 45 MINUTE AS hi FROM ds GROUP BY ALL), "
        "grid AS (SELECT method, route, status, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS eval_ts FROM span), "
        "w AS (SELECT g.method, g.route, g.status, g.eval_ts, count(s.ts) AS samples, min(s.ts) AS t0, max(s.ts) AS t1, "
        "  arg_min(s.v, (s.ts, s.request_id)) AS v0, sum(s.delta) - arg_min(s.delta, (s.ts, s.request_id)) AS inc "
        "  FROM grid g LEFT JOIN ds s ON s.method = g.method AND s.route = g.route AND s.status = g.status "
        "  AND s.ts > g.eval_ts - INTERVAL 1 HOUR AND s.ts <= g.eval_ts GROUP BY ALL), "
        "x AS (SELECT *, date_diff('microsecond', t0, t1) / 1e6 AS sampled, date_diff('microsecond', eval_ts - INTERVAL 1 HOUR, t0) / 1e6 AS a, "
        "  date_diff('microsecond', t1, eval_ts) / 1e6 AS b FROM w), "
        "y AS (SELECT *, CASE WHEN a >= sampled / (samples - 1) * 1.1 THEN sampled / (samples - 1) / 2 ELSE a END AS a2, "
        "  CASE WHEN b >= sampled / (samples - 1) * 1.1 THEN sampled / (samples - 1) / 2 ELSE b END AS b2, "
        "  CASE WHEN inc > 0 AND v0 >= 0 THEN sampled * (v0 / inc) END AS z FROM x WHERE samples > 1 AND sampled > 0), "
        "e AS (SELECT *, inc * ((sampled + CASE WHEN z < a2 THEN z ELSE a2 END + b2) / sampled) AS increase FROM y) "
        f"SELECT w.method, w.route, w.status, w.eval_ts, w.samples, {R('e.increase', 'increase')}, {R('e.increase / 3600.0', 'rate')} "
        "FROM w LEFT JOIN e USING (method, route, status, eval_ts)")
    q["error_ratio"] = _with(LOG, RATIO) + (
        f"SELECT window_start, window_end, requests, errors, {R('error_ratio', 'error_ratio')}, firing FROM ratio")
    q["sustained_alerts"] = _with(LOG, RATIO) + (
        "SELECT min(window_start) AS start_ts, max(window_start) AS end_ts, count(*) AS samples, "
        + R("date_diff('microsecond', min(window_start), max(window_start)) / 1e6", "duration_seconds") + ", "
        "date_diff('microsecond', min(window_start), max(window_start)) / 1e6 >= 300 AS fired "
        "FROM (SELECT *, sum(st) OVER (ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl "
        "      FROM (SELECT *, CASE WHEN firing AND (NOT coalesce(pf, false) "
        "                 OR date_diff('microsecond', pts, window_start) > 60000000) THEN 1 ELSE 0 END AS st "
        "            FROM (SELECT window_start, firing, lag(firing) OVER (ORDER BY window_start) AS pf, "
        "                         lag(window_start) OVER (ORDER BY window_start) AS pts FROM ratio))) "
        "WHERE firing GROUP BY isl")
    rules = (
        "('WeatherApiDown', 'up', 'weather-api', '==', 0.0, 120, 'critical'), "
        "('WeatherDatabaseDown', 'weather_database_up', NULL, '==', 0.0, 120, 'critical'), "
        "('WeatherIngestionNeedsBackfill', 'weather_ingestion_requires_backfill', NULL, '==', 1.0, 300, 'warning'), "
        "('WeatherProducerConsumerGap', 'weather_ingestion_gap_seconds', 'producer_consumer', '>', 120.0, 300, 'warning'), "
        "('KubernetesDeploymentUnavailable', 'kube_deployment_status_replicas_unavailable', NULL, '>', 0.0, 300, 'warning')")
    q["alert_rules"] = (
        "WITH samples AS (SELECT event_id AS sample_id, "
        "CASE event_id % 4 WHEN 0 THEN 'up' WHEN 1 THEN 'weather_database_up' "
        "WHEN 2 THEN 'weather_ingestion_requires_backfill' ELSE 'weather_ingestion_gap_seconds' END AS metric, "
        "CASE event_id % 8 WHEN 0 THEN 'weather-api' WHEN 4 THEN 'other' WHEN 3 THEN 'producer_consumer' "
        "WHEN 7 THEN 'source_database' END AS label, event_type AS instance, ts, "
        "CASE WHEN event_id % 4 < 2 THEN (CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END) "
        "WHEN event_id % 4 = 2 THEN (CASE WHEN event_type IN ('click', 'error') "
        "AND ts >= TIMESTAMP '2024-01-28 00:00:00' THEN 1.0 ELSE 0.0 END) ELSE value END AS value FROM events), "
        f"rules AS (SELECT * FROM (VALUES {rules}) t(alert, metric, label, op, threshold, for_seconds, severity)), "
        "flagged AS (SELECT r.alert, r.severity, r.for_seconds, s.instance, s.ts, s.sample_id, "
        "  CASE r.op WHEN '==' THEN s.value = r.threshold WHEN '>' THEN s.value > r.threshold "
        "  WHEN '<' THEN s.value < r.threshold WHEN '>=' THEN s.value >= r.threshold "
        "  WHEN '<=' THEN s.value <= r.threshold WHEN '!=' THEN s.value <> r.threshold END AS flag "
        "  FROM samples s JOIN rules r ON r.metric = s.metric AND (r.label IS NULL OR r.label = s.label)), "
        "lagged AS (SELECT *, lag(flag) OVER w AS pf, lag(ts) OVER w AS pts FROM flagged "
        "  WINDOW w AS (PARTITION BY alert, instance ORDER BY ts, sample_id)), "
        f"started AS (SELECT *, CASE WHEN coalesce(flag, false) AND (NOT coalesce(pf, false) "
        f"  OR date_diff('microsecond', pts, ts) > {STALENESS_SECONDS * 1_000_000}) THEN 1 ELSE 0 END AS st FROM lagged), "
        "isl AS (SELECT *, sum(st) OVER (PARTITION BY alert, instance ORDER BY ts, sample_id "
        "  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM started) "
        "SELECT alert, severity, instance, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS samples, "
        + R("date_diff('microsecond', min(ts), max(ts)) / 1e6", "duration_seconds") + ", "
        "date_diff('microsecond', min(ts), max(ts)) / 1e6 >= max(for_seconds) AS fired "
        "FROM isl WHERE coalesce(flag, false) GROUP BY alert, severity, instance, island")
    q["restart_alerts"] = _with(LOG, COUNTER).rstrip() + ",\n" + (
        "inc AS (SELECT route, request_id, ts, sum(delta) OVER (PARTITION BY route ORDER BY ts "
        "  RANGE BETWEEN INTERVAL 600 SECOND PRECEDING AND CURRENT ROW) > 0 AS flag FROM d2), "
        "lagged AS (SELECT *, lag(flag) OVER w AS pf, lag(ts) OVER w AS pts FROM inc "
        "  WINDOW w AS (PARTITION BY route ORDER BY ts, request_id)), "
        "started AS (SELECT *, CASE WHEN flag AND (NOT coalesce(pf, false) "
        "  OR date_diff('microsecond', pts, ts) > 300000000) THEN 1 ELSE 0 END AS st FROM lagged), "
        "isl AS (SELECT *, sum(st) OVER (PARTITION BY route ORDER BY ts, request_id "
        "  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM started) "
        "SELECT route, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS samples, "
        + R("date_diff('microsecond', min(ts), max(ts)) / 1e6", "duration_seconds") + ", "
        "date_diff('microsecond', min(ts), max(ts)) / 1e6 >= 300 AS fired "
        "FROM isl WHERE flag GROUP BY route, island")
    q["status_tiles"] = _with(LOG) + (
        "SELECT method, up AS last_value, ts AS last_ts, CASE up WHEN 0 THEN 'DOWN' WHEN 1 THEN 'UP' END AS text "
        "FROM (SELECT *, row_number() OVER (PARTITION BY method ORDER BY ts DESC, request_id DESC) AS rn FROM ("
        "  SELECT method, ts, request_id, CASE WHEN request_id % 5 = 0 THEN NULL "
        "         ELSE CAST(status <> '500' AS INTEGER) END AS up FROM log) WHERE up IS NOT NULL) WHERE rn = 1")
    q["gauge_sum"] = (
        f"SELECT pod, {R('sum(v)', 'gauge_sum')}, count(*) AS series FROM ("
        "SELECT pod, container, v FROM (SELECT event_type AS pod, user_id % 3 AS container, value * 1000 AS v, "
        "row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY ts DESC, event_id DESC) AS rn FROM events) "
        "WHERE rn = 1) GROUP BY pod")
    q["stream_lag"] = (
        "SELECT 'weather' AS topic, count(*) AS partitions, CAST(sum(end_offset) AS BIGINT) AS end_offset_total, "
        "CAST(sum(committed_offset) AS BIGINT) AS committed_offset_total, "
        "CAST(sum(end_offset - coalesce(committed_offset, 0)) AS BIGINT) AS lag FROM ("
        "SELECT CAST(event_id % 3 AS INTEGER) AS partition, max(event_id) + 1 AS end_offset, "
        "max(CASE WHEN ts < TIMESTAMP '2024-01-29 00:00:00' THEN event_id END) + 1 AS committed_offset "
        "FROM events GROUP BY 1)")
    return q
