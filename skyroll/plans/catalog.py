"""Named queries over the provided test tables: ``name -> f(spark, sf_dir)``.

Each entry composes library operators on data Spark derives from the tables
(mainly ``events``, reshaped by :mod:`skyroll.sources.testtables`), so its work
grows with them. DOUBLE outputs are rounded to 6 decimals
(``round(x * 1e6) / 1e6``) so results compare across engines; load-time
columns (``updated_at``) are left out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyroll.functions.text import event_key, first_present
from skyroll.functions.time import ntz, parse_local_ts
from skyroll.operators import evolve
from skyroll.operators import monitor as M
from skyroll.operators import progress as P
from skyroll.operators import rollup as R
from skyroll.operators import upsert as U
from skyroll.operators.parse import REASON, good_rows, parse_lines, reject_rows
from skyroll.plans import queries as Q
from skyroll.schema import ROLLUP_MEASURES, ROLLUP_WINDOWS, WEATHER_COLUMNS, WINDOWS_BY_NAME
from skyroll.sources import listing
from skyroll.sources import testtables as tt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed parameters of the registered queries.
AS_OF = "2024-02-01 00:00:00"


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    scale = float(10 ** digits)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append((F.round(F.col(f.name) * F.lit(scale)) / F.lit(scale)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Shared inputs
# ---------------------------------------------------------------------------

def _events(spark, sf):
    return tt.events(spark, sf)


def _obs(spark, sf):
    return tt.observations(_events(spark, sf))


def weather_table(obs: DataFrame, columns=None) -> DataFrame:
    """The keyed ``weather`` table: one row per (station, dt), later arrival wins."""
    cols = list(columns) if columns else list(WEATHER_COLUMNS)
    keep = list(dict.fromkeys(["station", "dt", "arrival"] + cols))
    return U.latest_wins(obs.select(*keep), ["station", "dt"], ["arrival"]).drop("arrival")


def _rollup_input(spark, sf, range_days: int):
    """The roll-up anchor and the keyed rows it needs. ``dt`` is the minute
    floor of ``ts``, so ``dt >= max - N days`` equals ``ts >= max - N days``
    (a day-aligned bound): that form is a plain column filter the Parquet scan
    applies itself (row-group skipping) before anything else runs."""
    e = _events(spark, sf)
    anchor = R.global_max(tt.observations(e).select("dt"))
    lo = R.lit_ts(anchor) if anchor is None else R.lit_ts(anchor - dt.timedelta(days=range_days))
    obs = tt.observations(e.filter(F.col("ts") >= lo))
    return anchor, weather_table(obs, ["station", "dt", *ROLLUP_MEASURES])


def _rollup_of(spark, sf, name: str) -> DataFrame:
    """One window's roll-up, from no more than that window's own range."""
    window = WINDOWS_BY_NAME[name]
    anchor, w = _rollup_input(spark, sf, window.range_days)
    return R.rollup_window(w, window, anchor)


def _rollups(spark, sf) -> DataFrame:
    anchor, w = _rollup_input(spark, sf, max(x.range_days for x in ROLLUP_WINDOWS))
    return R.rollups_single_pass(w, anchor)


def _split(spark, sf):
    obs = _obs(spark, sf)
    return obs.filter(tt.is_stored()), obs.filter(~tt.is_stored())


def _lines(spark, sf):
    return tt.raw_lines(_events(spark, sf))


def _parsed_writer(spark, sf):
    """Source lines as the writer reads them (station = hostname or the station dir)."""
    return good_rows(parse_lines(_lines(spark, sf), default_station="station_dir",
                                 keep=["station_dir", "file_name", "arrival"]))


def _state(spark, sf):
    return tt.ingestion_state(_events(spark, sf))


def _stored_for_repair(spark, sf):
    """What the database holds for the repair queries: rows below each
    station's database mark rule (none for signup; click/error up to Jan 28)."""
    e = _events(spark, sf)
    et, ts = F.col("event_type"), F.col("ts")
    held = (et != "signup") & ~(et.isin("click", "error") & (ts >= ntz("2024-01-28 00:00:00")))
    return tt.observations(e.filter(held)).select("station", "dt")


def _resume(spark, sf):
    stations = _lines(spark, sf).select(F.col("station_dir").alias("station")).distinct()
    stored, _ = _split(spark, sf)
    return P.resume_points(stations, _state(spark, sf), stored.select("station", "dt"))


# ---------------------------------------------------------------------------
# Roll-ups (A1-A8, X1, O2)
# ---------------------------------------------------------------------------

def _one_window(name):
    def q(spark, sf):
        return rounded(_rollup_of(spark, sf, name))
    return q


for _w in ROLLUP_WINDOWS:
    register(f"rollup_{_w.name}")(_one_window(_w.name))


@register("rollup_all")
def q_rollup_all(spark, sf):
    return rounded(_rollups(spark, sf))


@register("rollup_incremental")
def q_rollup_incremental(spark, sf):
    """The roll-up table refreshed from the partials of an earlier load: three
    later days and late readings of three days more are what has been written since."""
    e = _events(spark, sf)
    new = (F.col("ts") >= ntz("2024-01-29 00:00:00")) | ((F.col("event_id") % 20 == 0) & (F.col("ts") >= ntz("2024-01-26 00:00:00")))
    before = e.filter(~new)
    stored = R.partials(weather_table(tt.observations(before), ["station", "dt", *ROLLUP_MEASURES]),
                        R.global_max(tt.observations(before).select("dt")))
    anchor, weather = _rollup_input(spark, sf, max(x.range_days for x in ROLLUP_WINDOWS))
    parts = R.refresh_partials(stored, weather, tt.observations(e.filter(new)).select("station", "dt"), anchor)
    return rounded(R.rollups_from_partials(parts, weather, anchor))


@register("rollup_profile")
def q_rollup_profile(spark, sf):
    return R.rollup_profile(_rollups(spark, sf))


@register("recent_buckets")
def q_recent_buckets(spark, sf):
    return rounded(R.recent_buckets(_rollups(spark, sf), 10))


@register("latest_overall")
def q_latest_overall(spark, sf):
    return R.latest_overall(weather_table(_obs(spark, sf), ["station", "dt"]))


@register("load_profile")
def q_load_profile(spark, sf):
    return R.load_profile(weather_table(_obs(spark, sf), ["station", "dt"]))


# ---------------------------------------------------------------------------
# History and latest
# ---------------------------------------------------------------------------

@register("history_window")
def q_history_window(spark, sf):
    return rounded(Q.history(_rollup_of(spark, sf, "week"), "week"))


@register("history_metric")
def q_history_metric(spark, sf):
    return rounded(Q.history(_rollup_of(spark, sf, "month"), "month", metric="humidity", station="error"))


@register("history_chart")
def q_history_chart(spark, sf):
    return rounded(Q.chart_series(Q.history(_rollup_of(spark, sf, "day"), "day", metric="pressure"), "pressure"))


@register("latest_per_station")
def q_latest_per_station(spark, sf):
    return rounded(U.latest_per_station(_obs(spark, sf)))


@register("latest_metric")
def q_latest_metric(spark, sf):
    return rounded(Q.latest(U.latest_per_station(_obs(spark, sf)), metric="temperature"))


@register("conditions_card")
def q_conditions_card(spark, sf):
    return Q.conditions_card(U.latest_per_station(_obs(spark, sf)))


# ---------------------------------------------------------------------------
# Upserts (U1-U5, U9)
# ---------------------------------------------------------------------------

@register("upsert_observations")
def q_upsert(spark, sf):
    stored, batch = _split(spark, sf)
    return rounded(U.merge_upsert(weather_table(stored), batch, ["station", "dt"], ["arrival"]))


@register("latest_merge")
def q_latest_merge(spark, sf):
    stored, batch = _split(spark, sf)
    return rounded(U.merge_latest(U.latest_per_station(stored), batch))


@register("schema_evolve")
def q_schema_evolve(spark, sf):
    stored, batch = _split(spark, sf)
    old = U.latest_per_station(stored).drop("humidity", "pressure")
    target = [(f.name, f.dataType.simpleString()) for f in U.latest_per_station(stored).schema.fields]
    return rounded(U.merge_latest(U.evolve_schema(old, target), batch))


@register("schema_generations")
def q_schema_generations(spark, sf):
    rows = evolve.union_generations(tt.reading_generations(_events(spark, sf)))
    rows = rows.select("arrival", "station", F.col("wind.avg").alias("wind_avg"), F.col("wind.dir.deg").alias("wind_dir_deg"),
                       F.col("wind.dir.gust").alias("wind_dir_gust"), F.col("rain").isNull().alias("no_rain"),
                       F.element_at("lux", 1).alias("lux"), F.size("lux").alias("n_lux"), "power")
    return rounded(rows)


def _batch_with_new_station(spark, sf, station: str) -> DataFrame:
    """The batch half of the observations, in which ``station`` reports under a name the state doesn't have."""
    _, batch = _split(spark, sf)
    named = F.when(F.col("station") == station, F.concat("station", F.lit("-new"))).otherwise(F.col("station"))
    return batch.withColumn("station", named)


@register("consumer_marks")
def q_consumer_marks(spark, sf):
    batch = _batch_with_new_station(spark, sf, "signup")
    state = _state(spark, sf)
    msgs = batch.select("station", "dt", "arrival", F.lit(0).alias("partition"), F.col("arrival").alias("offset"))
    return U.consumer_marks(state, msgs)


@register("producer_marks")
def q_producer_marks(spark, sf):
    batch = _batch_with_new_station(spark, sf, "view")
    state = _state(spark, sf)
    return U.producer_marks(state, batch)


@register("reconcile_merge")
def q_reconcile_merge(spark, sf):
    state = _state(spark, sf)
    observed = P.observed_marks(P.source_latest(_lines(spark, sf)),
                                P.table_max(_stored_for_repair(spark, sf)))
    named = F.when(F.col("station") == "purchase", F.lit("purchase-new")).otherwise(F.col("station"))
    observed = observed.withColumn("station", named)
    return U.reconcile_marks(state, observed, ntz(AS_OF))


# ---------------------------------------------------------------------------
# Parsing, keys, rejects
# ---------------------------------------------------------------------------

@register("parse_observations")
def q_parse_observations(spark, sf):
    parsed = parse_lines(_lines(spark, sf), keep=["arrival"])
    return rounded(good_rows(parsed).drop("ingestion_mode"))


@register("reject_rows")
def q_reject_rows(spark, sf):
    parsed = parse_lines(_lines(spark, sf), keep=["arrival"])
    return reject_rows(parsed, keep=["arrival"]).select("arrival", REASON)


@register("event_keys")
def q_event_keys(spark, sf):
    p = _parsed_writer(spark, sf)
    return p.select("arrival", "station", "dt", event_key(F.col("station"), F.col("dt")).alias("event_key"))


@register("parse_local_ts")
def q_parse_local_ts(spark, sf):
    e = _events(spark, sf)
    eid = F.col("event_id")
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format("ts", ".SSSSSS")
    text = (F.when(eid % 97 == 1, F.lit("junk"))
            .when(eid % 97 == 2, F.date_format("ts", "yyyy"))
            .when(eid % 97 == 3, F.lit(""))
            .when(eid % 6 == 0, F.concat(base, F.lit("-0400")))
            .when(eid % 6 == 1, F.concat(base, F.lit("-04:00")))
            .when(eid % 6 == 2, F.concat(base, F.lit("Z")))
            .when(eid % 6 == 3, F.concat(base, frac, F.lit("+05:30")))
            .when(eid % 6 == 4, F.concat(base, frac))
            .otherwise(F.date_format("ts", "yyyyMMdd'T'HHmmss")))
    return e.select(eid.alias("arrival"), text.alias("dt_text"), parse_local_ts(text).alias("parsed_dt"))


@register("resolve_station")
def q_resolve_station(spark, sf):
    e = _events(spark, sf)
    eid, et = F.col("event_id"), F.col("event_type")
    st = F.when(eid % 5 == 0, F.lit("")).when(eid % 5 == 1, F.lit(None).cast("string")).otherwise(et)
    host = (F.when(eid % 3 == 0, F.lit("")).when(eid % 7 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(et, F.lit("-node"))))
    reader = first_present(st, host)
    return e.select(eid.alias("arrival"), reader.alias("station"),
                    F.coalesce(first_present(host), reader).alias("hostname"),
                    first_present(host, et).alias("writer_station"))


# ---------------------------------------------------------------------------
# Progress: status, gaps, resume, incremental, repair
# ---------------------------------------------------------------------------

@register("ingestion_status")
def q_ingestion_status(spark, sf):
    return P.ingestion_status(_state(spark, sf))


@register("reconciliation_status")
def q_reconciliation_status(spark, sf):
    return P.reconciliation_report(_state(spark, sf))


@register("ingestion_latest_epoch")
def q_latest_epoch(spark, sf):
    return rounded(P.latest_epochs(_state(spark, sf)))


@register("ingestion_gaps_long")
def q_gaps_long(spark, sf):
    return rounded(P.gaps_long(_state(spark, sf)))


@register("resume_points")
def q_resume_points(spark, sf):
    return _resume(spark, sf)


@register("pruned_files")
def q_pruned_files(spark, sf):
    files = _lines(spark, sf).select("station_dir", "file_name").distinct()
    return P.prune_files(files, _resume(spark, sf), "resume_ts")


@register("incremental_new")
def q_incremental_new(spark, sf):
    rows = P.incremental_rows(_lines(spark, sf), _resume(spark, sf))
    return rows.select("arrival", "station", "dt", event_key(F.col("station"), F.col("dt")).alias("event_key"))


@register("publish_summary")
def q_publish_summary(spark, sf):
    resume = _resume(spark, sf)
    return P.publish_summary(resume, P.incremental_rows(_lines(spark, sf), resume))


@register("source_latest")
def q_source_latest(spark, sf):
    return P.source_latest(_lines(spark, sf))


@register("backfill_window")
def q_backfill_window(spark, sf):
    lines = _lines(spark, sf)
    rows = P.backfill_rows(lines, P.table_max(_stored_for_repair(spark, sf)), P.source_latest(lines))
    return rows.select("arrival", "station", "dt", "ingestion_mode", "event_key")


# ---------------------------------------------------------------------------
# Listing pages
# ---------------------------------------------------------------------------

@register("listing_links")
def q_listing_links(spark, sf):
    pages = tt.read_table(spark, sf, "pages")
    return listing.listing_links(pages, prefix_regex="", suffix="")


@register("daily_file_links")
def q_daily_file_links(spark, sf):
    return listing.listing_links(tt.index_pages(_events(spark, sf)))


# ---------------------------------------------------------------------------
# Monitoring
# ---------------------------------------------------------------------------

def _log(spark, sf):
    return tt.request_log(_events(spark, sf))


@register("request_counts")
def q_request_counts(spark, sf):
    return M.request_counts(_log(spark, sf))


@register("duration_histogram")
def q_duration_histogram(spark, sf):
    return rounded(M.duration_histogram(_log(spark, sf)))


@register("inflight_gauge")
def q_inflight_gauge(spark, sf):
    return M.inflight_gauge(_log(spark, sf))


@register("counter_increase")
def q_counter_increase(spark, sf):
    samples = tt.counter_samples(_log(spark, sf), ["route"], keep_keys=True)
    return rounded(M.counter_increase(samples, ["route"], 900, "increase_15m"))


@register("counter_rate")
def q_counter_rate(spark, sf):
    samples = tt.counter_samples(_log(spark, sf), ["route"], keep_keys=True)
    return rounded(M.counter_rate(samples, ["route"], 300, "rate_5m"))


@register("request_rate")
def q_request_rate(spark, sf):
    series = ["method", "route", "status"]
    samples = tt.counter_samples(_log(spark, sf), series, keep_keys=True)
    return rounded(M.rate_by_labels(samples, series, ["route", "status"], 300, 60))


@register("rate_range")
def q_rate_range(spark, sf):
    series = ["method", "route", "status"]
    return rounded(M.range_vector(tt.counter_samples(_log(spark, sf), series), series, 3600, 900))


@register("error_ratio")
def q_error_ratio(spark, sf):
    return rounded(M.error_ratio(_log(spark, sf)))


@register("sustained_alerts")
def q_sustained_alerts(spark, sf):
    ratio = M.error_ratio(_log(spark, sf))
    runs = M.sustained(ratio, [], "window_start", [], F.col("firing"), for_seconds=300, max_gap_seconds=60)
    return rounded(runs)


@register("alert_rules")
def q_alert_rules(spark, sf):
    samples = tt.metric_samples(_events(spark, sf))
    return rounded(M.alert_rules(samples, M.rules_frame(spark)))


@register("restart_alerts")
def q_restart_alerts(spark, sf):
    samples = tt.counter_samples(_log(spark, sf), ["route"], keep_keys=True)
    return rounded(M.restart_alerts(samples, ["route"]))


@register("status_tiles")
def q_status_tiles(spark, sf):
    log = _log(spark, sf)
    up = F.when(F.col("request_id") % 5 == 0, F.lit(None).cast("int")) \
        .otherwise((F.col("status") != "500").cast("int"))
    samples = log.select("method", "ts", "request_id", up.alias("up"))
    return M.status_tiles(samples, ["method"], "ts", ["request_id"], "up")


@register("gauge_sum")
def q_gauge_sum(spark, sf):
    e = _events(spark, sf)
    samples = e.select(F.col("event_type").alias("pod"), (F.col("user_id") % 3).alias("container"),
                       "ts", "event_id", (F.col("value") * 1000).alias("working_set_bytes"))
    return rounded(M.gauge_sum(samples, ["pod", "container"], ["pod"], "ts", ["event_id"], "working_set_bytes"))


@register("stream_lag")
def q_stream_lag(spark, sf):
    e = _events(spark, sf)
    part = (F.col("event_id") % 3).cast("int")
    consumed = F.col("ts") < ntz("2024-01-29 00:00:00")
    offsets = e.groupBy(part.alias("partition")).agg(
        (F.max("event_id") + 1).alias("end_offset"),
        (F.max(F.when(consumed, F.col("event_id"))) + 1).alias("committed_offset"))
    return M.stream_lag(offsets.withColumn("topic", F.lit("weather")))
