"""Adapters from the provided test tables to the library's input shapes.

The ``events`` table (event_id, ts, user_id, event_type, value, props) is reshaped
into station observations, raw JSON lines, Kafka-shaped rows, progress marks and a
request log by fixed column rules, so every query's work grows with ``events``.
The rules are documented in FIXTURES.md §2; the DuckDB oracle applies the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.operators import series as S
from skyroll.functions.time import floor_to_bucket, ntz, yyyymmdd
from skyroll.schema import WEATHER_COLUMNS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def observation_columns(e: DataFrame) -> list[Column]:
    eid, v, uid = F.col("event_id"), F.col("value"), F.col("user_id")
    tempb = F.when(eid % 4 == 0, F.lit(None).cast("double")).otherwise(v / 2)
    pres = (F.lit(101325) + eid % 500).cast("bigint")
    lux = eid % 1000
    hum = (uid % 100).cast("double")
    return [
        F.col("event_type").alias("station"),
        floor_to_bucket(F.col("ts"), 60).alias("dt"),
        (v / 10).alias("vel_avg_mph"), (v / 20).alias("vel_min_mph"), (v / 5).alias("vel_max_mph"),
        F.get_json_object("props", "$.k").cast("bigint").alias("dir_avg_deg"),
        v.alias("temps_avg_f"), (v - 1).alias("temps_min_f"), (v + 1).alias("temps_max_f"),
        tempb.alias("tempb_avg_f"), (tempb - 0.5).alias("tempb_min_f"), (tempb + 0.5).alias("tempb_max_f"),
        hum.alias("hum_avg_pct"), (hum - 1).alias("hum_min_pct"), (hum + 1).alias("hum_max_pct"),
        pres.alias("pres_avg_pa"), (pres - 10).alias("pres_min_pa"), (pres + 10).alias("pres_max_pa"),
        lux.alias("lux_avg_lx"), (lux - 5).alias("lux_min_lx"), (lux + 5).alias("lux_max_lx"),
        (eid % 3).alias("rain_inc_count"), (v / 1000).alias("rain_inc_in"),
        eid.alias("uptime_seconds"), (eid * 1000).alias("millis"),
        F.concat(F.lit("10.0.0."), (uid % 250).cast("string")).alias("node_ip"),
        F.lit("net").alias("wifi_ssid"),
        F.col("event_type").alias("hostname"),
        F.lit("127.0.0.1").alias("server_rmt_ip"),
        F.col("ts").alias("server_svr_dt"),
    ]


def observations(e: DataFrame) -> DataFrame:
    """Typed observations with ``arrival`` (stands for the Kafka offset)."""
    return e.select(F.col("event_id").alias("arrival"), *observation_columns(e))


def is_stored(arrival="arrival") -> Column:
    """Upsert split: rows already stored (the rest arrive as the new batch)."""
    return F.col(arrival) % 10 < 7


def raw_lines(e: DataFrame, keep_ts: bool = False) -> DataFrame:
    """One JSON text line per event, as a station's daily file would hold it:
    columns ``station_dir, file_name, arrival, line``. Bad lines by fixed rule:
    ``event_id % 97`` = 0 unparseable, = 1 bad ``dt``, = 2 no station/hostname."""
    eid = F.col("event_id")
    zone = (F.when(eid % 3 == 0, F.lit("-0400"))
            .when(eid % 3 == 1, F.lit("-04:00")).otherwise(F.lit("")))
    dt_text = F.when(eid % 97 == 1, F.lit("junk")).otherwise(
        F.concat(F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ss"), zone))
    no_station = eid % 97 == 2
    obj = F.struct(
        dt_text.alias("dt"),
        F.when(~no_station, F.col("station")).alias("station"),
        *[F.col(c) for c in WEATHER_COLUMNS[2:23]],
        F.struct(
            F.col("uptime_seconds"), F.col("millis"), F.col("node_ip").alias("ip"),
            F.col("wifi_ssid"), F.when(~no_station, F.col("hostname")).alias("hostname"),
        ).alias("node"),
        F.struct(
            F.col("server_rmt_ip").alias("rmt_ip"),
            F.date_format("server_svr_dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("svr_dt"),
        ).alias("server"),
    )
    line = F.when(eid % 97 == 0, F.lit("{bad")).otherwise(F.to_json(obj))
    out = [
        F.col("event_type").alias("station_dir"),
        F.concat(yyyymmdd("dt"), F.lit(".txt")).alias("file_name"),
        F.col("event_id").alias("arrival"),
        line.alias("line"),
    ] + ([F.col("server_svr_dt").alias("ts")] if keep_ts else [])
    return e.select("event_id", "event_type", *observation_columns(e)).select(*out)


def index_pages(e: DataFrame) -> DataFrame:
    """One index page ``(page_id, html)`` per event: links to its day's files in all quotings, and to files that aren't daily ones."""
    day = F.date_format("ts", "yyyyMMdd")
    html = F.concat(F.lit('<html><a href="../">up</a><a href="'), day, F.lit('.txt">day</a><A class=x HREF=\''), day,
                    F.lit("_a&amp;b.txt'>part</A><a href="), day, F.lit('.csv>csv</a><a href="old/'), day,
                    F.lit('.txt">old</a><a href="'), F.substring(day, 1, 7), F.lit('.txt">short</a><a href="'), day,
                    F.lit('.txt.gz">packed</a><p data-href="'), day, F.lit('.txt">'), day, F.lit(".txt</p><a id=z href="), day,
                    F.col("event_type"), F.lit(".txt>named</a></html>"))
    return e.select(F.col("event_id").alias("page_id"), html.alias("html"))


def reading_generations(e: DataFrame) -> list[DataFrame]:
    """Events as readings of two generations: stored ones in a narrow schema, later ones with new nested fields and wider types."""
    eid = F.col("event_id")
    key = [eid.alias("arrival"), F.col("event_type").alias("station")]
    narrow = F.struct((F.col("user_id") % 100).cast("int").alias("avg"), F.struct((eid % 360).cast("int").alias("deg")).alias("dir"))
    wide = F.struct(F.col("value").cast("double").alias("avg"),
                    F.struct((eid + 5_000_000_000).alias("deg"), (eid % 7 == 0).alias("gust")).alias("dir"))
    lux = F.col("value") / 2
    return [
        e.filter(is_stored("event_id")).select(*key, F.when(eid % 5 != 0, narrow).alias("wind"), F.array((eid % 1000).cast("int")).alias("lux")),
        e.filter(~is_stored("event_id")).select(*key, wide.alias("wind"), F.array(lux, lux + 1).alias("lux"),
                                                F.col("value").alias("rain"), F.col("event_type").alias("power")),
    ]


def kafka_rows(e: DataFrame, topic: str = "weather") -> DataFrame:
    """Kafka-shaped rows ``(key, value, topic, partition, offset, timestamp)``
    carrying the raw lines; one partition as configured by the source system."""
    lines = raw_lines(e, keep_ts=True)
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("line").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("arrival").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def _mark_columns():
    t, et, eid = F.col("ts"), F.col("event_type"), F.col("event_id")
    not_view = et != "view"
    consumed = not_view & ((et != "error") | (t < ntz("2024-01-29 00:00:00")))
    return [
        F.max(F.when(not_view, t)).alias("source_latest_ts"),
        F.max(F.when(not_view & (eid % 7 != 1), t)).alias("producer_latest_ts"),
        F.max(F.when(consumed, t)).alias("consumer_latest_ts"),
        F.max(F.when(et == "signup", F.lit(None).cast("timestamp_ntz"))
              .when(et.isin("click", "error") & (t >= ntz("2024-01-28 00:00:00")), F.lit(None).cast("timestamp_ntz"))
              .otherwise(t)).alias("database_latest_ts"),
        F.max(F.when(consumed, eid)).alias("kafka_offset"),
    ]


def ingestion_state(e: DataFrame) -> DataFrame:
    """A full ``ingestion_state`` table built from the marks in one aggregate:
    partition 0, the last consumed offset, status 'streaming', never reconciled."""
    return e.groupBy(F.col("event_type").alias("station")).agg(*_mark_columns()).select(
        "station", "source_latest_ts", "producer_latest_ts", "consumer_latest_ts", "database_latest_ts",
        F.lit(0).cast("int").alias("kafka_partition"),
        "kafka_offset",
        F.lit("streaming").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("last_reconciliation_at"),
    )


def request_log(e: DataFrame) -> DataFrame:
    """API request log: ``request_id, ts, method, route, status, duration_seconds``."""
    return e.select(
        F.col("event_id").alias("request_id"),
        F.col("ts"),
        F.when(F.col("user_id") % 2 == 0, F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
        F.col("event_type").alias("route"),
        F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")).alias("status"),
        (F.col("value") / 100).alias("duration_seconds"),
    )


def counter_samples(log: DataFrame, series: tuple[str, ...] | list[str] = ("route",), reset_every: int = 50,
                    chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS, keep_keys: bool = False) -> DataFrame:
    """A cumulative request counter per series sampled at each request, made to
    reset to zero every ``reset_every`` requests (a restarted process).
    ``keep_keys`` keeps the (series, chunk) partition columns for a chained
    ``counter_increase`` / ``counter_rate`` with the same series and chunk width."""
    d = S.running_sum(log.select(*series, "request_id", "ts"), list(series), "ts", ["request_id"],
                      F.lit(1), "_n", chunk_seconds, keep_keys=keep_keys)
    return d.withColumn("counter", (F.col("_n") % reset_every).cast("double")).drop("_n")


def metric_samples(e: DataFrame) -> DataFrame:
    """Long-format metric samples ``(sample_id, metric, labels, instance, ts, value)``:
    each event is one sample of one of four gauges (by ``event_id % 4``) for the
    instance ``event_type``: api up (0 for error requests), database up (same
    rule), requires-backfill (1 for click/error from Jan 28, when their database
    mark stops) and a gap in seconds (the event value). Every other up sample is of
    another job and every other gap of another stage."""
    eid, et, t = F.col("event_id"), F.col("event_type"), F.col("ts")
    metric = (F.when(eid % 4 == 0, F.lit("up")).when(eid % 4 == 1, F.lit("weather_database_up"))
              .when(eid % 4 == 2, F.lit("weather_ingestion_requires_backfill"))
              .otherwise(F.lit("weather_ingestion_gap_seconds")))
    down = F.when(et == "error", F.lit(0.0)).otherwise(F.lit(1.0))
    behind = F.when(et.isin("click", "error") & (t >= ntz("2024-01-28 00:00:00")), F.lit(1.0)).otherwise(F.lit(0.0))
    value = F.when(eid % 4 < 2, down).when(eid % 4 == 2, behind).otherwise(F.col("value"))
    mine = eid % 8 < 4
    label = (F.when(eid % 4 == 0, F.create_map(F.lit("job"), F.when(mine, F.lit("weather-api")).otherwise(F.lit("other"))))
             .when(eid % 4 == 3, F.create_map(F.lit("stage"), F.when(mine, F.lit("producer_consumer"))
                                              .otherwise(F.lit("source_database"))))
             .otherwise(F.create_map().cast("map<string,string>")))
    return e.select(eid.alias("sample_id"), metric.alias("metric"), label.alias("labels"), et.alias("instance"), t.alias("ts"),
                    value.alias("value"))
