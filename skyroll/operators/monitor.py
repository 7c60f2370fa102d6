"""Monitoring operators over request logs and metric samples.

Re-aimed from metric exposition and alert rules to DataFrame jobs: request
counters, duration histogram, in-flight gauge, counter increase/rate with
resets, error ratio, sustained (``for: N``) alerts, last-value tiles, gauge
sums and stream lag. Ordered per-series work goes through the chunked helpers
in :mod:`skyroll.operators.series`, so a hot series never lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyroll.functions.time import floor_to_bucket, seconds_between
from skyroll.operators import series as S
from skyroll.schema import ALERT_RULES, RESTART_FOR_SECONDS, RESTART_RANGE_SECONDS, DURATION_BUCKETS, STALENESS_SECONDS


def request_counts(log: DataFrame) -> DataFrame:
    """``requests_total`` by method, route, status."""
    return log.groupBy("method", "route", "status").agg(F.count(F.lit(1)).alias("requests_total"))


def duration_histogram(log: DataFrame, bounds: Sequence[float] = DURATION_BUCKETS) -> DataFrame:
    """Cumulative ``le`` buckets per (method, route) plus sum and count.

    Each request contributes to every bucket at or above its duration; the
    counts are built as one partial aggregate (a sum of indicators per bound)
    and unpivoted, so rows are not multiplied before the shuffle."""
    d = F.col("duration_seconds")
    aggs = [F.sum(F.when(d <= F.lit(float(b)), 1).otherwise(0)).alias(f"_le{i}") for i, b in enumerate(bounds)]
    aggs += [F.count(F.lit(1)).alias("_inf"), F.sum(d).alias("duration_sum"), F.count(F.lit(1)).alias("duration_count")]
    wide = log.groupBy("method", "route").agg(*aggs)
    labels = [(repr(float(b)) if float(b) != int(b) else f"{float(b):.1f}", f"_le{i}") for i, b in enumerate(bounds)]
    pairs = F.array(*[F.struct(F.lit(lbl).alias("le"), F.col(c).cast("bigint").alias("n")) for lbl, c in labels]
                    + [F.struct(F.lit("+Inf").alias("le"), F.col("_inf").cast("bigint").alias("n"))])
    return wide.select("method", "route", F.explode(pairs).alias("b"), "duration_sum", "duration_count").select(
        "method", "route", F.col("b.le").alias("le"), F.col("b.n").alias("bucket_count"),
        "duration_sum", "duration_count")


def inflight_gauge(log: DataFrame, chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Requests in progress per method: +1 at start, -1 at end (start +
    duration), running sum ordered by time; at equal times ends come first."""
    end = F.timestamp_add("MICROSECOND", F.round(F.col("duration_seconds") * 1_000_000).cast("bigint"), F.col("ts"))
    edges = log.select("method", "request_id", F.explode(F.array(
        F.struct(F.col("ts").alias("at"), F.lit(1).alias("delta")),
        F.struct(end.alias("at"), F.lit(-1).alias("delta")),
    )).alias("e")).select("method", "request_id", F.col("e.at").alias("edge_ts"), F.col("e.delta").alias("delta"))
    return S.running_sum(edges, ["method"], "edge_ts", ["delta", "request_id"], "delta", "in_flight", chunk_seconds)


def counter_deltas(samples: DataFrame, series: Sequence[str], value: str = "counter",
                   chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Non-negative per-sample increase: ``v - prev``; after a reset (``v < prev``)
    the post-reset value ``v``; the first sample of a series adds 0."""
    d = S.previous_values(samples, list(series), "ts", ["request_id"], [value], "_p_", chunk_seconds)
    v, p = F.col(value), F.col(f"_p_{value}")
    delta = F.when(p.isNull(), F.lit(0.0)).when(v < p, v).otherwise(v - p)
    return d.withColumn("delta", delta).drop(f"_p_{value}")


def counter_increase(samples: DataFrame, series: Sequence[str], range_seconds: int, out: str,
                     value: str = "counter", chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """``increase(counter[range])`` at every sample: the sum of reset-corrected
    deltas of samples in ``[ts - range, ts]`` (no edge extrapolation)."""
    d = counter_deltas(samples, series, value, chunk_seconds)
    return S.trailing_sum(d, list(series), "ts", "delta", out, range_seconds, chunk_seconds).drop("delta")


def counter_rate(samples: DataFrame, series: Sequence[str], range_seconds: int, out: str,
                 value: str = "counter", chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """``rate(counter[range])`` = increase / range seconds."""
    inc = counter_increase(samples, series, range_seconds, "_inc", value, chunk_seconds)
    return inc.withColumn(out, F.col("_inc") / F.lit(float(range_seconds))).drop("_inc")


def rate_by_labels(samples: DataFrame, series: Sequence[str], by: Sequence[str], range_seconds: int = 300,
                   step_seconds: int = 60, value: str = "counter",
                   chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """``sum by (by) (rate(counter[range]))`` evaluated every ``step_seconds``:
    reset-corrected deltas per series, then each delta is added to the
    ``range / step`` grid windows ``(end - range, end]`` that hold it, and one
    partial aggregate sums them per label set and window end."""
    if range_seconds % step_seconds:
        raise ValueError("range must be a multiple of the step")
    k = range_seconds // step_seconds
    d = counter_deltas(samples, series, value, chunk_seconds)
    floor = floor_to_bucket("ts", step_seconds)
    first_end = F.when(floor == F.col("ts"), floor).otherwise(F.timestamp_add("SECOND", F.lit(step_seconds), floor))
    ends = F.array(*[F.timestamp_add("SECOND", F.lit(i * step_seconds), first_end) for i in range(k)])
    tagged = d.select(*by, F.explode(ends).alias("eval_ts"), "delta")
    return (tagged.groupBy(*by, "eval_ts")
            .agg((F.sum("delta") / F.lit(float(range_seconds))).alias(f"rate_{range_seconds // 60}m")))


def range_vector(samples: DataFrame, series: Sequence[str], range_seconds: int, step_seconds: int,
                 value: str = "counter", tiebreak: str = "request_id",
                 chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """``increase(counter[range])`` and ``rate(counter[range])`` of each series at every step of a grid.

    The evaluation times are the multiples of ``step_seconds`` from a series'
    first sample to the last whose window ``(eval - range, eval]`` holds one.
    The reset-corrected increase from the window's first to its last sample is
    extrapolated to the window's ends: up to the whole distance where it is
    below 1.1 of the mean distance of the samples, otherwise by half of that
    mean, and never back beyond the time at which the counter was zero. A window with fewer than two samples, or
    all of one time, has NULLs. Each (series, step) is first summed up by one
    partial aggregate; a window merges ``range / step`` of these."""
    if range_seconds % step_seconds:
        raise ValueError("range must be a multiple of the step")
    d = counter_deltas(samples.select(*series, "ts", tiebreak, value).withColumnRenamed(tiebreak, "request_id"),
                       series, value, chunk_seconds)
    floor = floor_to_bucket("ts", step_seconds)
    end = F.when(floor == F.col("ts"), floor).otherwise(F.timestamp_add("SECOND", F.lit(step_seconds), floor))
    first = F.struct("ts", "request_id", F.col(value).alias("v"), F.col("delta").alias("d"))
    cells = d.groupBy(*series, end.alias("_end")).agg(
        F.min(first).alias("_first"), F.max("ts").alias("_last"), F.count(F.lit(1)).alias("_n"), F.sum("delta").alias("_sum"))
    # One row per series and evaluation time, empty or not: a cell counts in the windows of the steps after it.
    steps = range_seconds // step_seconds
    ends = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.timestamp_add("SECOND", i * step_seconds, F.col("_end")))
    merged = cells.withColumn("eval_ts", F.explode(ends)).groupBy(*series, "eval_ts").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("samples"), F.sum("_sum").alias("_sum"))
    span = cells.groupBy(*series).agg(F.min("_end").alias("_from"), F.max("_end").alias("_to"))
    span = span.withColumn("_to", F.timestamp_add("SECOND", F.lit(range_seconds - step_seconds), F.col("_to")))
    count = F.timestamp_diff("SECOND", F.col("_from"), F.col("_to")) / F.lit(step_seconds)
    grid = span.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long"))))
    grid = grid.select(*[F.col(c).alias(f"_g_{c}") for c in series],
                       F.timestamp_add("SECOND", F.col("_i") * step_seconds, F.col("_from")).alias("_g_ts"))
    match = F.col("eval_ts") == F.col("_g_ts")
    for c in series:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    j = grid.join(merged, match, "left")

    increase = F.col("_sum") - F.col("_first.d")
    start = F.timestamp_add("SECOND", F.lit(-range_seconds), F.col("_g_ts"))
    sampled = seconds_between(F.col("_last"), F.col("_first.ts"))
    mean = sampled / (F.col("samples") - 1)
    to_start, to_end = seconds_between(F.col("_first.ts"), start), seconds_between(F.col("_g_ts"), F.col("_last"))
    reach = lambda gap: F.when(gap >= mean * 1.1, mean / 2).otherwise(gap)
    to_zero = F.when((increase > 0) & (F.col("_first.v") >= 0), sampled * (F.col("_first.v") / increase))
    wide = sampled + F.least(reach(to_start), to_zero) + reach(to_end)
    extrapolated = F.when((F.col("samples") > 1) & (sampled > 0), increase * (wide / sampled))
    return j.select(*[F.col(f"_g_{c}").alias(c) for c in series], F.col("_g_ts").alias("eval_ts"),
                    F.coalesce("samples", F.lit(0)).alias("samples"), extrapolated.alias("increase"),
                    (extrapolated / F.lit(float(range_seconds))).alias("rate"))


def error_ratio(log: DataFrame, window_seconds: int = 300, step_seconds: int = 60,
                threshold: float = 0.05, floor: float = 0.001) -> DataFrame:
    """Per sliding window (``window_seconds`` long, every ``step_seconds``):
    5xx share of requests, denominator clamped at ``floor``; ``firing`` when
    above ``threshold``. Each request is tagged with the windows holding it
    (``window / step`` of them) and one partial aggregate follows."""
    k = window_seconds // step_seconds
    base = floor_to_bucket("ts", step_seconds)
    starts = F.array(*[F.timestamp_add("SECOND", F.lit(-i * step_seconds), base) for i in range(k)])
    tagged = log.select(F.explode(starts).alias("window_start"),
                        F.col("status").startswith("5").cast("int").alias("_err"))
    agg = tagged.groupBy("window_start").agg(F.count(F.lit(1)).alias("requests"), F.sum("_err").alias("errors"))
    ratio = F.col("errors").cast("double") / F.greatest(F.col("requests").cast("double"), F.lit(float(floor)))
    return agg.select("window_start",
                      F.timestamp_add("SECOND", F.lit(window_seconds), F.col("window_start")).alias("window_end"),
                      "requests", "errors", ratio.alias("error_ratio"), (ratio > F.lit(threshold)).alias("firing"))


def sustained(samples: DataFrame, series: Sequence[str], ts: str, tiebreak: Sequence[str], predicate: Column,
              for_seconds: int, max_gap_seconds: float | None = None,
              chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Alert islands: runs where ``predicate`` holds on consecutive samples
    (a gap over ``max_gap_seconds`` also ends a run). ``fired`` when the run
    lasts at least ``for_seconds`` (last minus first true sample)."""
    d = samples.withColumn("_flag", predicate)
    runs = S.islands(d, list(series), ts, list(tiebreak), "_flag", max_gap_seconds, chunk_seconds)
    dur = seconds_between(F.col("end_ts"), F.col("start_ts"))
    return runs.select(*series, "start_ts", "end_ts", "samples", dur.alias("duration_seconds"),
                       (dur >= F.lit(float(for_seconds))).alias("fired"))


def status_tiles(samples: DataFrame, series: Sequence[str], ts: str, tiebreak: Sequence[str], value: str,
                 mapping: dict | None = None) -> DataFrame:
    """Last non-NULL value per series and its text (0 -> DOWN, 1 -> UP)."""
    mapping = {0: "DOWN", 1: "UP"} if mapping is None else mapping
    order = F.struct(F.col(ts), *[F.col(c) for c in tiebreak])
    d = samples.filter(F.col(value).isNotNull())
    agg = d.groupBy(*series).agg(F.max_by(F.col(value), order).alias("last_value"), F.max(ts).alias("last_ts"))
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return agg.withColumn("text", F.create_map(*pairs)[F.col("last_value")])


def gauge_sum(samples: DataFrame, series: Sequence[str], by: Sequence[str], ts: str,
              tiebreak: Sequence[str], value: str) -> DataFrame:
    """``sum by (by) (gauge)``: the latest sample of each series, summed."""
    order = F.struct(F.col(ts), *[F.col(c) for c in tiebreak])
    cols = list(dict.fromkeys(list(series) + list(by)))
    last = samples.groupBy(*cols).agg(F.max_by(F.col(value), order).alias("_v"))
    return last.groupBy(*by).agg(F.sum("_v").alias("gauge_sum"), F.count(F.lit(1)).alias("series"))


def stream_lag(offsets: DataFrame) -> DataFrame:
    """Consumer lag per topic: sum over partitions of (end - committed)."""
    per_part = offsets.select("topic", "partition", "end_offset", "committed_offset",
                              (F.col("end_offset") - F.coalesce(F.col("committed_offset"), F.lit(0))).alias("lag"))
    return per_part.groupBy("topic").agg(F.count(F.lit(1)).alias("partitions"),
                                         F.sum("end_offset").alias("end_offset_total"),
                                         F.sum("committed_offset").alias("committed_offset_total"),
                                         F.sum("lag").alias("lag"))


def rules_frame(spark, rules=ALERT_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "alert string, metric string, matchers map<string,string>, op string, "
                                              "threshold double, for_seconds int, severity string")


def flagged(samples: DataFrame, rules: DataFrame) -> DataFrame:
    """The samples of each rule's metric whose label map has all its matchers' values, with ``_flag``: whether its
    predicate (``==``, ``>``, ``<``, ``>=``, ``<=``, ``!=`` against its threshold) holds. The rules table is joined by
    metric (a plain equi-join; it is tiny)."""
    j = samples.join(rules, "metric")
    wanted = F.forall(F.map_keys("matchers"), lambda k: F.col("labels")[k].eqNullSafe(F.col("matchers")[k]))
    v, t = F.col("value"), F.col("threshold")
    pred = (F.when(F.col("op") == "==", v == t).when(F.col("op") == ">", v > t).when(F.col("op") == "<", v < t)
            .when(F.col("op") == ">=", v >= t).when(F.col("op") == "<=", v <= t).when(F.col("op") == "!=", v != t))
    return j.filter(wanted).withColumn("_flag", pred)


def alert_rules(samples: DataFrame, rules: DataFrame, staleness_seconds: int = STALENESS_SECONDS,
                chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Evaluate threshold rules with ``for`` durations over long-format samples
    ``(sample_id, metric, labels, instance, ts, value)``. ``flagged`` samples make
    a series per (rule, instance); runs of true samples (a false sample or a stale gap
    ends a run) become alert islands, ``fired`` when the run lasts ``for``."""
    series = ["alert", "severity", "for_seconds", "instance"]
    runs = S.islands(flagged(samples, rules), series, "ts", ["sample_id"], "_flag", staleness_seconds, chunk_seconds)
    dur = seconds_between(F.col("end_ts"), F.col("start_ts"))
    return runs.select("alert", "severity", "instance", "start_ts", "end_ts", "samples",
                       dur.alias("duration_seconds"), (dur >= F.col("for_seconds")).alias("fired"))


def restart_alerts(samples: DataFrame, series: Sequence[str], value: str = "counter",
                   range_seconds: int = RESTART_RANGE_SECONDS, for_seconds: int = RESTART_FOR_SECONDS,
                   staleness_seconds: int = STALENESS_SECONDS, chunk_seconds: int = S.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """``increase(counter[range]) > 0`` that holds for ``for_seconds``, per series."""
    inc = counter_increase(samples, series, range_seconds, "_increase", value, chunk_seconds)
    return sustained(inc, series, "ts", ["request_id"], F.col("_increase") > 0, for_seconds, staleness_seconds, chunk_seconds)
