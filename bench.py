"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and forces full execution through the ``noop`` sink
(every row computed, nothing collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyroll.plans.catalog import QUERIES  # noqa: E402
from skyroll.session import build_session  # noqa: E402

HEADLINE = (
    "rollup_all",
    "rollup_day",
    "upsert_observations",
    "latest_per_station",
    "parse_observations",
    "backfill_window",
    "ingestion_status",
    "counter_rate",
    "error_ratio",
    "sustained_alerts",
    "inflight_gauge",
    "duration_histogram",
    "request_rate",
    "alert_rules",
)


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", app_name="skyroll-bench", shuffle_partitions=max(cpus, 2),
                          extra={"spark.driver.memory": "8g"})
    run(spark, "latest_per_station", sf_dir)  # warm-up: JVM, codegen caches, file listing
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times, cold = {}, {}
    for name in names:
        t = [run(spark, name, sf_dir) for _ in range(runs)]
        cold[name] = round(t[0], 3)
        times[name] = round(min(t), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "timing": f"best of {runs} runs per query (noop sink, full execution); first runs in 'cold'",
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
