"""Spark result == DuckDB oracle (row count, columns, value hash) for a
representative query per operator family, at sf0.01. ``tools/check.py`` runs all."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import frame_hash  # noqa: E402
from skyroll.sources.testtables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.01"
NAMES = ["rollup_all", "rollup_incremental", "upsert_observations", "latest_merge", "parse_observations", "reject_rows",
         "backfill_window", "ingestion_status", "reconcile_merge", "history_chart", "conditions_card",
         "counter_rate", "request_rate", "rate_range", "sustained_alerts", "alert_rules", "duration_histogram", "listing_links",
         "daily_file_links", "schema_generations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    got = frame_hash(entry.queries()[name](spark, SF).toPandas())
    want = frame_hash(con.sql(entry.oracle_sql()[name]).df())
    assert got == want
