"""The cases FIXTURES.md documents for sf0.01 (checked there in Spark and DuckDB)."""

from skyroll.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_status_cases(spark):
    st = {r.station: r for r in QUERIES["ingestion_status"](spark, SF).collect()}
    assert st["click"].source_database_gap_seconds == 258868
    assert (st["error"].source_database_gap_seconds, st["error"].producer_consumer_gap_seconds) == (257833, 170675)
    assert st["purchase"].requires_backfill is False
    assert st["view"].requires_backfill is None
    rec = {r.station: r.status for r in QUERIES["reconciliation_status"](spark, SF).collect()}
    assert rec == {"click": "database_gap_detected", "error": "database_gap_detected", "purchase": "healthy",
                   "signup": "database_empty", "view": "healthy"}


def test_keyed_row_count(spark):
    assert QUERIES["upsert_observations"](spark, SF).count() == 9788
    assert QUERIES["rollup_all"](spark, SF).count() == 13018
