"""skyroll: time-series ingestion and trailing roll-ups on Spark DataFrames.

Layout
------
- ``skyroll.schema``      fixed schema, metric maps, roll-up windows
- ``skyroll.session``     session defaults and checkpoint folder
- ``skyroll.functions``   column expressions (time parse, keys, gaps, format)
- ``skyroll.sources``     line files, listing pages, Kafka rows, test-table adapters
- ``skyroll.operators``   parse, upsert, roll-up, progress marks, monitoring, chunked series
- ``skyroll.plans``       user-level queries, jobs (producer, backfill, report),
                          the named query catalog and its DuckDB oracle
- ``skyroll.streaming``   plain tables written run by run, the micro-batch ingest, the live roll-up
"""

__version__ = "0.1.0"
