"""End to end: station files -> producer / backfill cycles -> file stand-in for
the topic -> streaming consume -> tables and the state report."""

import os
import tempfile

from pyspark.sql import functions as F

from skyroll.plans import jobs as J
from skyroll.sources.files import read_station_lines
from skyroll.sources import testtables as tt
from skyroll.streaming import ingest as I
from skyroll.streaming.tables import Tables

SF = "/root/testdata/sf0.001"


def file_sink(path, topic="weather"):
    """A stand-in for the Kafka sink in tests: appends Kafka-shaped rows to a
    folder the consume job can stream from. Offsets increase across calls."""
    counter = {"next": 0}

    def write(messages):
        base = counter["next"]
        rows = messages.select(
            "key", "value", F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
            (F.lit(base) + F.monotonically_increasing_id()).alias("offset"),
            F.current_timestamp().alias("timestamp"))
        rows = rows.persist()
        try:
            n = rows.count()
            if n:
                rows.coalesce(1).write.mode("append").parquet(path)
                counter["next"] = int(rows.agg(F.max("offset")).first()[0]) + 1
        finally:
            rows.unpersist()
    return write


def _write_station_files(root, rows):
    for r in rows:
        d = os.path.join(root, r.station_dir)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, r.file_name), "a") as f:
            f.write(r.line + "\n")


def _consume(spark, topic_dir, store_root, ckpt):
    stream = spark.readStream.schema(I.KAFKA_SCHEMA).parquet(topic_dir)
    q = I.start_ingest(spark, stream, store_root, ckpt, trigger={"availableNow": True})
    q.awaitTermination(300)


def test_producer_backfill_consume_cycle(spark):
    work = tempfile.mkdtemp(prefix="skyroll-jobs-", dir="/tmp")
    files, topic, ckpt = (os.path.join(work, d) for d in ("files", "topic", "ckpt"))
    ingest, producer, reconcile = (Tables(spark, os.path.join(work, d)) for d in ("ingest", "producer", "reconcile"))
    lines = tt.raw_lines(tt.events(spark, SF)).orderBy("arrival").collect()
    cut = "20240125.txt"
    _write_station_files(files, [r for r in lines if r.file_name < cut])
    sink = file_sink(topic)

    # Nothing stored yet: every station must be backfilled first.
    summary = J.publish_cycle(spark, read_station_lines(spark, files), ingest, producer, sink, 0).collect()
    assert {r.outcome for r in summary} == {"run_backfill_first"} and sum(r.published_count for r in summary) == 0

    J.backfill_cycle(spark, read_station_lines(spark, files), ingest, reconcile, sink, 0)
    _consume(spark, topic, ingest.root, ckpt)
    weather = I.read_weather(ingest)
    assert weather.count() > 0
    assert weather.agg(F.max("dt")).first()[0].strftime("%Y%m%d") < cut[:8]

    # New day files arrive: the producer publishes only rows after the resume point.
    _write_station_files(files, [r for r in lines if r.file_name >= cut])
    summary = {r.station: r for r in J.publish_cycle(spark, read_station_lines(spark, files), ingest, producer,
                                                      sink, 1).collect()}
    assert all(r.outcome == "ok" for r in summary.values()) and sum(r.published_count for r in summary.values()) > 0
    _consume(spark, topic, ingest.root, ckpt)

    latest = {r.station: r.dt for r in I.read_latest(ingest).collect()}
    assert max(latest.values()).strftime("%Y%m%d") >= cut[:8]
    report = {r.station: r for r in J.state_report(ingest, producer, reconcile).collect()}
    assert set(report) >= set(latest)
    for r in report.values():
        assert r.database_latest_ts is not None and r.producer_latest_ts is not None


def test_failing_sink_leaves_marks_and_reused_runs_are_refused(spark):
    import pytest
    work = tempfile.mkdtemp(prefix="skyroll-sink-", dir="/tmp")
    ingest, producer, reconcile = (Tables(spark, os.path.join(work, d)) for d in ("ingest", "producer", "reconcile"))
    rows = tt.kafka_rows(tt.events(spark, SF)).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    I.ingest_batch(ingest, rows.filter(F.col("offset") < 200), 0)
    lines = tt.raw_lines(tt.events(spark, SF))

    def fails(messages):
        messages.count()
        raise RuntimeError("broker gone")

    for job, store in ((J.publish_cycle, producer), (J.backfill_cycle, reconcile)):
        with pytest.raises(RuntimeError, match="broker gone"):
            job(spark, lines, ingest, store, fails, 5)
        assert store.runs().count() == 0
        sent = []
        job(spark, lines, ingest, store, lambda m: sent.append(m.count()), 5)
        before = store.runs().collect()
        for run in (5, 3):
            with pytest.raises(ValueError, match="newer"):
                job(spark, lines, ingest, store, lambda m: sent.append(m.count()), run)
        assert len(sent) == 1 and store.runs().collect() == before


def test_report_shows_the_last_writer(spark):
    import datetime as dt
    from skyroll.schema import STATE_SCHEMA
    work = tempfile.mkdtemp(prefix="skyroll-report-", dir="/tmp")
    ingest, reconcile = (Tables(spark, os.path.join(work, d)) for d in ("ingest", "reconcile"))
    day = lambda n: dt.datetime(2024, 1, n)

    def write(store, table, schema, writer, rows):
        full = [tuple(r.get(n) for n in schema.names) for r in rows]
        store.write(spark.createDataFrame(full, schema), table, writer, 0)
        store.finish(writer, 0)

    write(ingest, I.STATIONS, I._stations_schema(), "batch", [{"station": s, "dt": day(5)} for s in "ab"])
    write(reconcile, J.RECONCILE, STATE_SCHEMA, J.RECONCILE, [
        {"station": "a", "source_latest_ts": day(9), "database_latest_ts": day(6), "status": "database_gap_detected"},
        {"station": "b", "source_latest_ts": day(4), "database_latest_ts": day(4), "status": "database_gap_detected"}])
    got = {r.station: r for r in J.state_view(ingest, None, reconcile).collect()}
    assert (got["a"].status, got["a"].database_latest_ts) == ("database_gap_detected", day(6))
    assert (got["b"].status, got["b"].database_latest_ts) == ("streaming", day(5))  # the stream went on since
