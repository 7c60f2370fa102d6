import datetime as dt

from pyspark.sql import functions as F

from skyroll.functions.time import epoch_seconds, floor_to_bucket, iso_text, parse_local_ts
from skyroll.operators.progress import gap_seconds_bigint


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_parse_local_ts_forms(spark):
    texts = ["2024-07-01T12:34:56-0400", "2024-07-01T12:34:56-04:00", "2024-07-01T12:34:56Z",
             "2024-07-01T12:34:56.5-04:00", "2024-07-01T12:34:56", "", None, "junk", "2024",
             "20240701T120000", " 2024-07-01T12:34:56+0530 ", "2024-07-01 12:34:56", "2024-07-01_12:34:56Z"]
    got = _one(spark, [(t,) for t in texts], "s string", parse_local_ts(F.col("s")))
    wall = dt.datetime(2024, 7, 1, 12, 34, 56)
    assert got == [wall, wall, wall, wall.replace(microsecond=500000), wall, None, None, None, None,
                   dt.datetime(2024, 7, 1, 12, 0, 0), None, wall, wall]


def test_parse_local_ts_as_the_standard_library(spark):
    texts = ["2024-W05-3", "2024-W05", "2024W053T12:00:00", "2020-W53-7T01:02:03Z", "2021-W53-1", "2024-W00-1", "2024-W05-8", "2024-W053",
             "2024-07-01T12:34:56,5", "2024-07-01T12:34:56.1234567", "2024-07-01T12:34:56+05:30:15", "2024-07-01T12:34:56-23:59",
             "2024-07-01T12:34:56+24:00", "2024-07-01T12:34:56+05:60", " 2024-07-01", "2024-07-01 ", "2024-02-30", "2024-07-01T25:00",
             "2024-07-01T12", "2024-07-01T12:3", "20240701", "20240701T1234", "2024-07-01x12:00", "1999-W52-7", "2015-W01-1T00:00:00.000001Z"]
    def want(t):
        try:
            return dt.datetime.fromisoformat(t).replace(tzinfo=None)
        except ValueError:
            return None
    got = _one(spark, [(t,) for t in texts], "s string", parse_local_ts(F.col("s")))
    assert dict(zip(texts, got)) == {t: want(t) for t in texts}


def test_iso_text_fraction(spark):
    rows = [(dt.datetime(2024, 7, 1, 12, 0, 0),), (dt.datetime(2024, 7, 1, 12, 0, 0, 5),)]
    got = _one(spark, rows, "t timestamp_ntz", iso_text(F.col("t")))
    assert got == ["2024-07-01T12:00:00", "2024-07-01T12:00:00.000005"]


def test_floor_to_bucket_before_and_after_origin(spark):
    rows = [(dt.datetime(1999, 12, 31, 23, 58),), (dt.datetime(2024, 1, 1, 0, 7, 59),)]
    got = _one(spark, rows, "t timestamp_ntz", floor_to_bucket(F.col("t"), 300))
    assert got == [dt.datetime(1999, 12, 31, 23, 55), dt.datetime(2024, 1, 1, 0, 5)]


def test_floor_and_epoch_are_independent_of_session_zone(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 47),), (dt.datetime(2024, 7, 1, 2, 31, 5, 7),), (dt.datetime(1999, 12, 31, 23, 58),)]
    want_floor = [dt.datetime(2024, 1, 1, 10, 45), dt.datetime(2024, 7, 1, 2, 30), dt.datetime(1999, 12, 31, 23, 45)]
    want_epoch = [1704106020.0, 1719801065.000007, 946684680.0]
    for zone in ("Asia/Kolkata", "America/New_York", "Australia/Lord_Howe"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = spark.createDataFrame(rows, "t timestamp_ntz").select(
                floor_to_bucket(F.col("t"), 900).alias("f"), epoch_seconds(F.col("t")).alias("e")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [r.f for r in got] == want_floor, zone
        assert [r.e for r in got] == want_epoch, zone


def test_gap_rounds_half_away_and_clamps(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=1.5), base), (base + dt.timedelta(seconds=2.5), base),
            (base, base + dt.timedelta(seconds=3)), (None, base)]
    got = _one(spark, rows, "a timestamp_ntz, b timestamp_ntz", gap_seconds_bigint(F.col("a"), F.col("b")))
    assert got == [2, 3, 0, 0]
