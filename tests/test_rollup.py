import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyroll.operators import rollup as R
from skyroll.schema import ROLLUP_WINDOWS, WINDOWS_BY_NAME

MAX = dt.datetime(2024, 7, 10, 12, 0)


def _weather(spark, rows):
    return spark.createDataFrame(rows, "station string, dt timestamp_ntz, vel_avg_mph double, temps_avg_f double, "
                                       "tempb_avg_f double, hum_avg_pct double, pres_avg_pa long, "
                                       "lux_avg_lx long, rain_inc_in double")


def test_day_range_inclusive_ends(spark):
    rows = [("a", MAX, 1.0, 10.0, None, 1.0, 100, 1, 0.1),
            ("a", MAX - dt.timedelta(days=1), 1.0, 20.0, None, 1.0, 100, 1, 0.1),
            ("a", MAX - dt.timedelta(days=1, microseconds=1), 1.0, 30.0, None, 1.0, 100, 1, 0.1)]
    w = _weather(spark, rows)
    day = R.rollup_window(w, WINDOWS_BY_NAME["day"], R.global_max(w)).collect()
    assert sorted(r.temps_avg_f for r in day) == [10.0, 20.0]
    assert all(r.tempb_avg_f is None for r in day)


def test_all_null_bucket_and_sum(spark):
    rows = [("a", MAX, None, None, None, None, None, None, None),
            ("a", MAX, None, None, None, None, None, None, None)]
    w = _weather(spark, rows)
    r = R.rollup_window(w, WINDOWS_BY_NAME["year"], MAX).collect()[0]
    assert r.rain_inc_in is None and r.temps_avg_f is None


def test_single_pass_equals_union(spark):
    rows = []
    for i in range(400):
        t = MAX - dt.timedelta(minutes=37 * i)
        rows.append(("a" if i % 3 else "b", t, float(i), float(i % 7), None if i % 5 == 0 else 1.5,
                     float(i % 11), 100000 + i, i, i / 1000))
    w = _weather(spark, rows)
    m = R.global_max(w)
    a = sorted(map(tuple, R.rollups_single_pass(w, m, ROLLUP_WINDOWS).collect()))
    b = sorted(map(tuple, R.rollups_union(w, m, ROLLUP_WINDOWS).collect()))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:3] == y[:3]
        for u, v in zip(x[3:], y[3:]):
            assert (u is None and v is None) or abs(u - v) < 1e-9


def _same(got, want):
    got, want = ({tuple(r[:3]): tuple(r[3:]) for r in df.collect()} for df in (got, want))
    assert set(got) == set(want) and want
    for k, w in want.items():
        assert all((a is None and b is None) or abs(a - b) < 1e-9 for a, b in zip(got[k], w, strict=True)), k


def _readings(rng, n, newest, days):
    out = {}
    for i in range(n):
        key = (rng.choice(["a", "b", None]), newest - dt.timedelta(minutes=rng.randint(0, days * 1440), seconds=rng.randint(0, 59)))
        out[key] = (*key, *[rng.choice([None, rng.random() * 100]) for _ in range(4)], rng.choice([None, 100000 + i]), i, rng.choice([None, 0.5]))
    return out


@pytest.mark.parametrize("anchor_moves", [True, False])
def test_incremental_equals_full(spark, anchor_moves):
    """Two refreshes after the first: new rows, corrections and late rows; ranges that begin within a bucket and that move on."""
    rng = random.Random(anchor_moves)
    newest = dt.datetime(2024, 7, 10, 12, 7, 31)
    rows = _readings(rng, 900, newest, 400) | _readings(rng, 600, newest, 8)
    rows |= _readings(rng, 40, newest - dt.timedelta(days=365) + dt.timedelta(minutes=40), 1)
    rows |= _readings(rng, 40, newest - dt.timedelta(days=1) + dt.timedelta(minutes=2), 1)
    rows[("a", newest)] = ("a", newest, 1.0, 2.0, 3.0, 4.0, 5, 6, 7.0)
    weather = _weather(spark, list(rows.values()))
    parts = R.partials(weather, R.global_max(weather))
    _same(R.rollups_from_partials(parts, weather, newest), R.rollups_single_pass(weather, newest))
    for step in range(2):
        later = newest + dt.timedelta(hours=9 * (step + 1)) if anchor_moves else newest
        new = _readings(rng, 60, later, 20)
        new |= {k: (*k, None, 1.0, None, 2.0, 3, 4, None) for k in rng.sample(sorted(rows, key=str), 80)}
        rows |= new
        weather = _weather(spark, list(rows.values()))
        anchor = R.global_max(weather)
        touched = _weather(spark, list(new.values())).select("station", "dt")
        parts = spark.createDataFrame(R.refresh_partials(parts, weather, touched, anchor).collect(), parts.schema)  # as stored
        _same(R.rollups_from_partials(parts, weather, anchor), R.rollups_single_pass(weather, anchor))


def test_incremental_reads_touched_dates_alone(spark, tmp_path):
    rng = random.Random(5)
    rows = _readings(rng, 500, MAX, 60)
    rows[("a", MAX)] = ("a", MAX, 1.0, 2.0, 3.0, 4.0, 5, 6, 7.0)
    _weather(spark, list(rows.values())).withColumn("obs_date", F.to_date("dt")).write.partitionBy("obs_date").parquet(str(tmp_path / "w"))
    weather = spark.read.parquet(str(tmp_path / "w"))
    parts = R.partials(weather, MAX)
    touched = weather.filter(F.col("dt") >= F.lit("2024-07-09 00:00:00").cast("timestamp_ntz")).select("station", "dt")
    touched.write.parquet(str(tmp_path / "t"))
    got = R.refresh_partials(parts, weather, spark.read.parquet(str(tmp_path / "t")), MAX)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    _same(R.rollups_from_partials(got, weather, MAX), R.rollups_single_pass(weather, MAX))


def test_incremental_with_nothing_new(spark):
    rows = _readings(random.Random(6), 100, MAX, 30)
    weather = _weather(spark, list(rows.values()))
    anchor = R.global_max(weather)
    parts = R.refresh_partials(R.partials(weather, anchor), weather, weather.limit(0).select("station", "dt"), anchor)
    _same(R.rollups_from_partials(parts, weather, anchor), R.rollups_single_pass(weather, anchor))
