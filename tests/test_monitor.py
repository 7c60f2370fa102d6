import datetime as dt

from pyspark.sql import functions as F

from skyroll.operators import monitor as M
from skyroll.sources.listing import listing_links

BASE = dt.datetime(2024, 1, 1)


def test_counter_reset_adds_post_reset_value(spark):
    vals = [0.0, 3.0, 5.0, 1.0, 4.0]
    rows = [("r", i, BASE + dt.timedelta(seconds=30 * i), v) for i, v in enumerate(vals)]
    s = spark.createDataFrame(rows, "route string, request_id long, ts timestamp_ntz, counter double")
    out = sorted(M.counter_increase(s, ["route"], 300, "inc").collect(), key=lambda r: r.request_id)
    assert [r.inc for r in out] == [0.0, 3.0, 5.0, 6.0, 9.0]


def test_sustained_alert_edges(spark):
    def series(name, secs_true, interrupt_at=None):
        rows = []
        for i in range(0, secs_true + 1, 60):
            rows.append((name, BASE + dt.timedelta(seconds=i), i != interrupt_at))
        rows.append((name, BASE + dt.timedelta(seconds=secs_true + 60), False))
        return rows
    rows = series("five", 300) + [("short", BASE, True), ("short", BASE + dt.timedelta(seconds=299), True),
                                  ("short", BASE + dt.timedelta(seconds=320), False)] + series("cut", 600, 240)
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, up boolean")
    out = M.sustained(df, ["s"], "ts", [], F.col("up"), for_seconds=300).collect()
    by = {}
    for r in out:
        by.setdefault(r.s, []).append((r.duration_seconds, r.fired))
    assert by["five"] == [(300.0, True)]
    assert by["short"] == [(299.0, False)]
    assert sorted(by["cut"]) == [(180.0, False), (300.0, True)]


def test_duration_histogram_cumulative(spark):
    rows = [("GET", "/a", 0.004), ("GET", "/a", 0.2), ("GET", "/a", 20.0)]
    log = spark.createDataFrame(rows, "method string, route string, duration_seconds double")
    h = {r.le: r.bucket_count for r in M.duration_histogram(log).collect()}
    assert h["0.005"] == 1 and h["0.25"] == 2 and h["10.0"] == 2 and h["+Inf"] == 3


def test_listing_rule(spark):
    html = ('<a href="20240630.txt">x</a><a href="20240701.txt">x</a><a href="20240701_b.txt">x</a>'
            '<a href="notes.txt">x</a><a href="20240702.csv">x</a><link href="20240703.txt">')
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [r.href for r in listing_links(pages).collect()]
    assert got == ["20240630.txt", "20240701.txt", "20240701_b.txt"]


def _extrapolated(window, start, end):
    """The published rule for counters over (time in seconds, value) samples of one window."""
    if len(window) < 2 or window[0][0] == window[-1][0]:
        return None
    increase = sum(b if b < a else b - a for (_, a), (_, b) in zip(window, window[1:]))
    sampled = window[-1][0] - window[0][0]
    mean = sampled / (len(window) - 1)
    to_start, to_end = window[0][0] - start, end - window[-1][0]
    if to_start >= mean * 1.1:
        to_start = mean / 2
    if increase > 0 and window[0][1] >= 0:
        to_start = min(to_start, sampled * window[0][1] / increase)
    if to_end >= mean * 1.1:
        to_end = mean / 2
    return increase * (sampled + to_start + to_end) / sampled


def test_range_vector_on_a_grid(spark):
    import random
    rnd = random.Random(2)
    rows, at = [], {}
    for name in ("a", "b", None):
        t, v = 7, float(rnd.randint(0, 3))
        for _ in range(60):
            t += rnd.choice([0, 1, 20, 60, 61, 400, 1300])
            v = 0.0 if rnd.random() < 0.1 else v + rnd.randint(0, 5)
            at.setdefault(name, []).append((t, v))
            rows.append((name, len(rows), BASE + dt.timedelta(seconds=t), v))
    s = spark.createDataFrame(rows, "route string, request_id long, ts timestamp_ntz, counter double")
    got = {(r.route, int((r.eval_ts - BASE).total_seconds())): r for r in M.range_vector(s, ["route"], 300, 60).collect()}
    want = {}
    for name, samples in at.items():
        first, last = -(-samples[0][0] // 60) * 60, -(-samples[-1][0] // 60) * 60 + 240
        for end in range(first, last + 1, 60):
            want[name, end] = [x for x in samples if end - 300 < x[0] <= end]
    assert set(got) == set(want) and any(not w for w in want.values())
    for (name, end), window in want.items():
        r, x = got[name, end], _extrapolated(window, end - 300, end)
        assert r.samples == len(window)
        assert (r.increase is None) == (x is None) and (x is None or (abs(r.increase - x) < 1e-9 and abs(r.rate - x / 300) < 1e-9))
