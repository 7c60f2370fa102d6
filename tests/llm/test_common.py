import random
import re
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyroll.llm.common import gapless_starts, join_small, tidy
from skyroll.llm.graph import components


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(50)]
    part = {v: v for e in edges for v in e}
    for _ in part:
        changed = False
        for a, b in edges:
            low = min(part[a], part[b])
            changed |= part[a] != low or part[b] != low
            part[a] = part[b] = low
        if not changed:
            break
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {r.node: r.component for r in got.collect()} == part
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_join_small_both_ways(spark):
    big = spark.range(500).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 7).alias("k"), "id")
    small = spark.createDataFrame([(None, "n"), (1, "a"), (2, "b"), (9, "z")], "k long, v string")
    for how in ("left", "inner"):
        wide = join_small(big, small, ["k"], how)
        salted = join_small(big, small, ["k"], how, max_rows=1, salts=5)
        assert sorted(map(str, wide.collect())) == sorted(map(str, salted.collect()))
    assert wide.where("v = 'n'").count() == big.where("k is null").count()


def test_gapless_starts(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice([0, 5, 1 << 13, 1 << 30, -(1 << 46)]) + rng.randint(0, 3), rng.randint(0, 2**32 - 1), rng.randint(0, 9)) for _ in range(400)]
    rows = list({r[:3]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "g string, k long, t long, w long")
    got = gapless_starts(df, ["g"], "k", {"s": "w"}, tie="t").collect()
    for r in got:
        assert r.s == sum(w for g, k, t, w in rows if g == r.g and (k, t) < (r.k, r.t))


def used():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


@pytest.mark.parametrize("arguments", [1, 2])
def test_freed_memory_goes_back(arguments):
    def fill():
        # too small to be mapped one by one; the last one keeps the heap from shrinking by itself
        parts = [b"x" * 100_000 for _ in range(1500)]
        return pa.table({"held": [parts[-1]]})

    start = used()
    out = tidy(lambda rows: fill())(None) if arguments == 1 else tidy(lambda left, right: fill())(None, None)
    assert out.num_rows == 1 and used() < start + 50
