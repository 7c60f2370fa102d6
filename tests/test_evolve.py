"""Generations of a table with nested, widened columns, read as one."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import types as T

from skyroll.operators import evolve
from skyroll.sources import testtables as tt

SF = "/root/testdata/sf0.001"


def parsed(text):
    return T._parse_datatype_string(text)


def test_merged_types(spark):
    a = parsed("a int, S struct<x: int, L: array<struct<q: float>>>, m map<string, int>, d date, n void, p decimal(10,2)")
    b = parsed("s struct<l: array<struct<q: double, r: string>>, y: string>, A bigint, m map<string, double>, d timestamp_ntz, n int, p bigint, z int")
    want = parsed("a bigint, S struct<x: int, L: array<struct<q: double, r: string>>, y: string>, m map<string, double>, "
                  "d timestamp_ntz, n int, p decimal(21,2), z int")
    assert evolve.merged(a, b).simpleString() == want.simpleString()
    for x, y in (("a int", "a string"), ("a struct<x: int>", "a array<int>"), ("s struct<x: boolean>", "s struct<x: int>"), ("a decimal(38,0)", "a decimal(38,10)")):
        with pytest.raises(TypeError):
            evolve.merged(parsed(x), parsed(y))


def test_rows_of_generations(spark):
    old = spark.createDataFrame([(1, (2, None), [(3,)], {"k": 1}, dt.date(2024, 1, 2)), (2, None, None, None, None)],
                                "id int, `s.t` struct<x: int, e: struct<f: int>>, l array<struct<q: int>>, m map<string, int>, d date")
    new = spark.createDataFrame([(2**40, (1.5, (7, "g"), "w"), [(0.5, "r"), None], {"k": 2.5}, dt.datetime(2024, 1, 3, 4), "more")],
                                "id bigint, `s.t` struct<x: double, e: struct<f: bigint, g: string>, w: string>, "
                                "l array<struct<q: double, r: string>>, m map<string, double>, d timestamp_ntz, z string")
    rows = [tuple(r) for r in evolve.union_generations([old, new, old.limit(0)]).collect()]
    assert rows == [
        (1, (2.0, None, None), [(3.0, None)], {"k": 1.0}, dt.datetime(2024, 1, 2), None),
        (2, None, None, None, None, None),
        (2**40, (1.5, (7, "g"), "w"), [(0.5, "r"), None], {"k": 2.5}, dt.datetime(2024, 1, 3, 4), "more"),
    ]


def test_files_of_generations(spark):
    work = tempfile.mkdtemp(prefix="skyroll-gen-", dir="/tmp")
    parts = tt.reading_generations(tt.events(spark, SF))
    paths = [f"{work}/{i}" for i in range(2)]
    for part, path in zip(parts, paths, strict=True):
        part.write.parquet(path)
    rows = evolve.read_generations(spark, paths)
    assert sorted(map(str, rows.collect())) == sorted(map(str, evolve.union_generations(parts).collect()))
    plan = rows.filter("arrival < 50").select("wind.avg")._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in plan.split("ReadSchema")[1:]]
    assert len(scans) == 2 and all("lux" not in s.split("\n")[0] for s in scans) and plan.count("LessThan(arrival,50)") == 2
