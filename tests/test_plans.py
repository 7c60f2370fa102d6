"""Plan guards for every registered query: no cartesian products or nested-loop
joins, and no Python UDF / pandas operators (everything stays JVM-side)."""

import pytest

from skyroll.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_operators(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name}: {found}"
