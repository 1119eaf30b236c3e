"""Every registered query against its SQL, and what its plan must not contain."""

import pytest

import workload
from compare import difference

QUERIES, SQL = workload.queries(), workload.oracle_sql()


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(spark, sf_dir, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, sf_dir, plans_of, name):
    df, run = plans_of(lambda: QUERIES[name](spark, sf_dir))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # also in the jobs that run while the plan is built
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert all(bad not in p for p in (plan, *run)), f"{name}: {bad}"
    # a window over one task may only hold the totals per range, never rows
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition, ENSURE" in line and "Sort" in lines[i - 1]:
            assert "HashAggregate(keys=[_range" in lines[i + 1], f"{name}: {lines[i + 1]}"
