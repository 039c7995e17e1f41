"""Every registered query against its SQL oracle, on the smallest data set."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
#: Nested loops and Python workers have no place in any plan.
FOREIGN = ("NestedLoopJoin", "CartesianProduct", "EvalPython", "MapInPandas", "FlatMapGroups")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry.LLM_QUERIES])
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in FOREIGN:
        assert operator not in plan
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
