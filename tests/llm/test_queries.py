"""Every registered query of the subpackage runs over whole tables; SQL oracles agree."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.LLM_QUERIES))
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, connect(SF), sql) is None


def test_all_are_registered():
    names = {n.split("_")[0] for n in entry.LLM_QUERIES}
    assert names == {"pipeline", *(f"op{n}" for n in range(1, 14))}
