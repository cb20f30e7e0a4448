"""Every query against its SQL on the smallest tables, and the shape of the contract."""

import pytest

import __spark_entry__ as entry
from workload.check import connect, difference
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf, con, plan, name):
    df = QUERIES[name](spark, sf)
    assert difference(df, con, entry.oracle_sql()[name]) is None
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan(df), operator


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "labels"] and df.count() > 0
