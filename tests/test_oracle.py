"""Every query of the engine beside its SQL."""

import pytest
from compare import connect, differences, spark_rows, sql_rows

import __spark_entry__ as contract
from tradewind.testbed.oracle import build_oracle
from tradewind.testbed.registry import build_queries

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = build_queries(), build_oracle()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapInArrow"):
        assert operator not in plan, operator
    result = spark_rows(df)
    assert differences(result, sql_rows(duck, SQL[name])) is None
    assert result[1], "no rows to compare"


def test_entry(spark):
    assert contract.entry(spark).count() == 10
