from __future__ import annotations

import pytest

from __spark_entry__ import entry
from wharf.catalog import all_queries as queries
from wharf.comparison import all_sql as oracle_sql
from compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, tables, name):
    df = queries()[name](spark, SF)
    assert {f.dataType.simpleString() for f in df.schema} <= {"string", "int", "bigint"}
    assert difference(df, tables, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(queries()))
def test_plans_avoid_python_and_cross_joins(spark, name):
    if name.startswith("stream_"):
        pytest.skip("runs its stream while it is planned")
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["breaker_trips", "stream_breaker"])
def test_breaker_queries_have_rows(spark, name):
    assert queries()[name](spark, "/root/testdata/sf0.01").count() == 27
