"""The registered training-data queries and the pipeline."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import connect, difference
from wharf.llm.common import stored, table
from wharf.llm.queries import QUERIES
from wharf.llm.sql import SQL

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(SQL) <= set(oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(queries()[name](spark, SF), connect(SF), oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["op2_sharding", "op5_mixing"])
def test_native_plans_run_no_python(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct"):
        assert operator not in plan


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    before, columns = docs, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stored(stage(spark, before, SF), f"test-{name}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert sorted(after.columns) == sorted(columns)
        known = {r.doc_id for r in before.select("doc_id").collect()}
        assert {r.doc_id for r in after.select("doc_id").collect()} <= known
        before = after
    sizes = Counter(r.doc_id for r in before.select("doc_id").collect())
    assert 0 < len(sizes) and max(sizes.values()) <= 2
    assert before.where("n_tokens != size(ids)").count() == 0
