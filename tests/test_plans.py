"""Plan-shape guards over every query of the library (physical plans, not run)."""

import re

import pytest

from reviewlens.plans.catalog import REGISTRY

NAMES = sorted(REGISTRY)


def _plan(spark, sf_dir, name):
    df = REGISTRY[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_products_or_row_udfs(spark, sf_dir, name):
    plan = _plan(spark, sf_dir, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, (name, bad)
    # the only Python in any plan is the neighbour search's cogrouped pandas scorer
    if "Pandas" in plan:
        assert name.startswith("knn_") or name == "tfidf_pair_scores", name
        assert "FlatMapCoGroupsInPandas" in plan, name


@pytest.mark.parametrize("name", NAMES)
def test_document_scans_are_pruned(spark, sf_dir, name):
    plan = _plan(spark, sf_dir, name)
    for schema in re.findall(r"documents\.parquet\][^\n]*ReadSchema: struct<([^>]*)>", plan):
        cols = {c.split(":")[0] for c in schema.split(",")}
        assert cols <= {"doc_id", "text"}, (name, cols)


def test_top_k_uses_group_limit(spark, sf_dir):
    assert "WindowGroupLimit" in _plan(spark, sf_dir, "knn_top_hits")
