"""Plan-shape checks: the physical plans keep the choices made for large inputs."""

import pytest
from pyspark.sql import functions as F

from plenaria.catalog import QUERIES
from plenaria.operators.dedup import first_per_key
from plenaria.operators.ranking import tree_top_n

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_aggregates_partially_before_the_shuffle(spark):
    # one key holds a third of the rows: the partial aggregate collapses it per map task
    rows = [(0, i, "x") for i in range(300)] + [(k, k, "y") for k in range(1, 601)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    out = first_per_key(df, ["k"], ["o"])
    plan = _plan(out)
    assert "partial_min" in plan and plan.index("partial_min") > plan.index("Exchange")
    assert out.filter("k = 0").first()["o"] == 0 and out.count() == 601


def test_top_n_per_group_is_limited_before_the_shuffle(spark):
    rows = [("hot", f"a{i}", i % 7 + 1) for i in range(3000)] + [(f"g{j}", "b", 1) for j in range(40)]
    counts = spark.createDataFrame(rows, "g string, i string, n long")
    out = tree_top_n(counts, "g", "i", "n", 10, 10)
    out.collect()
    assert "WindowGroupLimit" in _plan(out)
    assert out.agg(F.sum("n")).first()[0] == sum(n for _, _, n in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_python_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["exclude_subject"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan


@pytest.mark.parametrize("name", ["type_mix", "party_author_tree", "party_term_matrix", "party_type_flow"])
def test_views_that_reread_their_counts_compute_the_base_once(spark, name):
    # the base is evaluated into the written counts; what is left reads only them
    assert "orders" not in _plan(QUERIES[name](spark, SF))


def test_resumed_scores_parse_each_response_once(spark):
    plan = _plan(QUERIES["score_resume"](spark, SF))
    assert plan.count("orders.parquet") == 2      # the keys and the responses
