"""Physical-plan checks: pushdown, pruning, no Python in the hot path,
no cross products, joins without extra shuffles, bounded top-k."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from conftest import plan_text

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_or_cross_products(spark, name):
    plan = plan_text(entry.queries()[name](spark, SF))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node} in plan"


def test_event_filter_reaches_scan(spark):
    plan = plan_text(entry.queries()["event_share"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan


def test_column_pruning(spark):
    plan = plan_text(entry.queries()["rows_per_key_stats"](spark, SF))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint>", plan)
    plan = plan_text(entry.queries()["first_transition_delay"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_top_k_is_bounded(spark):
    for name in ["rows_per_key_topk", "distinct_per_key_topk", "most_over", "most_under"]:
        assert "TakeOrderedAndProject" in plan_text(entry.queries()[name](spark, SF)), name


def test_join_after_aggregation_adds_no_shuffle(spark):
    """With broadcasts off, the per-key aggregates feed the sort-merge join
    directly: one hash exchange per side, none between aggregate and join."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = entry.queries()["request_vs_usage"](spark, SF)
        plan = plan_text(df)
        assert "SortMergeJoin" in plan
        assert plan.count("Exchange hashpartitioning(job_id") == 2
        j8 = plan_text(entry.queries()["first_transition_delay"](spark, SF))
        # events: (job, task) then job; constraints: (job, task) then job
        assert j8.count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.set(key, old)


def test_semi_join_for_event_keys(spark):
    plan = plan_text(entry.queries()["peak_vs_event"](spark, SF))
    assert "LeftSemi" in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["job_id", "request", "usage", "delta"]
    assert df.count() == 15


def test_semi_join_keys_are_deduplicated_before_the_shuffle(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = plan_text(entry.queries()["peak_vs_event"](spark, SF))
    finally:
        spark.conf.set(key, old)
    # peaks side and key side: one hash exchange each, both after a partial aggregate
    assert plan.count("Exchange hashpartitioning(job_id") == 2
    assert plan.count("HashAggregate(keys=[job_id") == 4
    assert "SortMergeJoin [job_id#" in plan and "LeftSemi" in plan


def test_share_total_is_one_subquery(spark):
    for name in ["value_share", "event_share"]:
        plan = plan_text(entry.queries()[name](spark, SF))
        assert plan.count("Subquery ") == 1, name


def test_distinct_counts_shuffle_on_key_and_value_first(spark):
    plan = plan_text(entry.queries()["distinct_per_key_topk"](spark, SF))
    assert re.search(r"Exchange hashpartitioning\(l_partkey#\d+L, l_suppkey#\d+L", plan)
    assert re.search(r"Exchange hashpartitioning\(l_partkey#\d+L, \d+\)", plan)
