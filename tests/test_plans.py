"""Plan hygiene for every read-only query: built-in operators only, no
cross/nested-loop joins, no Python evaluation, and pruned scans."""

from __future__ import annotations

import re

import pytest

from strata.plans.queries import QUERIES

WRITING = {"medallion_build", "medallion_layer", "star_roundtrip"} | {
    k for k in QUERIES if k.startswith(("ingest_", "catalog_", "sink_"))
}
READ_ONLY = sorted(k for k in QUERIES if k not in WRITING)

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "ObjectHashAggregate",
)


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", READ_ONLY)
def test_plan_uses_only_jvm_operators(spark, sf_dir, key):
    plan = physical_plan(QUERIES[key](spark, sf_dir))
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op}"


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = physical_plan(QUERIES["kpi_monthly_revenue"](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s.count(":") <= 3 for s in lineitem), schemas


def test_latest_row_dedupe_limits_before_the_shuffle(spark, sf_dir):
    df = QUERIES["silver_order_reviews"](spark, sf_dir)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4  # partial + final for both stages
    assert "Partial" in plan


def test_top_k_is_take_ordered(spark, sf_dir):
    plan = physical_plan(QUERIES["kpi_top_sellers"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("key", ["kpi_payment_recent_months", "kpi_review_by_category"])
def test_no_global_window(spark, sf_dir, key):
    plan = physical_plan(QUERIES[key](spark, sf_dir))
    assert "Window" not in plan or "SinglePartition" not in plan


def test_latest_review_aggregates_keys_only(spark, sf_dir):
    df = QUERIES["latest_review_per_order"](spark, sf_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Aggregate [" in line:
            assert "review_comment" not in line


def test_defining_a_query_starts_no_job(spark, sf_dir):
    """Beyond opening the test files: a second definition finds them known and starts nothing."""
    context = spark.sparkContext
    for key in READ_ONLY:
        QUERIES[key](spark, sf_dir)
        context.setJobGroup(f"define-{key}", "")
        try:
            QUERIES[key](spark, sf_dir)
            started = context.statusTracker().getJobIdsForGroup(f"define-{key}")
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        opened = len(started)
        assert opened <= 7, (key, opened)  # a footer read per driver table at most
