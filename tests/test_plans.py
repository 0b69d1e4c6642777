"""Properties of the physical plans that matter at scale."""

import re

import pytest

from kelda.plans import ALL_QUERIES

BATCH = [name for name in ALL_QUERIES if not name.startswith("stream_")]


@pytest.fixture(scope="module")
def plan_of(spark, sf_dir):
    """Plans as they are for tables too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield lambda query: (
        ALL_QUERIES[query](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    )
    spark.conf.set(name, before)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(plan_of, name):
    plan = plan_of(name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "BatchEvalPython"):
        assert operator not in plan
    # Windows over everything are for one row per day, which only these have; the last two
    # have a total over everything beside windows by key.
    if re.search(r"windowspecdefinition\([^)]*\)", plan) and "SinglePartition" in plan:
        assert name in {
            "calendar_of_orders",
            "daily_active_users",
            "event_daily_volume",
            "event_volume_check",
            "session_concurrency",
            "customer_rfm",
            "customer_lifecycle",
            "customer_month_balance",
            "allocation_check",
            "priority_running_share_busy",
        }


def test_scans_read_what_they_need(plan_of):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan_of("top_orders")).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"o_orderkey", "o_totalprice", "o_orderpriority"}
    assert "PushedFilters: [In(event_type, [click,purchase,view])" in plan_of("user_funnel")


def test_small_dimensions_are_broadcast_by_measured_size(spark, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        assert plan_of("region_month_revenue").count("BroadcastHashJoin") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
