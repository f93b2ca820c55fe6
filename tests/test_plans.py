"""Plan guardrails: the shapes the design relies on, checked on every query."""

import os
import sys

import pytest

from martlet.plans import catalog
from martlet.plans.mart import Mart
from martlet.plans.store import stored_staging
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plans import summarize  # noqa: E402

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_pair_joins_or_python_rows(spark, name):
    c = summarize(_plan(catalog.QUERIES[name](spark, SF_SMALL)))
    assert not any(c.get(f) for f in FORBIDDEN), c


@pytest.mark.parametrize("name", ["check_relationships", "test_report", "quality_report"])
def test_reports_scan_each_fact_once(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    for table in ("fact_orders", "fact_order_items"):
        assert sum(f"marts/{table}/" in line for line in scans) == 1, table


def test_item_fact_is_a_plain_join_without_expansion(spark):
    plan = _plan(catalog.QUERIES["fact_order_items"](spark, SF_SMALL))
    assert "Generate" not in plan


def test_planning_starts_no_job(spark):
    """No row is read to decide on a plan."""
    staged = stored_staging(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning-only", "planning")
    try:
        Mart(staged).dim_products, Mart(staged).fact_order_items  # noqa: B018
        assert not tracker.getJobIdsForGroup("planning-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_calendar_distinct_is_partial_before_exchange(spark):
    plan = _plan(catalog.QUERIES["dim_date"](spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") == 1  # one shuffle for the whole calendar
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "HashAggregate(keys=[full_datetime" in below  # map-side DISTINCT before the shuffle
    assert plan.count("raise_error") == 2  # the strict parse runs once per branch, not twice


@pytest.mark.parametrize("name", ["top_cities", "segments_by_state", "segments_by_city"])
def test_places_need_no_expansion(spark, name):
    assert "Expand" not in _plan(catalog.QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["top_products_by_revenue", "top_products_by_quantity",
                                  "top_sellers_by_revenue", "top_sellers_by_quantity"])
def test_top_lists_are_computed_once(spark, name):
    found = catalog.QUERIES[name](spark, SF_SMALL)
    found.collect()
    run = _plan(found).split("== Initial Plan ==")[0]
    assert run.count("TakeOrderedAndProject") == 1 and "ReusedSubquery" in run
