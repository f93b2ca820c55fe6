"""Checks and metrics on the star built from sf0.001, against values
measured independently (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from martlet.operators import checks, metrics
from martlet.plans.store import stored_mart
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def star(spark):
    return stored_mart(spark, SF_SMALL)


def test_star_sizes(star):
    sizes = {n: star.table(n).count() for n in
             ("dim_customers", "dim_date", "dim_products", "dim_sellers", "fact_orders", "fact_order_items")}
    assert sizes == {"dim_customers": 150, "dim_date": 11885, "dim_products": 200, "dim_sellers": 10,
                     "fact_orders": 1454, "fact_order_items": 5827}


def test_report(star):
    tables = {n: star.table(n) for n in ("dim_customers", "dim_date", "dim_products", "dim_sellers",
                                         "fact_orders", "fact_order_items")}
    rep = {r.test_name: (r.failures, r.status) for r in checks.test_report(tables).collect()}
    assert len(rep) == len(checks.SUITE) == 27
    assert rep.pop("assert_unique_fact_order_items") == (54, "fail")
    assert all(v == (0, "pass") for v in rep.values())


def test_check_primitives(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, v string")
    assert checks.not_null(df, "k").count() == 2
    assert [tuple(r) for r in checks.unique(df, "k").collect()] == [(1, 2)]
    assert checks.unique(df, "k", skip_nulls=False).count() == 2
    parent = spark.createDataFrame([(1,), (1,)], "pk int")
    orphans = checks.relationships(df, "k", parent, "pk").collect()
    assert [r.k for r in orphans] == [2]
    assert checks.relationship_failures(df, "k", parent, "pk").first().failures == 1


def test_overview_metrics(star):
    fo, fi = star.fact_orders, star.fact_order_items
    assert metrics.total_revenue(fi).first().total_revenue == pytest.approx(619820961.10, abs=1e-3)
    assert metrics.average_order_value(fi).first().orders_with_items == 1428
    assert metrics.total_customers(fo).first().total_customers == 150
    ov = metrics.sales_overview(fo, fi).first()
    assert ov.total_orders == 1454
    assert ov.average_order_value == pytest.approx(619820961.10 / 1428)


def test_growth_top_and_share(star):
    fo, fi = star.fact_orders, star.fact_order_items
    growth = metrics.monthly_revenue_growth(fo, fi)
    assert growth.where(F.col("growth") > 0).count() == 42
    assert growth.where(F.col("prev_revenue").isNull()).count() == 1
    top_q = metrics.top_products(fi, star.dim_products, "quantity")
    assert top_q.count() == 10
    assert top_q.agg(F.sum("quantity")).first()[0] == 838
    share = metrics.product_contribution(fi).agg(F.max("revenue_share"), F.sum("revenue_share")).first()
    assert share[0] == pytest.approx(0.00928128, abs=1e-8)
    assert share[1] == pytest.approx(1.0)
    assert metrics.sales_by_quantity(fi).agg(F.max("quantity")).first()[0] == 3
    hp = metrics.high_performers(fi).collect()
    assert sorted({r.kind for r in hp}) == ["product", "seller"] and len(hp) == 20


def test_place_and_cohorts(star):
    fo, fi, dc = star.fact_orders, star.fact_order_items, star.dim_customers
    by_state = metrics.segments_by_state(fo, fi, dc)
    assert by_state.agg(F.sum("orders")).first()[0] == 1428
    assert metrics.top_cities(fo, fi, dc).count() == 10
    cohorts = metrics.customer_cohorts(fo)
    # every customer appears exactly once at months_since = 0
    assert cohorts.where("months_since = 0").agg(F.sum("customers")).first()[0] == 150


def test_attach_to_few_equals_left_join(spark):
    from martlet.operators.joins import attach_to_few
    few = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "k string, v int")
    large = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "w"), ("c", "u")], "k string, attr string")
    got = sorted(tuple(r) for r in attach_to_few(few, large, "k").select("k", "v", "attr").collect())
    want = sorted(tuple(r) for r in few.join(large, "k", "left").select("k", "v", "attr").collect())
    assert got == want
