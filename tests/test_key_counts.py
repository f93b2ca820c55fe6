"""The data tests as counts of keys: a row has the counts of its own domain only."""

from pyspark.sql import functions as F

from martlet.operators.checks import KeyTests, duplicate_order_items
from martlet.operators.checks import test_report as full_report


def test_counts_of_a_key_are_those_of_its_domain():
    tests = KeyTests()
    assert len(tests.counts) == 7 < len(tests.places)  # the calendar key and its six columns
    assert len(KeyTests(("unique",)).counts) == 1


def test_pairs_with_missing_parts_stay_apart(spark):
    pairs = [("1", None), ("1", None), ("1", "-"), (None, "1"), ("1", ""), ("11", "1"), ("1", "11"), (None, None)]
    items = spark.createDataFrame(pairs, "order_id string, product_id string").select(
        "*", F.lit("s").alias("seller_id"), F.lit(1).cast("long").alias("shipping_limit_date_id"))
    key = [t for t in KeyTests().suite if t.kind == "custom" and t.table == "fact_order_items"][0]
    tests = KeyTests()
    found = tests.counted(tests.entries({"fact_order_items": items})).agg(*tests.failures()).first()
    assert found[key.name] == duplicate_order_items(items).count() == 1


def test_report_of_some_kinds_is_part_of_the_whole(spark):
    star = {
        "dim_customers": spark.createDataFrame([("c",), ("c",), (None,)], "customer_id string"),
        "dim_sellers": spark.createDataFrame([("s",)], "seller_id string"),
        "dim_products": spark.createDataFrame([("p",), ("p",)], "product_id string"),
        "dim_date": spark.createDataFrame([(1,)], "date_id long"),
        "fact_orders": spark.createDataFrame([("o", "x")], "order_id string, customer_id string").select(
            "*", *[F.lit(2 if n == "approved" else None).cast("long").alias(f"{n}_date_id") for n in (
                "purchase", "approved", "delivered_carrier", "delivered_customer", "estimated_delivery")],
            *[F.lit(None).cast("string").alias(n) for n in (
                "purchase_timestamp", "approved_timestamp", "carrier_timestamp", "customer_timestamp",
                "estimated_timestamp")]),
        "fact_order_items": spark.createDataFrame(
            [("o", "p", "t", 1), ("q", None, "s", 3)],
            "order_id string, product_id string, seller_id string, shipping_limit_date_id long"),
    }
    kinds = ("not_null", "unique", "relationships")
    got = {r.test_name: r.failures for r in full_report(star, kinds).collect() if r.failures}
    assert got == {
        "not_null_dim_customers_customer_id": 1, "unique_dim_customers_customer_id": 1,
        "unique_dim_products_product_id": 1, "relationships_fact_orders_customer_id": 1,
        "not_null_fact_orders_purchase_date_id": 1, "relationships_fact_orders_approved_date_id": 1,
        "relationships_fact_order_items_order_id": 1, "not_null_fact_order_items_product_id": 1,
        "relationships_fact_order_items_seller_id": 1,
        "relationships_fact_order_items_shipping_limit_date_id": 1}
