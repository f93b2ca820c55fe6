"""Shared test tables -> the nine staging tables.

The test tables are a TPC-H-like star (orders, lineitem, customer, part,
supplier, nation, region). This adapter derives the marketplace staging
layer from them deterministically, with plain column expressions, so the
same rules can be written in any SQL engine for a side-by-side check.

``k`` is ``o_orderkey``; ``P`` (purchase) is ``o_orderdate + k % 1440``
minutes; each later lifecycle time is ``P`` plus a key-derived number of
minutes, with some left NULL or blank so that the lifecycle rules and the
blank-to-NULL handling are exercised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.money import MONEY
from martlet.functions.timekeys import add_minutes, format_time
from martlet.sources.staging import STAGING_SCHEMAS, Staging

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Order status code -> staged status text.
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}

# Payment code by (order key + payment sequence) % 5.
PAYMENT_CODES = ["credit_card", "boleto", "debit_card", "voucher", "not_defined"]

# The category translation rows. "promo" is absent on purpose
# (an unmatched category); " perfumery " and a blank name test the trimming.
CATEGORY_TRANSLATION = [
    ("economy", "health_beauty"),
    ("standard", "auto"),
    ("large", "bed_bath_table"),
    ("medium", " perfumery "),
    ("small", "  "),
]


# The large tables and their keys. A Parquet row group cannot be split, so the adapter
# deals their rows out once. By key, since dealing them out in turn would sort every
# task's rows first (and spill them); AQE sizes the partitions and splits a hot key's.
LARGE_TABLES = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def raw_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(raw_path(sf_dir, name))
    return df.hint("rebalance", LARGE_TABLES[name]) if name in LARGE_TABLES else df


def _key_text(col: str) -> Column:
    return F.col(col).cast("string")


def _lookup(mapping: dict[str, str], col: Column) -> Column:
    expr = None
    for raw, value in mapping.items():
        expr = F.when(col == raw, value) if expr is None else expr.when(col == raw, value)
    return expr


def stg_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    p = add_minutes("o_orderdate", k % 1440)
    return orders.select(
        _key_text("o_orderkey").alias("order_id"),
        F.concat(F.lit("c"), _key_text("o_orderkey")).alias("customer_id"),
        _lookup(ORDER_STATUS, status).alias("order_status"),
        format_time(p).alias("order_purchase_timestamp"),
        F.when(k % 100 == 0, F.lit(None).cast("string"))
        .when(k % 100 == 50, F.lit(""))
        .otherwise(format_time(add_minutes(p, (k * 37) % 2880 - 60)))
        .alias("order_approved_at"),
        F.when(status == "P", F.lit(None).cast("string"))
        .when(k % 41 == 0, F.lit(""))
        .otherwise(format_time(add_minutes(p, 2700 + (k * 53) % 7200)))
        .alias("order_delivered_carrier_date"),
        F.when(status != "F", F.lit(""))
        .otherwise(format_time(add_minutes(p, 9000 + (k * 71) % 20000)))
        .alias("order_delivered_customer_date"),
        format_time(add_minutes(p, (k * 91) % 43200 - 300)).alias("order_estimated_delivery_date"),
    )


def _nation_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def stg_customers(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                  region: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    o = orders.select("o_orderkey", "o_custkey")
    c = customer.select("c_custkey", "c_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    geo = _nation_region(nation, region)
    joined = oc.join(geo, geo.n_nationkey == (oc.c_nationkey + k % 3) % 25)
    return joined.select(
        F.concat(F.lit("c"), _key_text("o_orderkey")).alias("customer_id"),
        _key_text("o_custkey").alias("customer_unique_id"),
        F.lpad(((F.col("o_custkey") * 7 + k % 3) % 100000).cast("string"), 5, "0")
        .alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def stg_order_items(lineitem: DataFrame) -> DataFrame:
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate",
        F.explode(F.sequence(F.lit(1), 1 + F.col("l_linenumber") % 3)).alias("copy"),
    )
    return li.select(
        _key_text("l_orderkey").alias("order_id"),
        (F.col("l_linenumber") * 10 + F.col("copy")).cast("string").alias("order_item_id"),
        _key_text("l_partkey").alias("product_id"),
        _key_text("l_suppkey").alias("seller_id"),
        format_time(add_minutes("l_shipdate", F.col("l_partkey") % 1440)).alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).cast("string").alias("price"),
        F.col("l_quantity").cast(MONEY).cast("string").alias("freight_value"),
    )


def _split_amount(amount: Column, parts: Column) -> Column:
    """``amount / parts`` rounded half-up to the cent, in exact integer cents.

    Casting the DOUBLE quotient to DECIMAL(18,2) would round half-cent ties
    differently across engines; integer cents make the value exact.
    """
    cents = F.round(amount * 100).cast("bigint")
    num, den = cents * 2 + parts, parts * 2
    return ((num - num % den) / den).cast("bigint").cast("double") / 100.0


def stg_order_payments(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    o = orders.select(
        "o_orderkey", "o_totalprice",
        F.explode(F.sequence(F.lit(1).cast("bigint"), 1 + k % 3)).alias("seq"),
    )
    code = (k + F.col("seq")) % 5
    code_text = None
    for i, name in enumerate(PAYMENT_CODES):
        code_text = F.when(code == i, name) if code_text is None else code_text.when(code == i, name)
    return o.select(
        _key_text("o_orderkey").alias("order_id"),
        F.col("seq").cast("bigint").alias("payment_sequential"),
        code_text.alias("payment_type"),
        (1 + k % 10).cast("bigint").alias("payment_installments"),
        _split_amount(F.col("o_totalprice"), 1 + k % 3).alias("payment_value"),
    )


def stg_products(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.select(
        _key_text("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.lower("p_type")).alias("product_category_name"),
        (size * 100).cast("string").alias("product_weight_g"),
        (size + 5).cast("string").alias("product_length_cm"),
        (size + 2).cast("string").alias("product_height_cm"),
        (size + 3).cast("string").alias("product_width_cm"),
    )


def stg_translation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CATEGORY_TRANSLATION, STAGING_SCHEMAS["stg_product_category_name_translation"]
    )


def stg_sellers(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = _nation_region(nation, region)
    s = supplier.select("s_suppkey", "s_nationkey")
    return s.join(geo, s.s_nationkey == geo.n_nationkey).select(
        _key_text("s_suppkey").alias("seller_id"),
        ((F.col("s_suppkey") * 11) % 100000).cast("bigint").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def stg_geolocation(nation: DataFrame, region: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    return _nation_region(nation, region).select(
        (n * 1000).cast("bigint").alias("geolocation_zip_code_prefix"),
        (n - 12).cast("double").alias("geolocation_lat"),
        (n * 2 - 24).cast("double").alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    )


def stg_order_reviews(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    return orders.select(
        F.concat(F.lit("r"), _key_text("o_orderkey")).alias("review_id"),
        _key_text("o_orderkey").alias("order_id"),
        (1 + k % 5).cast("bigint").alias("review_score"),
        F.when(k % 8 == 0, F.lit(None).cast("string")).otherwise(prio).alias("review_comment_title"),
        F.when(k % 12 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit('note "'), prio, F.lit('", a\\b\nend')))
        .alias("review_comment_message"),
        format_time(add_minutes("o_orderdate", F.lit(43200))).alias("review_creation_date"),
        format_time(add_minutes("o_orderdate", 44640 + k % 1440)).alias("review_answer_timestamp"),
    )


def load_staging(spark: SparkSession, sf_dir: str, *, extras: bool = False) -> Staging:
    """Build the staging layer from the test tables in ``sf_dir`` (lazily)."""
    raw = {name: read_raw(spark, sf_dir, name) for name in RAW_TABLES}
    staging = Staging(
        customers=stg_customers(raw["orders"], raw["customer"], raw["nation"], raw["region"]),
        orders=stg_orders(raw["orders"]),
        order_items=stg_order_items(raw["lineitem"]),
        products=stg_products(raw["part"]),
        order_payments=stg_order_payments(raw["orders"]),
        sellers=stg_sellers(raw["supplier"], raw["nation"], raw["region"]),
        translation=stg_translation(spark),
    )
    if extras:
        staging.geolocation = stg_geolocation(raw["nation"], raw["region"])
        staging.order_reviews = stg_order_reviews(raw["orders"])
    return staging
