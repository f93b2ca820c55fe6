"""The four dimensions: customers, sellers, products and the minute calendar.

Each builder takes staging DataFrames and returns a lazy DataFrame; Catalyst
prunes the columns each one reads and pushes its filters into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.labels import UNKNOWN_CATEGORY
from martlet.functions.timekeys import (
    blank_to_null,
    minute_floor,
    minute_key_of,
    parse_time_strict,
    weekday_name,
    year_quarter,
)

ORDER_TIME_COLUMNS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def latest_addresses(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Per (person, address): the latest purchase time text of its orders.

    Orders are first reduced to one row per ``customer_id`` (max purchase
    text) -- exact, since a max of maxes is the max -- so a customer id
    holding a third of all orders arrives at the join as a single row. The
    aggregate's output is already hash-partitioned on ``customer_id``, so the
    join adds no exchange on that side.
    """
    last_per_id = orders.groupBy("customer_id").agg(
        F.max("order_purchase_timestamp").alias("last_purchase")
    )
    joined = customers.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ).join(last_per_id, "customer_id")
    return joined.groupBy(
        "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    ).agg(F.max("last_purchase").alias("last_purchase"))


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per person (``customer_unique_id``) with the address of their latest order.

    Ranking: latest purchase first with a NULL latest time ranked first (the
    warehouse default for descending order), then zip, city, state ascending
    (NULLs last) as a deterministic tie-break. ``row_number() == 1`` is
    planned as a partial WindowGroupLimit before the shuffle, so each map
    task sends at most one row per person.
    """
    addr = latest_addresses(customers, orders)
    w = Window.partitionBy("customer_unique_id").orderBy(
        F.col("last_purchase").desc_nulls_first(),
        F.col("customer_zip_code_prefix").asc_nulls_last(),
        F.col("customer_city").asc_nulls_last(),
        F.col("customer_state").asc_nulls_last(),
    )
    return (
        addr.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") == 1)
        .select(
            F.col("customer_unique_id").alias("customer_id"),
            F.col("customer_city").alias("city"),
            F.col("customer_state").alias("state"),
            F.col("customer_zip_code_prefix").alias("zip_code"),
        )
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    """Distinct seller rows (a seller id repeats if its attributes differ)."""
    return sellers.select(
        F.col("seller_id"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        F.col("seller_zip_code_prefix").alias("zip_code"),
    ).distinct()


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name; blank or missing -> ``Unknown``.

    One DISTINCT after the clean-up equals a DISTINCT before and after it.
    """
    tr = translation.select(
        F.col("product_category_name").alias("tr_category"),
        F.col("product_category_name_english").alias("tr_english"),
    )
    base = products.where(F.col("product_id").isNotNull())
    joined = base.join(tr, base.product_category_name == tr.tr_category, "left")
    return joined.select(
        F.col("product_id"),
        F.coalesce(blank_to_null(F.trim(F.col("tr_english"))), F.lit(UNKNOWN_CATEGORY))
        .alias("category_name"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
    ).distinct()


def event_times(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Every non-NULL lifecycle time text of orders and items, one per row.

    The five order columns come from one scan via ``explode(array(...))``
    instead of a five-way union that would scan orders five times.
    """
    order_times = orders.select(
        F.explode(F.array(*[F.col(c) for c in ORDER_TIME_COLUMNS])).alias("event_time")
    )
    item_times = items.select(F.col("shipping_limit_date").alias("event_time"))
    return order_times.unionByName(item_times).where(F.col("event_time").isNotNull())


def dim_date(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Minute calendar of every time seen in orders and items.

    Blank text is dropped; other text must parse (bad text raises). Times are
    truncated to the minute *before* the DISTINCT, so the shuffle carries one
    8-byte time per distinct minute per map task (partial aggregation), and
    the calendar attributes are computed once per distinct minute after it.
    """
    # Blank text is dropped on the raw column (pushed into the scans); the
    # strict parse never yields NULL for other text, so this equals dropping
    # NULL times after parsing, without parsing twice.
    minutes = (
        event_times(orders, items)
        .where(blank_to_null("event_time").isNotNull())
        .select(minute_floor(parse_time_strict("event_time")).alias("full_datetime"))
        .distinct()
    )
    ts = F.col("full_datetime")
    return minutes.select(
        minute_key_of(ts).alias("date_id"),
        ts.alias("full_datetime"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        weekday_name(ts).alias("day_of_week"),
        F.hour(ts).alias("hour"),
        year_quarter(ts).alias("year_quarter"),
    )
