"""The two facts (orders, order items) and the payment summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.labels import ALL_PAYMENT_LABELS, PAYMENT_LABEL_SEPARATOR, payment_label
from martlet.functions.money import cents_sum, from_cents
from martlet.functions.timekeys import blank_to_null, minute_key, try_minute_key
from martlet.operators.lifecycle import (
    APPROVED,
    CARRIER,
    DELIVERED,
    ESTIMATED,
    PURCHASE,
    lifecycle_ok,
)

# Staged order time column -> order-fact time column -> order-fact key column.
ORDER_TIMES = (
    ("order_purchase_timestamp", PURCHASE, "purchase_date_id"),
    ("order_approved_at", APPROVED, "approved_date_id"),
    ("order_delivered_carrier_date", CARRIER, "delivered_carrier_date_id"),
    ("order_delivered_customer_date", DELIVERED, "delivered_customer_date_id"),
    ("order_estimated_delivery_date", ESTIMATED, "estimated_delivery_date_id"),
)

FACT_ORDERS_COLUMNS = [
    "order_id", "customer_id", "status",
    *[t for _, t, _ in ORDER_TIMES],
    "total_order_amount", "payment_type",
    *[k for _, _, k in ORDER_TIMES],
]


def base_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the person id of their customer; blank times become NULL.

    DISTINCT rows: copies of an order collapse here, and map-side partial
    aggregation collapses them before the shuffle.
    """
    o = orders.where(F.col("order_id").isNotNull())
    c = customers.select("customer_id", "customer_unique_id")
    return o.join(c, "customer_id", "left").select(
        F.col("order_id"),
        F.col("customer_unique_id").alias("customer_id"),
        F.col("order_status").alias("status"),
        *[blank_to_null(src).alias(dst) for src, dst, _ in ORDER_TIMES],
    ).distinct()


def payment_summary(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Per order with both items and payments: amount and payment labels.

    The amount is defined over the many-to-many join of an order's items and
    payments, i.e. the sum of item prices counted once per payment. Instead
    of materializing that join (items x payments rows per order), each side
    is aggregated per order first and the amount is ``sum(price) * count(payments)``
    -- the same exact value, summed in integer cents. The label list is the distinct labels of
    the order's payments in sort order, built from one boolean per possible
    label, so the whole aggregate stays a fixed-width hash aggregation.
    Both aggregates come out hash-partitioned on ``order_id`` and join
    without another exchange.
    """
    item_totals = items.groupBy("order_id").agg(cents_sum("price").alias("items_cents"))
    label = payment_label("payment_type")
    flags = [F.bool_or(label == name).alias(f"has_{i}") for i, name in enumerate(ALL_PAYMENT_LABELS)]
    pays = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_payments"), *flags)
    joined = item_totals.join(pays, "order_id")
    listed = F.concat_ws(
        PAYMENT_LABEL_SEPARATOR,
        *[F.when(F.col(f"has_{i}"), F.lit(name)) for i, name in enumerate(ALL_PAYMENT_LABELS)],
    )
    return joined.select(
        F.col("order_id"),
        from_cents(F.col("items_cents") * F.col("n_payments")).alias("total_order_amount"),
        listed.alias("payment_type"),
    )


def fact_orders(orders: DataFrame, customers: DataFrame, items: DataFrame,
                payments: DataFrame) -> DataFrame:
    """Valid orders with amount, payment labels and lenient minute keys.

    The lifecycle filter reads only order columns, so Catalyst applies it
    below the join with the payment summary.
    """
    vo = base_orders(orders, customers).join(payment_summary(items, payments), "order_id", "left")
    vo = vo.where(lifecycle_ok())
    return vo.select(
        *[c for c in FACT_ORDERS_COLUMNS if not c.endswith("_date_id")],
        *[try_minute_key(t).alias(k) for _, t, k in ORDER_TIMES],
    ).select(*FACT_ORDERS_COLUMNS)


def aggregated_items(items: DataFrame) -> DataFrame:
    """Items per (order, product, seller, raw shipping-limit text).

    Grouping is on the raw text while the key is per minute, so two rows may
    share a minute key. The key is strict: bad text raises.
    """
    agg = items.groupBy("order_id", "product_id", "seller_id", "shipping_limit_date").agg(
        F.count(F.lit(1)).alias("quantity"),
        cents_sum("price").alias("price_cents"),
        cents_sum("freight_value").alias("freight_cents"),
    )
    return agg.select(
        "order_id", "product_id", "seller_id", "quantity",
        from_cents(F.col("price_cents")).alias("total_price"),
        from_cents(F.col("freight_cents")).alias("total_freight"),
        minute_key("shipping_limit_date").alias("shipping_limit_date_id"),
    )


def fact_order_items(items: DataFrame, fact_orders_df: DataFrame) -> DataFrame:
    """Aggregated items of orders present in the order fact (inner join): a row is
    repeated for every row its order id has there."""
    return aggregated_items(items).join(fact_orders_df.select("order_id"), "order_id").select(
        "order_id", "product_id", "seller_id", "quantity", "total_price",
        "total_freight", "shipping_limit_date_id",
    )
