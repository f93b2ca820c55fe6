"""The nine staging tables: names and declared schemas.

Relational sources are staged with every column as text; CSV sources keep the
types their reader infers (integers widened to BIGINT, floats to DOUBLE).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Staging column names and types per table.
STAGING_SCHEMAS: dict[str, T.StructType] = {
    "stg_customers": _strings(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ),
    "stg_orders": _strings(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "stg_order_items": _strings(
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    ),
    "stg_products": _strings(
        "product_id", "product_category_name", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "stg_order_payments": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("payment_sequential", T.LongType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("payment_installments", T.LongType()),
        T.StructField("payment_value", T.DoubleType()),
    ]),
    "stg_sellers": T.StructType([
        T.StructField("seller_id", T.StringType()),
        T.StructField("seller_zip_code_prefix", T.LongType()),
        T.StructField("seller_city", T.StringType()),
        T.StructField("seller_state", T.StringType()),
    ]),
    "stg_product_category_name_translation": _strings(
        "product_category_name", "product_category_name_english",
    ),
    "stg_geolocation": T.StructType([
        T.StructField("geolocation_zip_code_prefix", T.LongType()),
        T.StructField("geolocation_lat", T.DoubleType()),
        T.StructField("geolocation_lng", T.DoubleType()),
        T.StructField("geolocation_city", T.StringType()),
        T.StructField("geolocation_state", T.StringType()),
    ]),
    "stg_order_reviews": T.StructType([
        T.StructField("review_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("review_score", T.LongType()),
        T.StructField("review_comment_title", T.StringType()),
        T.StructField("review_comment_message", T.StringType()),
        T.StructField("review_creation_date", T.StringType()),
        T.StructField("review_answer_timestamp", T.StringType()),
    ]),
}


@dataclass
class Staging:
    """The staging layer as lazy DataFrames; the marts read these."""

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    order_payments: DataFrame
    sellers: DataFrame
    translation: DataFrame
    geolocation: DataFrame | None = None
    order_reviews: DataFrame | None = None

    def as_tables(self) -> dict[str, DataFrame]:
        names = {
            "customers": "stg_customers", "orders": "stg_orders",
            "order_items": "stg_order_items", "products": "stg_products",
            "order_payments": "stg_order_payments", "sellers": "stg_sellers",
            "translation": "stg_product_category_name_translation",
            "geolocation": "stg_geolocation", "order_reviews": "stg_order_reviews",
        }
        out = {}
        for f in fields(self):
            df = getattr(self, f.name)
            if df is not None:
                out[names[f.name]] = df
        return out
