"""The star schema as a set of lazy DataFrames over a staging layer.

Tables are built in dependency order (dimensions, then the order fact, then
the item fact, which reads the order fact). Building is lazy: asking for one
table plans only what it needs. ``write_mart`` materializes the star, reading
the stored order fact back for the item fact so the order plan runs once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from martlet.operators import dims, facts, metrics
from martlet.sources.sinks import MART_NAMESPACE, drop_files, publish, subfolders, write_table
from martlet.sources.staging import Staging

MART_TABLES = (
    "dim_customers", "dim_date", "dim_products", "dim_sellers",
    "fact_orders", "fact_order_items",
)


class Mart:
    """Lazily planned star schema over ``staging``."""

    def __init__(self, staging: Staging | None, fact_orders: DataFrame | None = None):
        self.staging = staging
        self._fact_orders = fact_orders

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame]) -> "Mart":
        """A mart over already-built tables (e.g. read back from storage)."""
        m = cls(None, fact_orders=tables.get("fact_orders"))
        for name, df in tables.items():
            m.__dict__[name] = df  # pre-fill the cached properties
        return m

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dims.dim_customers(self.staging.customers, self.staging.orders)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return dims.dim_sellers(self.staging.sellers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dims.dim_products(self.staging.products, self.staging.translation)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.staging.orders, self.staging.order_items)

    @cached_property
    def payment_summary(self) -> DataFrame:
        return facts.payment_summary(self.staging.order_items, self.staging.order_payments)

    @cached_property
    def fact_orders(self) -> DataFrame:
        if self._fact_orders is not None:
            return self._fact_orders
        s = self.staging
        return facts.fact_orders(s.orders, s.customers, s.order_items, s.order_payments)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return facts.fact_order_items(self.staging.order_items, self.fact_orders)

    def table(self, name: str) -> DataFrame:
        if name not in MART_TABLES and name != "payment_summary":
            raise KeyError(name)
        return getattr(self, name)


def read_mart(spark: SparkSession, paths: dict[str, str]) -> Mart:
    return Mart.from_tables({name: spark.read.parquet(p) for name, p in paths.items()})


def write_mart(spark: SparkSession, mart: Mart, out_dir: str,
               tables: tuple[str, ...] = MART_TABLES, *, skip_empty: bool = False,
               concurrent: bool = True) -> dict[str, str]:
    """Write a new version of the star as parquet; the folder of each table.

    Every call writes to folders of its own, ``out_dir/marts/<table>/<version>``,
    and touches no earlier version, so a failed build or an open reader is never
    left with half a table; ``publish_mart`` then switches the table names.

    Models are full rebuilds (no empty-source guard by default: checking an
    aggregate for emptiness would run most of its plan twice). The four
    dimensions and the order fact do not depend on each other, so
    their jobs are submitted together from a small thread pool: the scheduler
    then fills cores that one job's narrow stages leave idle. The order fact
    is then read back from storage for the item fact, so the order plan runs
    once and its lineage is cut at a durable path.
    """
    wanted = [t for t in MART_TABLES if t in tables]
    if "fact_order_items" in wanted and "fact_orders" not in wanted:
        wanted.insert(wanted.index("fact_order_items"), "fact_orders")
    first = [t for t in wanted if t != "fact_order_items"]
    base = out_dir.rstrip("/") + "/marts"
    # sorts by time; the tail keeps two builds of one moment apart
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    paths: dict[str, str] = {}

    def write(name: str, m: Mart) -> None:
        path = f"{base}/{name}/{version}"
        if write_table(m.table(name), path, skip_empty=skip_empty):
            paths[name] = path

    if concurrent and len(first) > 1:
        with ThreadPoolExecutor(max_workers=len(first)) as pool:
            for f in [pool.submit(write, t, mart) for t in first]:
                f.result()
    else:
        for t in first:
            write(t, mart)
    if "fact_order_items" in wanted:
        stored = spark.read.parquet(paths["fact_orders"]) if "fact_orders" in paths else None
        write("fact_order_items", Mart(mart.staging, fact_orders=stored) if stored is not None else mart)
    return {t: paths[t] for t in wanted if t in paths}


def publish_mart(spark: SparkSession, paths: dict[str, str],
                 namespace: str = MART_NAMESPACE, keep: int = 2) -> dict[str, str]:
    """Switch ``namespace.<table>`` to the versions in ``paths``; the table names.

    The ``keep`` newest versions of each table stay on disk (the one before lets
    open readers finish); older ones are removed.
    """
    names = {t: publish(spark, t, path, namespace) for t, path in paths.items()}
    for path in paths.values():
        folder, current = path.rsplit("/", 1)
        older = [v for v in subfolders(spark, folder) if v < current]
        for version in older[:max(0, len(older) - keep + 1)]:
            drop_files(spark, f"{folder}/{version}")
    return names


# The dashboard metrics over a star.
METRICS: dict[str, Callable[[Mart], DataFrame]] = {
    "total_revenue": lambda m: metrics.total_revenue(m.fact_order_items),
    "total_customers": lambda m: metrics.total_customers(m.fact_orders),
    "total_orders": lambda m: metrics.total_orders(m.fact_orders),
    "average_order_value": lambda m: metrics.average_order_value(m.fact_order_items),
    "sales_overview": lambda m: metrics.sales_overview(m.fact_orders, m.fact_order_items),
    "monthly_revenue_growth": lambda m: metrics.monthly_revenue_growth(m.fact_orders, m.fact_order_items),
    "top_cities": lambda m: metrics.top_cities(m.fact_orders, m.fact_order_items, m.dim_customers),
    "top_categories": lambda m: metrics.top_categories(m.fact_order_items, m.dim_products),
    "segments_by_state": lambda m: metrics.segments_by_state(
        m.fact_orders, m.fact_order_items, m.dim_customers),
    "segments_by_city": lambda m: metrics.segments_by_city(
        m.fact_orders, m.fact_order_items, m.dim_customers),
    "top_products_by_revenue": lambda m: metrics.top_products(m.fact_order_items, m.dim_products, "revenue"),
    "top_products_by_quantity": lambda m: metrics.top_products(m.fact_order_items, m.dim_products, "quantity"),
    "top_sellers_by_revenue": lambda m: metrics.top_sellers(m.fact_order_items, m.dim_sellers, "revenue"),
    "top_sellers_by_quantity": lambda m: metrics.top_sellers(m.fact_order_items, m.dim_sellers, "quantity"),
    "high_performers": lambda m: metrics.high_performers(m.fact_order_items),
    "product_contribution": lambda m: metrics.product_contribution(m.fact_order_items),
    "product_pareto": lambda m: metrics.product_pareto(m.fact_order_items),
    "sales_by_quantity": lambda m: metrics.sales_by_quantity(m.fact_order_items),
    "customer_cohorts": lambda m: metrics.customer_cohorts(m.fact_orders),
}
