"""The star as versions that switch as one, maintained month by month.

``StarVersions`` keeps the six tables as one versioned table set. ``rebuild`` writes them
all; ``maintain`` takes the staged rows that changed and rewrites only the parts of the
star that depend on them, then commits all tables as one version:

* facts are stored by purchase month. The months to rewrite are those where a changed order
  stood and where it stands now; within them its rows are replaced, the others kept.
* customers are stored by key bucket. Only buckets with a person of a changed order or
  customer row are rewritten.
* the calendar is stored by month; only months with a time of a changed row are rewritten.
* products and sellers are rebuilt if a row of theirs changed.

The result equals a full rebuild over the changed staging layer (the tests compare them).
Staging is scanned, with pushed column selections, and semi-joined with the changed keys,
so what is shuffled grows with the change; unchanged months are neither read nor written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.timekeys import blank_to_null, try_minute_key
from martlet.operators import dims, facts
from martlet.plans.mart import MART_TABLES, Mart
from martlet.session import shuffles_removed
from martlet.sources.sinks import PACKED, drop_files
from martlet.sources.staging import Staging
from martlet.sources.versioned import Manifest, TableVersion, VersionedTables

NO_MONTH = "none"
CUSTOMER_PARTS = 64
DIGEST_BUCKETS = 1 << 16

# Staging table -> its time columns (they feed the calendar).
_TIMES = {"orders": list(dims.ORDER_TIME_COLUMNS), "order_items": ["shipping_limit_date"]}


def _month(key: Column) -> Column:
    """yyyyMM of a minute key, as text."""
    return F.coalesce(F.floor(key / 1000000).cast("bigint").cast("string"), F.lit(NO_MONTH))


def _bucket(person: Column) -> Column:
    return F.pmod(F.xxhash64(person), F.lit(CUSTOMER_PARTS)).cast("string")


def _differing(both: DataFrame, names: list[str]) -> DataFrame:
    """Rows of those buckets whose two sides differ, by a digest of each bucket.

    A row's bucket is a hash of the row; a bucket's digest is the number of its rows and two
    sums over a second hash, map-side combined to ``DIGEST_BUCKETS`` rows a task at most. So
    a table that did not change is scanned and hashed, but no row of it is shuffled. A bucket that
    differs is told equal only if both sums (of the halves of 64 bits) agree by chance.
    """
    row = [*names, *[F.col(n).isNull() for n in names]]  # a hash alone passes over nulls
    both = both.withColumn("_bucket", F.pmod(F.xxhash64(*row), F.lit(DIGEST_BUCKETS)))
    second = F.xxhash64(F.lit("second"), *row)
    digests = both.select("_bucket", "_n", second.alias("_h")).groupBy("_bucket").agg(
        F.sum("_n").alias("rows"), F.sum(F.col("_n") * F.shiftright("_h", 32)).alias("high"),
        F.sum(F.col("_n") * F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"))
    differ = digests.where("rows != 0 OR high != 0 OR low != 0").select("_bucket")
    return both.join(F.broadcast(differ), "_bucket", "left_semi").drop("_bucket")


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other: old and new rows of every change.

    One aggregate over the rows of both sides that stand in differing buckets, combined
    map-side; equal rows cancel out.
    """
    names = before.columns
    both = before.select(*names, F.lit(-1).alias("_n")).unionByName(
        after.select(*names, F.lit(1).alias("_n")))
    return _differing(both, names).groupBy(*names).agg(F.sum("_n").alias("_n")).where(
        "_n != 0").select(*names)


def _at_once(jobs: dict[str, Callable[[], object]], together: bool = True) -> dict:
    """The results of jobs that do not depend on each other, submitted together: one job's
    narrow stages leave cores idle that the others fill. Otherwise one after another, so
    that the shuffle files of only one lie on disk."""
    with ThreadPoolExecutor(max_workers=4 if together else 1) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def staging_changes(before: Staging, after: Staging) -> dict[str, DataFrame]:
    """Changed rows of every staging table that the star is built from."""
    return {name: changed_rows(getattr(before, name), getattr(after, name)) for name in (
        "customers", "orders", "order_items", "products", "order_payments", "sellers", "translation")}


class StarVersions:
    def __init__(self, spark: SparkSession, root: str, together: bool = True):
        """``together``: whether independent tables are written at once."""
        self.spark, self.tables, self.together = spark, VersionedTables(spark, root), together

    @contextmanager
    def _work(self) -> Iterator[str]:
        """A folder that goes with this block. The shuffle files behind what is written or
        collected in the block go with each query."""
        work = f"{self.tables.root}/work/{uuid.uuid4().hex}"
        try:
            with shuffles_removed(self.spark):
                yield work
        finally:
            drop_files(self.spark, work)

    def _staged(self, work: str, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` written below ``work`` and read back."""
        rows.write.options(**PACKED).parquet(f"{work}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{work}/{name}")

    def mart(self, version: int | None = None) -> Mart:
        """All tables of one version (the newest by default)."""
        manifest = self.tables.manifest(version)
        return Mart.from_tables({t: self.tables.read(manifest, t) for t in manifest.tables})

    def rebuild(self, staging: Staging, tables: tuple[str, ...] = MART_TABLES) -> Manifest:
        """A full build of ``tables``; other tables stay as they are in the newest version."""
        base, mart = self.tables.manifest(), Mart(staging)
        with self._work() as work:
            def write(name: str, rows: DataFrame, part: Column | str | None) -> TableVersion:
                if not name.startswith("fact_"):
                    return self.tables.write(name, rows, part)
                # dealt out by month when the shuffle files of the fact's joins are gone
                done = self.tables.write(name, self._staged(work, name, rows), part)
                drop_files(self.spark, f"{work}/{name}")
                return done

            new = _at_once({
                name: partial(write, name, *self._split(name, mart.table(name)))
                for name in MART_TABLES if name in tables and name != "fact_order_items"}, self.together)
            if "fact_order_items" in tables:
                orders = new.get("fact_orders") or base.tables["fact_orders"]
                stored = self.tables.read(Manifest(0, {"fact_orders": orders}), "fact_orders")
                new["fact_order_items"] = write("fact_order_items", *self._items(staging.order_items, stored))
        return self.tables.commit(base, new, kind="rebuild")

    @staticmethod
    def _split(name: str, rows: DataFrame) -> tuple[DataFrame, Column | None]:
        part = {"fact_orders": _month(F.col("purchase_date_id")), "dim_date": _month(F.col("date_id")),
                "dim_customers": _bucket(F.col("customer_id"))}.get(name)
        return rows, part

    @staticmethod
    def _items(items: DataFrame, orders: DataFrame) -> tuple[DataFrame, str]:
        """Item fact rows with the month of their order row, and that column's name."""
        dated = orders.select("order_id", _month(F.col("purchase_date_id")).alias("_month"))
        rows = facts.aggregated_items(items).join(dated, "order_id").select(
            "order_id", "product_id", "seller_id", "quantity", "total_price", "total_freight",
            "shipping_limit_date_id", "_month")
        return rows, "_month"

    # -- maintenance ---------------------------------------------------------------

    def maintain(self, staging: Staging, changes: dict[str, DataFrame]) -> Manifest:
        """Bring the newest version up to ``staging``; ``changes``: for each staging table the
        old and new rows that differ from the layer that version was built from."""
        with self._work() as work:
            return self._maintain(staging, changes, partial(self._staged, work))

    def _maintain(self, staging, changes, staged) -> Manifest:
        base = self.tables.manifest()
        changes = _at_once({name: partial(staged, name, rows) for name, rows in changes.items()}, self.together)
        new, replaced = {}, {}

        def order_facts() -> None:
            ids = staged("ids", self._changed_orders(staging, changes))
            if not ids.isEmpty():
                self._facts(base, staging, ids, staged, new, replaced)

        def products() -> None:
            if not (changes["products"].isEmpty() and changes["translation"].isEmpty()):
                new["dim_products"] = self.tables.write(
                    "dim_products", dims.dim_products(staging.products, staging.translation))

        def sellers() -> None:
            if not changes["sellers"].isEmpty():
                new["dim_sellers"] = self.tables.write("dim_sellers", dims.dim_sellers(staging.sellers))

        _at_once({
            "facts": order_facts,
            "customers": lambda: self._customers(base, staging, changes, staged, new, replaced),
            "calendar": lambda: self._calendar(base, staging, changes, new, replaced),
            "products": products, "sellers": sellers}, self.together)
        return self.tables.commit(base, new, replaced, kind="maintain")

    @staticmethod
    def _changed_orders(staging: Staging, changes: dict[str, DataFrame]) -> DataFrame:
        """Ids of the orders with a changed row of their own, or of their customer."""
        own = [changes[t].select("order_id") for t in ("orders", "order_items", "order_payments")]
        moved = changes["customers"].select("customer_id").distinct()
        own.append(staging.orders.join(moved, "customer_id", "left_semi").select("order_id"))
        return reduce(DataFrame.unionByName, own).where("order_id IS NOT NULL").distinct()

    def _facts(self, base, staging, ids, staged, new, replaced) -> None:
        def of(rows: DataFrame) -> DataFrame:
            return rows.join(ids, "order_id", "left_semi")

        orders = staged("fact_orders", facts.fact_orders(
            of(staging.orders), staging.customers, of(staging.order_items), of(staging.order_payments)))
        month = _month(F.col("purchase_date_id"))
        stood = of(self.tables.read(base, "fact_orders").select("order_id", "purchase_date_id"))
        months = [r[0] for r in stood.select(month.alias("m")).unionByName(
            orders.select(month.alias("m"))).distinct().collect()]  # a row a calendar month

        def kept(table: str, **options) -> DataFrame:
            return self.tables.read(base, table, months, **options).join(ids, "order_id", "left_anti")

        items, part = self._items(of(staging.order_items), orders)
        replaced |= {"fact_orders": months, "fact_order_items": months}
        new["fact_orders"] = self.tables.write(
            "fact_orders", *self._split("fact_orders", kept("fact_orders").unionByName(orders)))
        new["fact_order_items"] = self.tables.write(
            "fact_order_items", kept("fact_order_items", part_as=part).unionByName(items), part)

    def _customers(self, base, staging, changes, staged, new, replaced) -> None:
        by_order = staging.customers.unionByName(changes["customers"]).join(
            changes["orders"].select("customer_id").distinct(), "customer_id", "left_semi")
        people = staged("people", by_order.unionByName(changes["customers"]).select(
            F.struct("customer_unique_id").alias("person")).distinct())  # null equals null
        buckets = [r[0] for r in people.select(
            _bucket(F.col("person.customer_unique_id"))).distinct().collect()]
        if not buckets:
            return
        customers = staging.customers.withColumn("person", F.struct("customer_unique_id")).join(
            people, "person", "left_semi").drop("person")
        orders = staging.orders.join(customers.select("customer_id"), "customer_id", "left_semi")
        kept = self.tables.read(base, "dim_customers", buckets).withColumn(
            "person", F.struct(F.col("customer_id").alias("customer_unique_id"))).join(
                people, "person", "left_anti").drop("person")
        replaced["dim_customers"] = buckets
        new["dim_customers"] = self.tables.write("dim_customers", *self._split(
            "dim_customers", kept.unionByName(dims.dim_customers(customers, orders))))

    def _calendar(self, base, staging, changes, new, replaced) -> None:
        times = reduce(DataFrame.unionByName, [changes[t].select(F.explode(F.array(*columns)).alias("t"))
                                               for t, columns in _TIMES.items()])
        months = [r[0] for r in times.where(blank_to_null("t").isNotNull()).select(
            _month(try_minute_key("t"))).distinct().collect()]
        if months:
            replaced["dim_date"] = months
            rows = dims.dim_date(staging.orders, staging.order_items).where(
                _month(F.col("date_id")).isin(months))
            new["dim_date"] = self.tables.write("dim_date", *self._split("dim_date", rows))
