"""Data tests as DataFrames whose rows are the violations.

A test passes when its violation DataFrame is empty. ``test_report`` runs the
whole suite and returns one row per test with its failure count; it is one
Spark job that scans each table of the star once.

Semantics follow the usual column-test conventions: ``unique`` ignores NULLs
and reports one row per duplicated value; ``relationships`` ignores NULL
child keys and reports one row per orphan child row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.lifecycle import lifecycle_violation


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, columns: list[str] | str, count_name: str = "n_records",
           skip_nulls: bool = True) -> DataFrame:
    """One row per duplicated key with its row count.

    With ``skip_nulls`` (the column-test convention) rows with a NULL key
    part are ignored; otherwise NULL keys group like any value. Partial
    aggregation before the shuffle collapses a hot key to one row per map
    task.
    """
    cols = [columns] if isinstance(columns, str) else list(columns)
    keep = F.lit(True)
    if skip_nulls:
        for c in cols:
            keep = keep & F.col(c).isNotNull()
    return (
        df.where(keep)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias(count_name))
        .where(F.col(count_name) > 1)
    )


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows (the key only) whose non-NULL ``fk`` has no ``pk`` in ``parent``.

    A left-anti join: the parent side is reduced to its distinct keys, so the
    join never multiplies rows and AQE can broadcast it when it is small.
    """
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    c = child.select(F.col(fk)).where(F.col(fk).isNotNull())
    return c.join(keys, c[fk] == keys["_pk"], "left_anti")


def key_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL key: ``column``, ``_n``. One shuffle serves the unique
    test and every relationship test that uses the key as a parent."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))


def relationship_failures(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                          parent_keys: DataFrame | None = None) -> DataFrame:
    """Orphan count as one row, from per-key counts (skew-safe for a hot key)."""
    per_key = key_counts(child, fk)
    keys = (parent_keys if parent_keys is not None else key_counts(parent, pk)).select(
        F.col(pk).alias("_pk"))
    orphans = per_key.join(keys, per_key[fk] == keys["_pk"], "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("failures"))


def order_sequence_violations(fact_orders: DataFrame) -> DataFrame:
    """Order-fact rows with a non-NULL pair of lifecycle times out of order."""
    return fact_orders.where(lifecycle_violation())


def duplicate_order_items(fact_order_items: DataFrame) -> DataFrame:
    """(order, product) pairs that occur more than once in the item fact."""
    return unique(fact_order_items, ["order_id", "product_id"], count_name="duplicate_count",
                  skip_nulls=False)


@dataclass(frozen=True)
class Test:
    name: str
    table: str
    column: str
    kind: str  # not_null | unique | relationships | custom
    parent: str = ""
    parent_column: str = ""


# The test suite over the star (table, column, kind, target).
SUITE: tuple[Test, ...] = (
    Test("not_null_dim_customers_customer_id", "dim_customers", "customer_id", "not_null"),
    Test("unique_dim_customers_customer_id", "dim_customers", "customer_id", "unique"),
    Test("not_null_dim_sellers_seller_id", "dim_sellers", "seller_id", "not_null"),
    Test("unique_dim_sellers_seller_id", "dim_sellers", "seller_id", "unique"),
    Test("not_null_dim_products_product_id", "dim_products", "product_id", "not_null"),
    Test("unique_dim_products_product_id", "dim_products", "product_id", "unique"),
    Test("not_null_dim_date_date_id", "dim_date", "date_id", "not_null"),
    Test("unique_dim_date_date_id", "dim_date", "date_id", "unique"),
    Test("not_null_fact_orders_order_id", "fact_orders", "order_id", "not_null"),
    Test("unique_fact_orders_order_id", "fact_orders", "order_id", "unique"),
    Test("not_null_fact_orders_customer_id", "fact_orders", "customer_id", "not_null"),
    Test("relationships_fact_orders_customer_id", "fact_orders", "customer_id", "relationships",
         "dim_customers", "customer_id"),
    Test("not_null_fact_orders_purchase_date_id", "fact_orders", "purchase_date_id", "not_null"),
    Test("relationships_fact_orders_purchase_date_id", "fact_orders", "purchase_date_id",
         "relationships", "dim_date", "date_id"),
    Test("relationships_fact_orders_approved_date_id", "fact_orders", "approved_date_id",
         "relationships", "dim_date", "date_id"),
    Test("relationships_fact_orders_delivered_carrier_date_id", "fact_orders",
         "delivered_carrier_date_id", "relationships", "dim_date", "date_id"),
    Test("relationships_fact_orders_delivered_customer_date_id", "fact_orders",
         "delivered_customer_date_id", "relationships", "dim_date", "date_id"),
    Test("relationships_fact_orders_estimated_delivery_date_id", "fact_orders",
         "estimated_delivery_date_id", "relationships", "dim_date", "date_id"),
    Test("not_null_fact_order_items_order_id", "fact_order_items", "order_id", "not_null"),
    Test("relationships_fact_order_items_order_id", "fact_order_items", "order_id",
         "relationships", "fact_orders", "order_id"),
    Test("not_null_fact_order_items_product_id", "fact_order_items", "product_id", "not_null"),
    Test("relationships_fact_order_items_product_id", "fact_order_items", "product_id",
         "relationships", "dim_products", "product_id"),
    Test("not_null_fact_order_items_seller_id", "fact_order_items", "seller_id", "not_null"),
    Test("relationships_fact_order_items_seller_id", "fact_order_items", "seller_id",
         "relationships", "dim_sellers", "seller_id"),
    Test("relationships_fact_order_items_shipping_limit_date_id", "fact_order_items",
         "shipping_limit_date_id", "relationships", "dim_date", "date_id"),
    Test("assert_unique_fact_order_items", "fact_order_items", "order_id, product_id", "custom"),
    Test("assert_order_process_sequence", "fact_orders", "", "custom"),
)


def failures(test: Test, tables: dict[str, DataFrame]) -> DataFrame:
    """One-row DataFrame ``failures`` (bigint) for ``test``."""
    t = tables[test.table]
    if test.kind == "relationships":
        return relationship_failures(t, test.column, tables[test.parent], test.parent_column)
    if test.kind == "not_null":
        violations = not_null(t.select(test.column), test.column)
    elif test.kind == "unique":
        violations = unique(t.select(test.column), test.column)
    elif test.name == "assert_unique_fact_order_items":
        violations = duplicate_order_items(t)
    elif test.name == "assert_order_process_sequence":
        violations = order_sequence_violations(t)
    else:
        raise ValueError(test.name)
    return violations.agg(F.count(F.lit(1)).cast("bigint").alias("failures"))


def _status(col: Column) -> Column:
    return F.when(col == 0, F.lit("pass")).otherwise(F.lit("fail"))


def _unpivot(one_row: DataFrame, names: list[str]) -> DataFrame:
    """A one-row frame with a ``failures`` count per test name -> one row per test."""
    return one_row.unpivot([], names, "test_name", "failures")


def _key_of(test: Test) -> tuple[str, str]:
    return test.table, test.column


class KeyTests:
    """The tests of a suite as counts of keys.

    A row of a table becomes one (domain, place, key) entry per tested column; a domain is
    a key and all columns that refer to it, a place is a column in a domain. The counts of
    each (domain, key), ``n0``, ``n1`` ... by place, show all kinds of failure: a NULL key,
    a key counted twice, a counted key that its parent column does not have. So the failures
    of every test are sums over (domain, key), and the counts of disjoint rows add up.

    Domains and their places are numbers, and places are numbered in each domain anew: a row
    has as many counts as the largest domain has places, not as many as there are tests.
    """

    def __init__(self, kinds: tuple[str, ...] | None = None):
        self.suite = [t for t in SUITE if kinds is None or t.kind in kinds]
        # column -> the domain its keys belong to
        domain: dict[tuple[str, str], tuple[str, str]] = {}
        for t in self.suite:
            domain[_key_of(t)] = (t.parent, t.parent_column) if t.kind == "relationships" \
                else domain.get(_key_of(t), _key_of(t))
            if t.kind == "relationships":
                domain[t.parent, t.parent_column] = (t.parent, t.parent_column)
        # a column can be a child in one domain and the key of its own: one entry each
        owned = {_key_of(t) for t in self.suite if t.kind == "unique"} | {
            (t.parent, t.parent_column) for t in self.suite if t.kind == "relationships"}
        self.domain = domain
        self.places = sorted({(domain[c], c) for c in domain} | {(c, c) for c in owned})
        self.domains = sorted({d for d, _ in self.places})
        self.slots = {(d, c): [x for at, x in self.places if at == d].index(c) for d, c in self.places}
        self.counts = [f"n{i}" for i in range(max(self.slots.values(), default=0) + 1)]

    def entries(self, tables: dict[str, DataFrame]) -> DataFrame:
        """(domain, place, key) of the given tables, one scan each."""
        out = None
        for table in sorted({c[0] for _, c in self.places} & set(tables)):
            own = [(self.domains.index(d), i, c) for (d, c), i in self.slots.items() if c[0] == table]
            part = tables[table].select(F.explode(F.array(*[
                F.struct(F.lit(d).alias("domain"), F.lit(i).alias("place"),
                         _key_text(c).alias("key")) for d, i, c in own])).alias("e")).select("e.*")
            if ("fact_orders", "") in self.domain and table == "fact_orders":
                unmarked = self.domains.index(("fact_orders", ""))
                part = part.where(F.col("key").isNotNull() | (F.col("domain") != unmarked))
            out = part if out is None else out.unionByName(part)
        return out

    def counted(self, entries: DataFrame) -> DataFrame:
        """Counts per (domain, key), combined map-side: a hot key is a row per map task."""
        return entries.groupBy("domain", "key").agg(*[
            F.count_if(F.col("place") == i).alias(n) for i, n in enumerate(self.counts)])

    def failures(self) -> list[Column]:
        """An aggregate over counted keys per test, named after it."""
        return [F.coalesce(self._failed(t), F.lit(0)).cast("bigint").alias(t.name) for t in self.suite]

    def _failed(self, t: Test) -> Column:
        own = _key_of(t)
        domain = own if t.kind == "unique" else self.domain[own]
        here = F.col("domain") == self.domains.index(domain)

        def n(column: tuple[str, str]) -> Column:
            return F.col(f"n{self.slots[domain, column]}")

        if t.kind == "not_null":
            return F.sum(F.when(here & F.col("key").isNull(), n(own)))
        if t.kind == "unique":
            return F.count_if(here & F.col("key").isNotNull() & (n(own) > 1))
        if t.kind == "relationships":
            orphan = F.col("key").isNotNull() & (n((t.parent, t.parent_column)) == 0)
            return F.sum(F.when(here & orphan, n(own)))
        return F.count_if(here & (n(own) > 1)) if t.column else F.sum(F.when(here, n(own)))

    def report(self, row: DataFrame) -> DataFrame:
        """One row with the failures of each test -> a described row per test."""
        counts = _unpivot(row, [t.name for t in self.suite])

        def lookup(attr: str) -> Column:
            return F.create_map(*[F.lit(x) for t in self.suite for x in (t.name, getattr(t, attr))])[
                F.col("test_name")]

        return counts.select(
            "test_name",
            lookup("table").alias("table_name"),
            lookup("column").alias("column_name"),
            lookup("kind").alias("test_kind"),
            "failures",
            _status(F.col("failures")).alias("status"),
        )


def test_report(tables: dict[str, DataFrame], kinds: tuple[str, ...] | None = None) -> DataFrame:
    """(test_name, table_name, column_name, test_kind, failures, status), one row per test.

    The whole suite is one job with one scan per table and one aggregate (``KeyTests``).
    """
    tests = KeyTests(kinds)
    return tests.report(tests.counted(tests.entries(tables)).agg(*tests.failures()))


def _key_text(column: tuple[str, str]) -> Column:
    """The tested key as text: a column, several as one, or (for the lifecycle
    test, which has none) a mark on rows out of order."""
    names = [c.strip() for c in column[1].split(",")]
    if names == [""]:
        return F.when(lifecycle_violation(), F.lit("out of order"))
    if len(names) == 1:
        return F.col(names[0]).cast("string")
    # each part after its length, a NULL part as a dash: no two lists of parts look the same
    texts = [F.col(name).cast("string") for name in names]
    return F.concat(*[F.coalesce(F.concat(F.length(x), F.lit(":"), x), F.lit("-")) for x in texts])


# -- further quality checks (accepted values, ranges, row-count drift) ---------

# Order statuses a marketplace order can have.
ORDER_STATUSES = ("approved", "canceled", "created", "delivered", "invoiced",
                  "processing", "shipped", "unavailable")


def accepted_values(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows whose non-NULL ``column`` is outside ``values``."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def below(df: DataFrame, column: str, minimum: float) -> DataFrame:
    """Rows whose non-NULL ``column`` is below ``minimum``."""
    return df.where(F.col(column) < F.lit(minimum))


# Fixed value: largest share of staged orders the lifecycle filter may drop.
MAX_ORDER_LOSS = 0.05


def quality_report(tables: dict[str, DataFrame], staged_orders: DataFrame) -> DataFrame:
    """(check_name, table_name, column_name, failures, status) for the extra checks:
    one aggregate per table, whatever the number of checks."""
    price = "total_price"
    plain = {
        "fact_orders": {
            ("accepted_values", "status"): F.col("status").isNotNull()
            & ~F.col("status").isin(*ORDER_STATUSES),
            ("non_negative", "total_order_amount"): F.col("total_order_amount") < 0,
        },
        "fact_order_items": {
            ("non_negative", price): F.col(price) < 0,
            ("non_negative", "total_freight"): F.col("total_freight") < 0,
            ("positive", "quantity"): F.col("quantity") < 1,
        },
    }
    drift = "row_count_drift_fact_orders"
    staged = staged_orders.agg(F.count_distinct("order_id").alias("n")).scalar()
    where, out = {drift: ("fact_orders", "order_id")}, None
    for table, rules in plain.items():
        names = {f"{kind}_{table}_{column}": rule for (kind, column), rule in rules.items()}
        where |= {f"{kind}_{table}_{column}": (table, column) for kind, column in rules}
        counts = [F.count_if(rule).cast("bigint").alias(name) for name, rule in names.items()]
        if table == "fact_orders":
            counts.append(F.count_distinct("order_id").alias("kept"))
            row = tables[table].agg(*counts)
            row = row.select(*names, (staged - F.col("kept")).cast("bigint").alias(drift))
            names = {**names, drift: None}
        else:
            row = tables[table].agg(*counts)
        part = row.unpivot([], list(names), "check_name", "failures")
        out = part if out is None else out.unionByName(part)
    lost = F.col("failures") / staged > F.lit(MAX_ORDER_LOSS)
    failed = F.when(F.col("check_name") == drift, lost).otherwise(F.col("failures") > 0)

    def lookup(i: int) -> Column:
        return F.create_map(*[F.lit(x) for k, v in where.items() for x in (k, v[i])])[
            F.col("check_name")]

    return out.select("check_name", lookup(0).alias("table_name"), lookup(1).alias("column_name"),
                      "failures", F.when(failed, F.lit("fail")).otherwise(F.lit("pass")).alias("status"))
