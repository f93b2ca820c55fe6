"""Dashboard metrics over the star.

Revenue is the sum of ``fact_order_items.total_price``: the order fact's
``total_order_amount`` counts each item once per payment and is NULL for
orders without payments, so it is not a revenue figure.

Plan shape used throughout: aggregate the item fact to the grain of the
next join first (per order, per product, per seller), then join the next
table, so each shuffle carries pre-aggregated rows and a hot key reaches the
join as one row per map task. Money is summed in exact integer cents
(order-independent, primitive long arithmetic) and turned into the DOUBLE
nearest to its 2-place value at the end; ratios divide two such DOUBLEs.
Dimension joins are left to the planner: AQE switches them to broadcast from
runtime shuffle sizes when a side is small.

Top-k reports use ``orderBy(...).limit(k)`` with a full tie-break, planned as
a distributed TakeOrderedAndProject (each task keeps its own top k).
Shares of total use a scalar subquery for the total, not a cross join or an
unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.money import cents, from_cents
from martlet.operators.joins import attach_to_few
from martlet.operators.ordered import running_total

TOP_K = 10


def _rev(col: str = "total_price") -> Column:
    """Revenue summand in exact integer cents (item-fact prices are DOUBLEs of
    exact 2-place values); sums stay in primitive longs."""
    return cents(col)


def _money(col: Column | str) -> Column:
    """A cents sum as the DOUBLE nearest to its exact 2-place value."""
    return from_cents(F.col(col) if isinstance(col, str) else col)


def _dbl(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double")


def year_of_key(key: Column) -> Column:
    return (key / 100000000).cast("int")


def month_of_key(key: Column) -> Column:
    return ((key / 1000000).cast("bigint") % 100).cast("int")


def revenue_per_order(fact_order_items: DataFrame) -> DataFrame:
    return fact_order_items.groupBy("order_id").agg(
        F.sum(_rev()).alias("revenue"), F.sum("quantity").alias("quantity")
    )


# -- K1-K4: sales overview ---------------------------------------------------

def total_revenue(fi: DataFrame) -> DataFrame:
    return fi.agg(_money(F.sum(_rev())).alias("total_revenue"))


def total_customers(fo: DataFrame) -> DataFrame:
    return fo.agg(F.count_distinct("customer_id").alias("total_customers"))


def total_orders(fo: DataFrame) -> DataFrame:
    return fo.agg(F.count_distinct("order_id").alias("total_orders"))


def average_order_value(fi: DataFrame) -> DataFrame:
    """Revenue over the number of distinct orders that have items."""
    per_order = revenue_per_order(fi)
    return per_order.agg(
        (_money(F.sum("revenue")) / _dbl(F.count("order_id"))).alias("average_order_value"),
        F.count("order_id").alias("orders_with_items"),
    )


def sales_overview(fo: DataFrame, fi: DataFrame) -> DataFrame:
    """K1-K4 as one row: each is a global aggregate; the four single-row
    results are combined through scalar subqueries."""
    per_order = revenue_per_order(fi)
    # one scalar subquery (a one-row struct) carries both item-side figures
    rev = per_order.agg(F.struct(
        _money(F.sum("revenue")).alias("r"),
        (_money(F.sum("revenue")) / _dbl(F.count("order_id"))).alias("aov"),
    ).alias("s")).scalar()
    counts = fo.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    return counts.select(
        rev.getField("r").alias("total_revenue"),
        "total_customers",
        "total_orders",
        rev.getField("aov").alias("average_order_value"),
    )


# -- K5: monthly revenue growth ---------------------------------------------

def monthly_revenue(fo: DataFrame, fi: DataFrame) -> DataFrame:
    """Item revenue by the purchase month of its order.

    The month is read off the calendar key (``yyyyMMddHHmm``) instead of
    joining the minute calendar, whose size grows with the time range; every
    non-NULL order key resolves in the calendar (the relationship test checks
    it), so this equals the star join.
    """
    per_order = revenue_per_order(fi)
    orders = fo.select("order_id", "purchase_date_id").where(F.col("purchase_date_id").isNotNull())
    joined = per_order.join(orders, "order_id")
    key = F.col("purchase_date_id")
    return joined.groupBy(year_of_key(key).alias("year"), month_of_key(key).alias("month")).agg(
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )


def monthly_revenue_growth(fo: DataFrame, fi: DataFrame) -> DataFrame:
    """Revenue per month and its growth over the previous month present.

    The window runs over the monthly aggregate, whose size is bounded by the
    number of calendar months, not by the data volume.
    """
    m = monthly_revenue(fo, fi)
    w = Window.orderBy("year", "month")
    prev = F.lag("revenue").over(w)
    return m.select(
        "year", "month",
        _money("revenue").alias("revenue"),
        "orders",
        _money(prev).alias("prev_revenue"),
        ((_money("revenue") - _money(prev)) / _money(prev)).alias("growth"),
    )


# -- K6, K8: customers by place ----------------------------------------------

def revenue_by_customer(fo: DataFrame, fi: DataFrame) -> DataFrame:
    """Revenue and orders with items per customer.

    The join leaves its rows dealt by order, so an order that a fact holds twice is found
    without another exchange; customers then take one exchange, combined map-side.
    """
    per_order = revenue_per_order(fi)
    j = per_order.join(fo.select("order_id", "customer_id"), "order_id")
    once = j.groupBy("order_id", "customer_id").agg(F.sum("revenue").alias("revenue"))
    return once.groupBy("customer_id").agg(
        F.sum("revenue").alias("revenue"), F.count("order_id").alias("orders"))


def _place_sales(fo: DataFrame, fi: DataFrame, dim_customers: DataFrame,
                 keys: list[str]) -> DataFrame:
    """Sales per place. A customer is one row on either side (the unique test of
    ``dim_customers`` checks it), so customers are counted, not made distinct."""
    j = revenue_by_customer(fo, fi).join(dim_customers.select("customer_id", *keys), "customer_id")
    return j.groupBy(*keys).agg(
        _money(F.sum("revenue")).alias("revenue"),
        F.sum("orders").alias("orders"),
        F.count("customer_id").alias("customers"),
    )


def top_cities(fo: DataFrame, fi: DataFrame, dim_customers: DataFrame, k: int = TOP_K) -> DataFrame:
    s = _place_sales(fo, fi, dim_customers, ["city", "state"])
    return s.orderBy(F.col("revenue").desc_nulls_last(), F.col("city").asc_nulls_last(),
                     F.col("state").asc_nulls_last()).limit(k)


def segments_by_state(fo: DataFrame, fi: DataFrame, dim_customers: DataFrame) -> DataFrame:
    return _place_sales(fo, fi, dim_customers, ["state"])


def segments_by_city(fo: DataFrame, fi: DataFrame, dim_customers: DataFrame) -> DataFrame:
    return _place_sales(fo, fi, dim_customers, ["state", "city"])


# -- K7, K9-K15: products and sellers -----------------------------------------

def product_sales(fi: DataFrame) -> DataFrame:
    return fi.groupBy("product_id").agg(
        F.sum(_rev()).alias("revenue"), F.sum("quantity").alias("quantity")
    )


def seller_sales(fi: DataFrame) -> DataFrame:
    return fi.groupBy("seller_id").agg(
        F.sum(_rev()).alias("revenue"), F.sum("quantity").alias("quantity")
    )


def top_categories(fi: DataFrame, dim_products: DataFrame, k: int = TOP_K) -> DataFrame:
    ps = product_sales(fi)
    j = ps.join(dim_products.select("product_id", "category_name"), "product_id")
    agg = j.groupBy("category_name").agg(
        _money(F.sum("revenue")).alias("revenue"), F.sum("quantity").alias("quantity")
    )
    return agg.orderBy(F.col("revenue").desc_nulls_last(),
                       F.col("category_name").asc_nulls_last()).limit(k)


def _top(sales: DataFrame, key: str, by: str, k: int) -> DataFrame:
    return sales.orderBy(F.col(by).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k).select(
        key, _money("revenue").alias("revenue"), "quantity"
    )


def top_products(fi: DataFrame, dim_products: DataFrame, by: str = "revenue",
                 k: int = TOP_K) -> DataFrame:
    """Top ``k`` products by ``by``; the category is attached after the cut,
    so only ``k`` rows meet the dimension."""
    top = _top(product_sales(fi), "product_id", by, k)
    dims = dim_products.select("product_id", "category_name")
    return attach_to_few(top, dims, "product_id").select(
        "product_id", "category_name", "revenue", "quantity"
    )


def top_sellers(fi: DataFrame, dim_sellers: DataFrame, by: str = "revenue",
                k: int = TOP_K) -> DataFrame:
    """Top ``k`` sellers by ``by`` with the seller's place attached after the cut."""
    top = _top(seller_sales(fi), "seller_id", by, k)
    dims = dim_sellers.select("seller_id", "city", "state")
    return attach_to_few(top, dims, "seller_id").select(
        "seller_id", "city", "state", "revenue", "quantity"
    )


def _with_share(df: DataFrame, fi: DataFrame) -> DataFrame:
    total = fi.agg(_money(F.sum(_rev())).alias("t")).scalar()
    return df.withColumn("revenue_share", F.col("revenue") / total)


def high_performers(fi: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top products and top sellers by revenue with rank and share of revenue."""
    parts = []
    for kind, sales, key in (("product", product_sales(fi), "product_id"),
                             ("seller", seller_sales(fi), "seller_id")):
        top = sales.orderBy(F.col("revenue").desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)
        parts.append(top.select(
            F.lit(kind).alias("kind"), F.col(key).alias("id"),
            _money("revenue").alias("revenue"), F.col("quantity"),
        ))
    both = parts[0].unionByName(parts[1])
    # rank inside each kind over at most k rows per kind
    w = Window.partitionBy("kind").orderBy(F.col("revenue").desc_nulls_last(),
                                           F.col("id").asc_nulls_last())
    return _with_share(both.withColumn("rank", F.row_number().over(w)), fi)


def product_contribution(fi: DataFrame) -> DataFrame:
    """Every product's revenue, quantity and share of total revenue."""
    ps = product_sales(fi).select("product_id", _money("revenue").alias("revenue"), "quantity")
    return _with_share(ps, fi)


def product_pareto(fi: DataFrame) -> DataFrame:
    """Products with their share of total revenue and the cumulative share in the order
    of revenue (descending, ties by id) -- the running total is computed in parallel
    over range partitions (``operators.ordered``)."""
    ps = product_sales(fi)
    order = [F.col("revenue").desc_nulls_last(), F.col("product_id").asc_nulls_last()]
    ranked = running_total(ps, order, "revenue", "cum_revenue")
    total = _money(fi.agg(F.sum(_rev()).alias("t")).scalar())
    return ranked.select(
        "product_id",
        _money("revenue").alias("revenue"),
        "quantity",
        (_money("revenue") / total).alias("revenue_share"),
        (_money("cum_revenue") / total).alias("cumulative_share"),
    )


def sales_by_quantity(fi: DataFrame) -> DataFrame:
    """Distribution of item-fact lines by units per line."""
    return fi.groupBy("quantity").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("order_id").alias("orders"),
        _money(F.sum(_rev())).alias("revenue"),
    )


# -- E1: cohorts --------------------------------------------------------------

def customer_cohorts(fo: DataFrame) -> DataFrame:
    """Customers active per (first-purchase month, months since it).

    Orders are reduced to distinct (customer, month) first, so a customer
    contributes at most one row per month whatever their order count, and
    the per-customer window runs over that bounded set.
    """
    key = F.col("purchase_date_id")
    months = fo.where(key.isNotNull() & F.col("customer_id").isNotNull()).select(
        "customer_id", (year_of_key(key) * 12 + month_of_key(key) - 1).alias("m")
    ).distinct()
    w = Window.partitionBy("customer_id")
    with_first = months.withColumn("first_m", F.min("m").over(w))
    cohort = (F.floor(F.col("first_m") / 12) * 100 + F.col("first_m") % 12 + 1).cast("int")
    return with_first.groupBy(
        cohort.alias("cohort_month"), (F.col("m") - F.col("first_m")).cast("int").alias("months_since")
    ).agg(F.count(F.lit(1)).alias("customers"))
