"""Retention of customers: a dense cohort grid, and survival with censoring.

Customers belong to the month of their first order. The grid has every cohort month from
the first to the last month of the data, a month without new customers included, and for
each every month up to the last, a month without buyers included; what lies beyond the data
is not a zero and has no cell.

A customer without an order in the last ``INACTIVE`` months has left, after the month of the
last order; any other may still come back and is censored there. Survival is the product
over the months of the share that did not leave of those still under observation, kept as
an exact integer: parts of ``PARTS``, rounded down at each step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.metrics import month_of_key, year_of_key

INACTIVE = 6
PARTS = 1_000_000_000


def customer_months(fact_orders: DataFrame) -> DataFrame:
    """Distinct (customer_id, m): months with an order, counted from year 0."""
    key = F.col("purchase_date_id")
    return fact_orders.where(key.isNotNull() & F.col("customer_id").isNotNull()).select(
        "customer_id", (year_of_key(key) * 12 + month_of_key(key) - 1).alias("m")).distinct()


def _month(m: Column) -> Column:
    """yyyyMM of a month counted from year 0."""
    return (F.floor(m / 12) * 100 + m % 12 + 1).cast("int")


def retention_grid(fact_orders: DataFrame) -> DataFrame:
    """(cohort_month, months_since, size, customers, rate), every cell of the grid."""
    months = customer_months(fact_orders)
    first = months.groupBy("customer_id").agg(F.min("m").alias("first"))
    counts = months.join(first, "customer_id").groupBy(
        "first", (F.col("m") - F.col("first")).alias("since")).agg(F.count("*").alias("n"))
    # one row: the span of the data; its months make the grid
    cohorts = months.agg(F.min("m").alias("low"), F.max("m").alias("high")).where("low IS NOT NULL").select(
        F.explode(F.sequence("low", "high")).alias("first"), "high")
    sizes = counts.where("since = 0").select("first", F.col("n").alias("size"))
    grid = cohorts.select("first", F.explode(F.sequence(F.lit(0), F.col("high") - F.col("first"))).alias("since"))
    whole = grid.join(sizes, "first", "left").join(counts, ["first", "since"], "left").select(
        _month(F.col("first")).alias("cohort_month"), F.col("since").cast("int").alias("months_since"),
        F.coalesce("size", F.lit(0)).cast("long").alias("size"),
        F.coalesce("n", F.lit(0)).cast("long").alias("customers"))
    return whole.withColumn("rate", F.when(F.col("size") > 0, F.col("customers") / F.col("size")))


def retention_survival(fact_orders: DataFrame, inactive: int = INACTIVE) -> DataFrame:
    """(months_since, at_risk, left_after, censored, survival_parts): the product-limit
    estimate, one row for every month of a customer's life up to the longest."""
    months = customer_months(fact_orders)
    lives = months.groupBy("customer_id").agg(F.min("m").alias("low"), F.max("m").alias("high"))
    end = months.agg(F.max("m")).scalar()
    ended = lives.select((F.col("high") - F.col("low")).cast("int").alias("t"),
                         (end - F.col("high") >= inactive).alias("gone")).groupBy("t").agg(
        F.count_if("gone").alias("d"), F.count_if(~F.col("gone")).alias("c"))
    # one row a month of life from here on: bounded by the calendar
    found = ended.agg(F.max("t").alias("last"), F.map_from_entries(F.collect_list(
        F.struct("t", F.struct("d", "c")))).alias("by_t"), F.sum(F.col("d") + F.col("c")).alias("n"))
    steps = F.transform(F.sequence(F.lit(0), "last"), lambda t: F.struct(
        t.alias("t"), F.coalesce(F.try_element_at("by_t", t)["d"], F.lit(0).cast("long")).alias("d"),
        F.coalesce(F.try_element_at("by_t", t)["c"], F.lit(0).cast("long")).alias("c")))

    def step(done: Column, x: Column) -> Column:
        risk, survival = done["risk"], done["survival"]
        after = F.floor(survival * (risk - x["d"]).cast("decimal(20,0)") / F.greatest(
            risk, F.lit(1).cast("long")).cast("decimal(20,0)")).cast("decimal(20,0)")
        row = F.struct(x["t"].alias("months_since"), risk.alias("at_risk"), x["d"].alias("left_after"),
                       x["c"].alias("censored"), after.cast("long").alias("survival_parts"))
        return F.struct((risk - x["d"] - x["c"]).alias("risk"), after.alias("survival"),
                        F.concat(done["rows"], F.array(row)).alias("rows"))

    none = F.array().cast("array<struct<months_since:int,at_risk:bigint,left_after:bigint,"
                          "censored:bigint,survival_parts:bigint>>")
    start = F.struct(F.col("n").alias("risk"), F.lit(PARTS).cast("decimal(20,0)").alias("survival"),
                     none.alias("rows"))
    return found.where("last IS NOT NULL").select(
        F.explode(F.aggregate(steps, start, step, lambda done: done["rows"])).alias("x")).select("x.*")
