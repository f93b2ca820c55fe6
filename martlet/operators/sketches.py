"""Mergeable sketches kept with a build: distinct counts of any window, drift between builds.

* ``month_sketches``: per purchase month a HyperLogLog sketch of customers and of orders.
  Sketches merge without loss, so the distinct customers of any run of months come from a
  few kilobytes a month; the facts are not read again.
* ``profile``: per column a quantile sketch (KLL) of its values and its NULLs; ``drift``
  compares two builds by their profiles with the population-stability index over the
  baseline's deciles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# HyperLogLog: 2^16 registers (64 KB) give a relative error of about 0.4 %.
HLL_BITS = 16
# KLL: ranks within about 0.5 %.
KLL_SIZE = 400
DECILES = [i / 10 for i in range(1, 10)]
# The index from which a column counts as drifted, the least share of a bin.
DRIFTED = 0.25
LEAST_SHARE = 1e-4


def month_of(key: Column) -> Column:
    """yyyyMM of a minute key, as a number."""
    return F.floor(key / 1000000).cast("int")


def month_sketches(fact_orders: DataFrame) -> DataFrame:
    """(month, rows, customers, orders): one row a purchase month; without a key, NULL."""
    return fact_orders.groupBy(month_of(F.col("purchase_date_id")).alias("month")).agg(
        F.count("*").alias("rows"),
        F.hll_sketch_agg("customer_id", HLL_BITS).alias("customers"),
        F.hll_sketch_agg("order_id", HLL_BITS).alias("orders"))


def windows_of(month: Column) -> Column:
    """The windows a month belongs to: itself, its quarter, its year, all."""
    year, in_year = F.floor(month / 100), month % 100
    return F.array(
        F.concat(F.lit("month "), month.cast("string")),
        F.concat(F.lit("quarter "), year.cast("string"), F.lit("Q"), F.ceil(in_year / 3).cast("string")),
        F.concat(F.lit("year "), year.cast("string")), F.lit("all"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(window, rows, customers, orders) of every window, from the sketches alone."""
    return sketches.where("month IS NOT NULL").select(
        F.explode(windows_of(F.col("month"))).alias("window"), "rows", "customers", "orders",
    ).groupBy("window").agg(F.sum("rows").alias("rows"), *[
        F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("customers", "orders")])


def distinct_exact(fact_orders: DataFrame) -> DataFrame:
    """The same figures counted over the facts."""
    month = month_of(F.col("purchase_date_id"))
    return fact_orders.where(month.isNotNull()).select(
        F.explode(windows_of(month)).alias("window"), "customer_id", "order_id",
    ).groupBy("window").agg(
        F.count("*").alias("rows"), F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("order_id").alias("orders"))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, rows, nulls, sketch) of numeric columns; one pass, one row a column."""
    row = df.agg(F.count("*").alias("rows"), *[a for i, c in enumerate(columns) for a in (
        F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"),
        F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_SIZE).alias(f"sketch_{i}"))])
    return row.select("rows", F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"nulls_{i}").alias("nulls"), F.col(f"sketch_{i}").alias("sketch"))
        for i, c in enumerate(columns)])).alias("x")).select("x.column", "rows", "x.nulls", "x.sketch")


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of parts of a table as one."""
    return profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.kll_merge_agg_double("sketch", KLL_SIZE).alias("sketch"))


def drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(column, rows, nulls, stability_index, status) of the current build against the baseline.

    Both sketches give the share of values in each bin between the baseline's deciles (equal
    deciles, as of a column with few values, are one); NULLs are a bin of their own. A column
    that one build does not have fails, and so does an empty build after one with rows."""
    n = {side: F.kll_sketch_get_n_double(f"{side}sketch") for side in ("old_", "")}
    old = baseline.select("column", *[F.col(c).alias(f"old_{c}") for c in ("rows", "nulls", "sketch")])
    # at most nine cuts a column reach the driver: ranks are asked for at literal values
    cuts = {r["column"]: sorted(set(r["cuts"] or [])) for r in old.select("column", F.when(
        n["old_"] > 0, F.kll_sketch_get_quantile_double("old_sketch", F.array(*map(F.lit, DECILES)))
    ).alias("cuts")).collect()}
    both = old.join(current, "column", "full")

    def ranks_at_cuts(side: str) -> Column:
        out = F.array().cast("array<double>")
        for name, values in cuts.items():
            if values:
                at = F.when(n[side] > 0, F.kll_sketch_get_rank_double(
                    f"{side}sketch", F.array(*map(F.lit, values)))).otherwise(
                        F.array(*[F.lit(0.0)] * len(values)))
                out = F.when(F.col("column") == name, at).otherwise(out)
        return out

    def shares(side: str) -> Column:
        """Shares of all rows: NULLs, then the bins up to each cut and beyond the last."""
        total = F.greatest(F.col(f"{side}rows"), F.lit(1)).cast("double")
        edges = F.concat(F.array(F.lit(0.0)), ranks_at_cuts(side), F.array(F.lit(1.0)))
        filled = n[side] / total
        bins = F.transform(F.sequence(F.lit(1), F.size(edges) - 1),
                           lambda i: (F.get(edges, i) - F.get(edges, i - 1)) * filled)
        return F.concat(F.array(F.col(f"{side}nulls") / total), bins)

    def least(share: Column) -> Column:
        return F.greatest(share, F.lit(LEAST_SHARE))

    terms = F.zip_with(shares("old_"), shares(""), lambda p, q: (least(p) - least(q)) * F.log(least(p) / least(q)))
    index = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    status = F.when(F.col("stability_index") < DRIFTED, F.lit("pass")).otherwise(F.lit("fail"))
    return both.select("column", "rows", "nulls", index.alias("stability_index")).withColumn(
        "status", F.coalesce(status, F.lit("fail")))
