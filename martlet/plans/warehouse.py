"""Registered queries on the life of the loaded tables: versions, upserts, maintenance,
reconciliation by content, rejected rows, sketches, retention, drift.

Each derives its arrivals from the whole shared tables, works in a folder of its own below
the shared folder, and returns what a reader sees afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.money import cents, from_cents
from martlet.operators import retention, sketches
from martlet.plans import oracle
from martlet.plans.delta_tests import DeltaTests
from martlet.plans.star_versions import StarVersions, staging_changes
from martlet.plans.store import stored_mart, stored_staging, write_together
from martlet.session import shared_dir
from martlet.sources.csv import read_csv
from martlet.sources.evolving import EvolvingTable
from martlet.sources.ingest import FILE_PREFIX, FILE_SUFFIX, ingest_csv, read_rejects
from martlet.sources.reconcile import content_report, digest
from martlet.sources.staging import STAGING_SCHEMAS
from martlet.sources.versioned import VersionedTables
from martlet.streaming.upsert import UpsertTable, incremental_upsert

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
STAR_TABLES = ("dim_customers", "dim_sellers", "dim_products", "dim_date", "fact_orders", "fact_order_items")


def work_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/martlet-{what}/{uuid.uuid4().hex}"


# -- versions of the star (S15) ---------------------------------------------------


def star_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two builds and a rollback; each row is read from one version as a whole. The second
    build leaves the sellers alone, so its version names the first one's files."""
    staging = stored_staging(spark, sf_dir)
    star = StarVersions(spark, work_folder(spark, "versions"), write_together(spark, sf_dir))
    first = replace(staging, orders=staging.orders.where("order_status = 'delivered'"))
    star.rebuild(first, ("dim_sellers", "fact_orders", "fact_order_items"))
    star.rebuild(staging, ("fact_orders", "fact_order_items"))
    star.tables.rollback(1)
    out = None
    for version in star.tables.versions():
        mart = star.mart(version)
        orders, items = mart.fact_orders, mart.fact_order_items
        row = items.agg(F.count("*").alias("item_rows"), from_cents(
            F.sum(cents("total_price"))).alias("revenue")).select(
                F.lit(version).alias("version"), "item_rows", "revenue",
                orders.agg(F.count("*")).scalar().alias("order_rows"),
                mart.dim_sellers.agg(F.count("*")).scalar().alias("sellers"),
                items.join(orders, "order_id", "left_anti").agg(F.count("*")).scalar().alias("orphans"))
        out = row if out is None else out.unionByName(row)
    return out


QUERIES["star_versions"] = star_versions
ORACLE_SQL["star_versions"] = oracle.with_star("""
SELECT v.version, count(*) FILTER (v.version = 2 OR o.status = 'delivered') AS item_rows,
       CAST(sum(CAST(i.total_price AS DECIMAL(18,2))) FILTER (v.version = 2 OR o.status = 'delivered') AS DOUBLE) AS revenue,
       (SELECT count(*) FROM fact_orders f WHERE v.version = 2 OR f.status = 'delivered') AS order_rows,
       (SELECT count(*) FROM dim_sellers) AS sellers, 0 AS orphans
FROM fact_order_items i JOIN fact_orders o USING (order_id), (VALUES (1), (2), (3)) AS v(version)
GROUP BY v.version""")


# -- upserts (E2) -------------------------------------------------------------------


def _order_changes(orders: DataFrame) -> list[DataFrame]:
    """Three waves of order changes: all orders as created; some with their status, and old
    news; some deleted, with late news from before that, and some opened again."""
    k = F.col("order_id").cast("bigint")
    bought = F.col("order_purchase_timestamp").cast("timestamp")

    def news(where: Column, status: str | Column, days: int, op: str = "put") -> DataFrame:
        status = F.lit(status) if isinstance(status, str) else status
        return orders.where(where).withColumns({
            "order_status": status, "changed_at": bought + F.expr(f"INTERVAL '{days}' DAY"), "op": F.lit(op)})

    return [
        news(F.lit(True), "created", 0),
        news(k % 5 == 0, F.col("order_status"), 2).unionByName(news(k % 7 == 0, "old news", -1)),
        news(k % 11 == 0, "gone", 3, "delete").unionByName(news(k % 22 == 0, "late news", 1)).unionByName(
            news(k % 33 == 0, "opened again", 4)),
    ]


def orders_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged orders after three waves of changes, merged by a stream."""
    folder = work_folder(spark, "upsert")
    target = UpsertTable(spark, f"{folder}/tables", "stg_orders", ["order_id"], buckets=16)
    for number, wave in enumerate(_order_changes(stored_staging(spark, sf_dir).orders)):
        wave.write.parquet(f"{folder}/arrivals/wave={number}")
        incremental_upsert(
            spark, f"{folder}/arrivals", wave.schema, target, F.col("changed_at"), f"{folder}/checkpoint",
            deleted=F.col("op") == "delete", options={"recursiveFileLookup": "true"})
    return target.rows().drop("changed_at", "op")


QUERIES["orders_upsert"] = orders_upsert
ORACLE_SQL["orders_upsert"] = oracle.with_star("""
SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 33 = 0 THEN 'opened again'
                       WHEN CAST(order_id AS BIGINT) % 5 = 0 THEN order_status
                       ELSE 'created' END AS order_status)
FROM stg_orders WHERE CAST(order_id AS BIGINT) % 11 <> 0 OR CAST(order_id AS BIGINT) % 33 = 0""")


# -- incremental maintenance of the star (S15, M5, M6) ---------------------------------


def _before(staging):
    """The staging layer before a second wave: of two months, some orders are still missing,
    and some customers have another person's id."""
    k = F.regexp_replace("customer_id", "c", "").cast("bigint")
    in_march = staging.orders.where(
        F.col("order_purchase_timestamp").between("1997-03", "1997-04")).select("customer_id")
    moved = staging.customers.where(k % 3 == 0).join(in_march, "customer_id", "left_semi").withColumn(
        "customer_unique_id", F.concat(F.lit("old "), "customer_unique_id"))
    rest = staging.customers.join(moved.select("customer_id"), "customer_id", "left_anti")
    late = F.col("order_purchase_timestamp").between("1997-02", "1997-03") & (
        F.col("order_id").cast("bigint") % 2 == 0)
    return replace(staging, orders=staging.orders.where(~late),
                   customers=rest.unionByName(moved.select(*rest.columns)))


def mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star built before a second wave and maintained after it, by purchase month, with
    the months that were rewritten."""
    after = stored_staging(spark, sf_dir)
    star = StarVersions(spark, work_folder(spark, "maintain"), write_together(spark, sf_dir))
    before = _before(after)
    star.rebuild(before)
    done = star.maintain(after, staging_changes(before, after))
    mart = star.mart()
    month = F.floor(F.col("purchase_date_id") / 1000000).cast("bigint").cast("string")
    per_order = mart.fact_order_items.groupBy("order_id").agg(
        F.count("*").alias("lines"), F.sum(cents("total_price")).alias("cents"))
    dated = mart.fact_orders.join(mart.dim_customers, "customer_id", "left_semi").join(
        mart.dim_date.select(F.col("date_id").alias("purchase_date_id")), "purchase_date_id", "left_semi")
    return dated.join(per_order, "order_id", "left").groupBy(month.alias("month")).agg(
        F.count("*").alias("orders"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
        from_cents(F.sum("cents")).alias("revenue"),
    ).withColumn("rewritten", F.col("month").isin(done.info["replaced"].get("fact_orders", [])))


QUERIES["mart_incremental"] = mart_incremental
ORACLE_SQL["mart_incremental"] = oracle.with_star("""
SELECT CAST(o.purchase_date_id // 1000000 AS VARCHAR) AS month, count(*) AS orders,
       CAST(coalesce(sum(lines), 0) AS BIGINT) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue,
       bool_or((o.purchase_date_id // 1000000 = 199702 AND CAST(order_id AS BIGINT) % 2 = 0)
               OR (o.purchase_date_id // 1000000 = 199703 AND CAST(order_id AS BIGINT) % 3 = 0)) AS rewritten
FROM fact_orders o LEFT JOIN (
  SELECT order_id, count(*) AS lines, sum(CAST(total_price AS DECIMAL(18,2))) AS revenue
  FROM fact_order_items GROUP BY order_id) USING (order_id)
GROUP BY 1""")


# -- data tests over a change (C1-C3) ---------------------------------------------------


def star_before(star: dict[str, DataFrame]) -> tuple[dict, dict, dict]:
    """(an earlier star, the rows added since, the rows removed since): a month of orders and
    a fifth of the sellers are missing, some products stand twice, some items name no product."""
    def some(column: str, of: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(of)) == 0

    march = F.coalesce(F.col("purchase_date_id").between(199703000000, 199703999999), F.lit(False))
    lost = star["fact_order_items"].where(some("order_id", 97)).withColumn("product_id", F.lit(None).cast("string"))
    added = {"fact_orders": star["fact_orders"].where(march),
             "dim_sellers": star["dim_sellers"].where(some("seller_id", 5))}
    removed = {"dim_products": star["dim_products"].where(some("product_id", 7)), "fact_order_items": lost}
    before = star | {"fact_orders": star["fact_orders"].where(~march),
                     "dim_sellers": star["dim_sellers"].where(~some("seller_id", 5))}
    before |= {name: star[name].unionByName(rows) for name, rows in removed.items()}
    return before, added, removed


def test_report_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test report of the star, from the state of an earlier star and what changed."""
    mart = stored_mart(spark, sf_dir)
    before, added, removed = star_before({name: getattr(mart, name) for name in STAR_TABLES})
    tests = DeltaTests(spark, work_folder(spark, "tests"), buckets=8)
    tests.build(before)
    tests.apply(added, removed)
    return tests.report()


QUERIES["test_report_delta"] = test_report_delta
ORACLE_SQL["test_report_delta"] = oracle.with_star(oracle.report_sql(None))


# -- reconciliation by content (S8) --------------------------------------------------


def ingest_content_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments as a CSV file, loaded and reconciled by content; then against the stored
    table with one value altered, and with the types of two payments swapped."""
    folder = work_folder(spark, "csv")
    file = f"{folder}/{FILE_PREFIX}order_payments{FILE_SUFFIX}.csv"
    stored_staging(spark, sf_dir).order_payments.write.option("header", True).option(
        "quoteAll", True).option("escape", '"').csv(file)
    loaded = ingest_csv(spark, file, f"{folder}/staging", content=True,
                        schema=STAGING_SCHEMAS["stg_order_payments"])
    rows = spark.read.parquet(loaded.path)
    first = F.col("payment_sequential") == 1
    one, other = (rows.where(first & (F.col("payment_type") == kind)).agg(
        F.min(F.col("order_id").cast("bigint")).cast("string")).first()[0] for kind in ("boleto", "voucher"))
    altered = rows.withColumn("payment_value", F.when(
        first & (F.col("order_id") == one), F.col("payment_value") + 0.01).otherwise(F.col("payment_value")))
    swapped = rows.withColumn("payment_type", F.when(first & (F.col("order_id") == one), "voucher").when(
        first & (F.col("order_id") == other), "boleto").otherwise(F.col("payment_type")))
    source = loaded.source_content
    return content_report(spark, {
        "loaded": (source, loaded.target_content), "altered": (source, digest(altered)),
        "swapped": (source, digest(swapped.repartition(3)))})


QUERIES["ingest_content_reconciliation"] = ingest_content_reconciliation
ORACLE_SQL["ingest_content_reconciliation"] = oracle.with_star("""
SELECT t AS "table", c AS "column", n AS source_rows, n AS target_rows,
       NOT ((t = 'altered' AND c IN ('*', 'payment_value')) OR (t = 'swapped' AND c = '*')) AS match
FROM (VALUES ('loaded'), ('altered'), ('swapped')) AS tables(t),
     (VALUES ('*'), ('order_id'), ('payment_sequential'), ('payment_type'), ('payment_installments'),
             ('payment_value')) AS columns(c),
     (SELECT count(*) AS n FROM stg_order_payments)""")


# -- schemas that drift between loads (S12) --------------------------------------------


def _payment_waves(pay: DataFrame) -> list[DataFrame]:
    """Three files of payments, each with other columns: whole amounts; amounts with cents,
    reordered, one column fewer and one more; ids that are no numbers, and gaps."""
    k = F.col("order_id").cast("bigint")
    text = F.format_string("%.2f", "payment_value").alias("payment_value")
    return [
        pay.where(k % 3 == 0).select(
            "order_id", "payment_sequential", "payment_type", "payment_installments",
            F.floor("payment_value").alias("payment_value")),
        pay.where(k % 3 == 1).select(
            text, F.lit("web").alias("channel"), "payment_type", "order_id", "payment_installments"),
        pay.where(k % 3 == 2).select(
            F.concat(F.lit("R"), "order_id").alias("order_id"), "payment_sequential", "payment_type",
            F.when(F.col("payment_sequential") == 1, F.col("payment_installments")).alias("payment_installments"),
            text, F.lit("shop").alias("channel")),
    ]


def csv_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of three files with differing columns, types inferred, as one table."""
    folder = work_folder(spark, "drift")
    table = EvolvingTable(spark, f"{folder}/table")
    for number, wave in enumerate(_payment_waves(stored_staging(spark, sf_dir).order_payments)):
        file = f"{folder}/arrivals/{number}"
        wave.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(file)
        table.append(read_csv(spark, file).df)
    return table.read(load_as="load")


QUERIES["csv_schema_drift"] = csv_schema_drift
ORACLE_SQL["csv_schema_drift"] = oracle.with_star("""
SELECT CASE WHEN k % 3 = 2 THEN 'R' || order_id ELSE CAST(k AS VARCHAR) END AS order_id,
       CASE WHEN k % 3 <> 1 THEN payment_sequential END AS payment_sequential, payment_type,
       CASE WHEN k % 3 <> 2 OR payment_sequential = 1 THEN CAST(payment_installments AS DOUBLE) END AS payment_installments,
       CASE WHEN k % 3 = 0 THEN floor(payment_value) ELSE payment_value END AS payment_value,
       CASE k % 3 WHEN 1 THEN 'web' WHEN 2 THEN 'shop' END AS channel, CAST(k % 3 AS INTEGER) AS load
FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM stg_order_payments)""")


# -- rejected records (S3) -------------------------------------------------------------


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments from a file in which some records have a field too many, some a word for a
    number and some lack their last field: the rejected records, and the rows staged per reason
    they could have been lost for."""
    folder = work_folder(spark, "csv")
    file = f"{folder}/{FILE_PREFIX}order_payments{FILE_SUFFIX}.csv"
    names = STAGING_SCHEMAS["stg_order_payments"].names
    pay = stored_staging(spark, sf_dir).order_payments
    k, seq = F.col("order_id").cast("bigint"), F.col("payment_sequential")
    value = F.when((k % 7 == 2) & (seq == 1), F.lit("much")).otherwise(
        F.format_string("%.2f", "payment_value"))
    fields = F.concat_ws(",", "order_id", "payment_sequential", F.concat(
        F.lit('"'), "payment_type", F.lit('"')), "payment_installments")
    line = F.when((k % 13 == 5) & (seq == 1), fields).when(
        (k % 11 == 3) & (seq == 1), F.concat_ws(",", fields, value, F.lit('"one, more"'))).otherwise(
            F.concat_ws(",", fields, value))
    # every part file begins with the header: the first row of each task carries it
    begins = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    pay.select(F.when(begins, F.concat(F.lit(",".join(names) + "\n"), line)).otherwise(line)).write.text(file)
    loaded = ingest_csv(spark, file, f"{folder}/staging", schema=STAGING_SCHEMAS["stg_order_payments"],
                        rejects_dir=f"{folder}/rejects")
    staged = spark.read.parquet(loaded.path)
    return read_rejects(spark, loaded.rejects).select(
        "reason", "record", (F.col("file").contains(FILE_SUFFIX) & (F.col("split_length") > 0)).alias("placed"),
        staged.agg(F.count("*")).scalar().alias("staged_rows"),
        staged.agg(F.count_if(F.col("payment_value").isNull())).scalar().alias("short_rows"))


QUERIES["csv_rejects"] = csv_rejects
ORACLE_SQL["csv_rejects"] = oracle.with_star("""
, p AS (
  SELECT *, seq = 1 AND k % 13 = 5 AS short, seq = 1 AND k % 11 = 3 AS long, seq = 1 AND k % 7 = 2 AS word
  FROM (SELECT *, CAST(order_id AS BIGINT) AS k, payment_sequential AS seq FROM stg_order_payments)
)
SELECT CASE WHEN long THEN 'too many fields'
            ELSE 'not a value of the column''s type: payment_value' END AS reason,
       concat_ws(',', order_id, seq, CASE WHEN long THEN '"' || payment_type || '"' ELSE payment_type END,
                 payment_installments,
                 CASE WHEN word THEN 'much' ELSE printf('%.2f', payment_value) END,
                 CASE WHEN long THEN '"one, more"' END) AS record,
       TRUE AS placed,
       (SELECT count(*) FROM p WHERE short OR NOT (long OR word)) AS staged_rows,
       (SELECT count(*) FROM p WHERE short) AS short_rows
FROM p WHERE NOT short AND (long OR word)""".strip())


# -- mergeable distinct counts (A9, K2, K3) ----------------------------------------------

_ERROR = 0.02


def distinct_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders of every month, quarter and year: exact, and whether the estimates
    from the months' stored sketches, which no fact is read for, are within 2 % of that."""
    orders = stored_mart(spark, sf_dir).fact_orders
    tables = VersionedTables(spark, work_folder(spark, "sketches"))
    kept = tables.commit(tables.manifest(), {
        "month_sketches": tables.write("month_sketches", sketches.month_sketches(orders))})
    estimated = sketches.distinct_estimates(tables.read(kept, "month_sketches")).select(
        "window", *[F.col(c).alias(f"estimated_{c}") for c in ("rows", "customers", "orders")])
    near = [(F.abs(F.col(f"estimated_{c}") - F.col(c)) <= _ERROR * F.col(c)).alias(f"{c}_within")
            for c in ("customers", "orders")]
    return sketches.distinct_exact(orders).join(estimated, "window", "left").select(
        "window", "rows", "customers", "orders", *near,
        (F.col("estimated_rows") == F.col("rows")).alias("rows_equal"))


QUERIES["distinct_estimates"] = distinct_estimates
ORACLE_SQL["distinct_estimates"] = oracle.with_star("""
SELECT "window", count(*) AS rows, count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders,
       TRUE AS customers_within, TRUE AS orders_within, TRUE AS rows_equal
FROM (SELECT customer_id, order_id, unnest([
        'month ' || (y * 100 + m), 'quarter ' || y || 'Q' || ((m + 2) // 3), 'year ' || y, 'all']) AS "window"
      FROM (SELECT *, purchase_date_id // 100000000 AS y, purchase_date_id // 1000000 % 100 AS m FROM fact_orders
            WHERE purchase_date_id IS NOT NULL))
GROUP BY 1""")


# -- drift between builds (E3) ------------------------------------------------------------


def distribution_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item fact's profile of a build against three later ones: the same rows in another
    order, prices a third higher, and half of the freight unknown."""
    items = stored_mart(spark, sf_dir).fact_order_items
    columns = ["quantity", "total_price", "total_freight"]
    odd = F.pmod(F.xxhash64("order_id", "product_id"), F.lit(2)) == 1
    builds = {
        "first": items, "same": items.repartition(5, "seller_id"),
        "dearer": items.withColumn("total_price", F.col("total_price") * 4 / 3 + 20000),
        "unknown": items.withColumn("total_freight", F.when(odd, F.col("total_freight")))}
    tables = VersionedTables(spark, work_folder(spark, "profiles"))
    kept = {name: tables.commit(tables.manifest(), {"profile": tables.write(
        "profile", sketches.profile(rows, columns))}) for name, rows in builds.items()}
    out = None
    for name in list(builds)[1:]:
        found = sketches.drift(*(tables.read(kept[n], "profile") for n in ("first", name))).select(
            F.lit(name).alias("build"), "column", "rows", "status")
        out = found if out is None else out.unionByName(found)
    return out


QUERIES["distribution_drift"] = distribution_drift
ORACLE_SQL["distribution_drift"] = oracle.with_star("""
SELECT b AS build, c AS "column", n AS rows,
       CASE WHEN (b = 'dearer' AND c = 'total_price') OR (b = 'unknown' AND c = 'total_freight')
            THEN 'fail' ELSE 'pass' END AS status
FROM (VALUES ('same'), ('dearer'), ('unknown')) AS builds(b),
     (VALUES ('quantity'), ('total_price'), ('total_freight')) AS columns(c),
     (SELECT count(*) AS n FROM fact_order_items)""")


# -- retention (E1) -------------------------------------------------------------------------

QUERIES["retention_grid"] = lambda spark, sf_dir: retention.retention_grid(
    stored_mart(spark, sf_dir).fact_orders)
QUERIES["retention_survival"] = lambda spark, sf_dir: retention.retention_survival(
    stored_mart(spark, sf_dir).fact_orders)

_CUSTOMER_MONTHS = """
, cm AS (
  SELECT DISTINCT customer_id, purchase_date_id // 100000000 * 12 + purchase_date_id // 1000000 % 100 - 1 AS m
  FROM fact_orders WHERE purchase_date_id IS NOT NULL AND customer_id IS NOT NULL
), lives AS (SELECT customer_id, min(m) AS low, max(m) AS high FROM cm GROUP BY customer_id)"""

ORACLE_SQL["retention_grid"] = oracle.with_star(_CUSTOMER_MONTHS.strip() + """
, cells AS (
  SELECT low AS first, m - low AS since, count(*) AS n FROM cm JOIN lives USING (customer_id) GROUP BY ALL
), grid AS (
  SELECT first, unnest(generate_series(0, high - first)) AS since
  FROM (SELECT unnest(generate_series(min(m), max(m))) AS first, max(m) AS high FROM cm)
)
SELECT CAST(first // 12 * 100 + first % 12 + 1 AS INTEGER) AS cohort_month, CAST(since AS INTEGER) AS months_since,
       size, customers, CASE WHEN size > 0 THEN customers / size END AS rate
FROM (SELECT g.first, g.since, coalesce(c.n, 0) AS customers,
             coalesce((SELECT n FROM cells s WHERE s.first = g.first AND s.since = 0), 0) AS size
      FROM grid g LEFT JOIN cells c ON c.first = g.first AND c.since = g.since)""")

_SURVIVAL = _CUSTOMER_MONTHS.strip() + f"""
, ended AS (
  SELECT high - low AS t, count(*) FILTER ((SELECT max(m) FROM cm) - high >= {retention.INACTIVE}) AS d,
         count(*) FILTER ((SELECT max(m) FROM cm) - high < {retention.INACTIVE}) AS c
  FROM lives GROUP BY 1
), steps AS (
  SELECT t, coalesce(d, 0) AS d, coalesce(c, 0) AS c,
         (SELECT count(*) FROM lives WHERE high - low >= t) AS risk
  FROM (SELECT unnest(generate_series(0, max(t))) AS t FROM ended) LEFT JOIN ended USING (t)
), curve AS (
  SELECT t, d, c, risk, CAST({retention.PARTS} AS HUGEINT) * (risk - d) // greatest(risk, 1) AS s FROM steps WHERE t = 0
  UNION ALL
  SELECT x.t, x.d, x.c, x.risk, s * (x.risk - x.d) // greatest(x.risk, 1) FROM curve JOIN steps x ON x.t = curve.t + 1
)
SELECT CAST(t AS INTEGER) AS months_since, risk AS at_risk, d AS left_after, c AS censored,
       CAST(s AS BIGINT) AS survival_parts
FROM curve"""
ORACLE_SQL["retention_survival"] = oracle.with_star(_SURVIVAL).replace("WITH ", "WITH RECURSIVE ", 1)
