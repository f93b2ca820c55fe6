"""Registered queries: each has a Spark plan and an independent SQL statement.

Every query reads the shared test tables through the staging adapter, so its
work grows with them. ``QUERIES[name](spark, sf_dir)`` returns a lazy
DataFrame; ``ORACLE_SQL[name]`` is DuckDB SQL over the same tables with the
same column names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.timekeys import blank_to_null
from martlet.operators import checks, facts
from martlet.plans import oracle, warehouse
from martlet.plans.mart import METRICS, Mart, publish_mart, write_mart
from martlet.plans.store import stored_mart, stored_staging
from martlet.session import ensure_conf, shared_dir
from martlet.sources import testdata
from martlet.sources.ingest import FILE_PREFIX, FILE_SUFFIX, STAGING_PREFIX, ingest_csv, report
from martlet.sources.staging import STAGING_SCHEMAS
from martlet.streaming.incremental import incremental_orders_load

QueryFn = Callable[[SparkSession, str], DataFrame]


def _staging(fn_name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_conf(spark)
        raw = {n: testdata.read_raw(spark, sf_dir, n) for n in testdata.RAW_TABLES}
        builders = {
            "stg_orders": lambda: testdata.stg_orders(raw["orders"]),
            "stg_customers": lambda: testdata.stg_customers(
                raw["orders"], raw["customer"], raw["nation"], raw["region"]),
            "stg_order_items": lambda: testdata.stg_order_items(raw["lineitem"]),
            "stg_order_payments": lambda: testdata.stg_order_payments(raw["orders"]),
            "stg_products": lambda: testdata.stg_products(raw["part"]),
            "stg_sellers": lambda: testdata.stg_sellers(raw["supplier"], raw["nation"], raw["region"]),
            "stg_geolocation": lambda: testdata.stg_geolocation(raw["nation"], raw["region"]),
            "stg_order_reviews": lambda: testdata.stg_order_reviews(raw["orders"]),
        }
        return builders[fn_name]()
    return run


def _mart(fn: Callable[[Mart], DataFrame]) -> QueryFn:
    """Query planned over the stored staging layer (written once per application)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Mart(stored_staging(spark, sf_dir)))
    return run


def _star(fn: Callable[[Mart], DataFrame]) -> QueryFn:
    """Query over the stored star (built once per application and folder)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(stored_mart(spark, sf_dir))
    return run


def _tables(m: Mart) -> dict[str, DataFrame]:
    return {
        "dim_customers": m.dim_customers, "dim_sellers": m.dim_sellers,
        "dim_products": m.dim_products, "dim_date": m.dim_date,
        "fact_orders": m.fact_orders, "fact_order_items": m.fact_order_items,
    }


QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# -- staging (S-level, via the test-data adapter) -----------------------------
for _name in ("stg_orders", "stg_customers", "stg_order_items", "stg_order_payments",
              "stg_products", "stg_sellers", "stg_geolocation", "stg_order_reviews"):
    QUERIES[_name] = _staging(_name)
    ORACLE_SQL[_name] = oracle.table_sql(_name)

# -- the star (M1-M7) ----------------------------------------------------------
for _name in ("dim_customers", "dim_date", "dim_products", "dim_sellers",
              "fact_orders", "fact_order_items", "payment_summary"):
    QUERIES[_name] = _mart(lambda m, _n=_name: m.table(_n))
    ORACLE_SQL[_name] = oracle.table_sql(_name)

# -- data tests (C1-C7) --------------------------------------------------------
QUERIES["check_unique_fact_order_items"] = _star(
    lambda m: checks.duplicate_order_items(m.fact_order_items))
ORACLE_SQL["check_unique_fact_order_items"] = oracle.with_star(oracle.DUPLICATE_ITEMS_SQL)

QUERIES["check_order_process_sequence"] = _star(
    lambda m: checks.order_sequence_violations(m.fact_orders))
ORACLE_SQL["check_order_process_sequence"] = oracle.with_star(oracle.SEQUENCE_SQL)


def _raw_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifecycle test over staged orders that no filter has seen: it has rows."""
    orders = stored_staging(spark, sf_dir).orders.select(
        "order_id", *[blank_to_null(src).alias(dst) for src, dst, _ in facts.ORDER_TIMES])
    return checks.order_sequence_violations(orders)


QUERIES["staged_order_sequence_violations"] = _raw_sequence
ORACLE_SQL["staged_order_sequence_violations"] = oracle.with_star(oracle.RAW_SEQUENCE_SQL)

for _name, _kinds in (("check_not_null", ("not_null",)), ("check_unique_keys", ("unique",)),
                      ("check_relationships", ("relationships",)), ("test_report", None)):
    QUERIES[_name] = _star(lambda m, _k=_kinds: checks.test_report(_tables(m), _k))
    ORACLE_SQL[_name] = oracle.with_star(oracle.report_sql(_kinds))

QUERIES["quality_report"] = lambda spark, sf_dir: checks.quality_report(
    _tables(stored_mart(spark, sf_dir)), stored_staging(spark, sf_dir).orders)
ORACLE_SQL["quality_report"] = oracle.with_star(oracle.QUALITY_SQL)

# -- metrics (K1-K15, E1) -------------------------------------------------------
for _name, _fn in METRICS.items():
    QUERIES[_name] = _star(_fn)
    ORACLE_SQL[_name] = oracle.with_star(oracle.METRICS_SQL[_name])

# -- incremental load (E2): a file stream into staging ------------------------


def _incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    out = f"{shared_dir(spark)}/martlet-incremental/{uuid.uuid4().hex}"
    return incremental_orders_load(spark, sf_dir, out)


QUERIES["incremental_orders_load"] = _incremental_orders
ORACLE_SQL["incremental_orders_load"] = oracle.table_sql("stg_orders")

# -- CSV ingest (S2-S4, S9-S14) over files Spark derives from the tables ------
# The staging table is written as a fully quoted CSV file set, then ingested
# through the CSV reader and the ingest job; the result must equal staging.
_CSV_INGEST = {
    "csv_ingest_geolocation": ("stg_geolocation", False),
    "csv_ingest_order_payments": ("stg_order_payments", True),
    "csv_ingest_sellers": ("stg_sellers", True),
    "csv_ingest_order_reviews": ("stg_order_reviews", True),
}


def _csv_ingest(name: str) -> QueryFn:
    table, declared = _CSV_INGEST[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_conf(spark)
        src = _staging(table)(spark, sf_dir)
        work = f"{shared_dir(spark)}/martlet-csv/{uuid.uuid4().hex}"
        file_dir = f"{work}/{FILE_PREFIX}{table[len(STAGING_PREFIX):]}{FILE_SUFFIX}.csv"
        src.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(file_dir)
        res = ingest_csv(spark, file_dir, f"{work}/staging",
                         schema=STAGING_SCHEMAS[table] if declared else None)
        return spark.read.parquet(res.path)
    return run


for _name, (_table, _) in _CSV_INGEST.items():
    QUERIES[_name] = _csv_ingest(_name)
    ORACLE_SQL[_name] = oracle.table_sql(_table)


# -- unclean files and the reconciliation (S3, S4, S7, S8, S10) ----------------

# The supplier table as somebody else's file: unclean headers, latin-1 bytes.
_UNCLEAN_HEADER = ("Seller ID", "Seller-City", "Note")
_LONG_ROW = "S-long,somewhere,x,one field too many"


def _unclean_file(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Suppliers with accented text as latin-1 CSV, and a part file with a long row."""
    path = f"{folder}/{FILE_PREFIX}unclean_sellers{FILE_SUFFIX}.csv"
    supplier = testdata.read_raw(spark, sf_dir, "supplier")
    sid, cid, note = _UNCLEAN_HEADER
    supplier.select(
        F.concat(F.lit("s"), F.col("s_suppkey")).alias(sid),
        F.concat(F.lit("S\u00e3o "), F.col("s_name")).alias(cid),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("NaN")).otherwise(F.lit('a "b" \\c')).alias(note),
    ).write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    spark.createDataFrame([(",".join(_UNCLEAN_HEADER) + "\n" + _LONG_ROW,)], "line string").write.mode(
        "append").text(path)
    return path


def _ingest_unclean(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    work = f"{shared_dir(spark)}/martlet-csv/{uuid.uuid4().hex}"
    res = ingest_csv(spark, _unclean_file(spark, sf_dir, work), f"{work}/staging")
    return spark.read.parquet(res.path)


QUERIES["csv_ingest_unclean_file"] = _ingest_unclean
ORACLE_SQL["csv_ingest_unclean_file"] = """
SELECT 's' || s_suppkey AS seller_id, 'S\u00e3o ' || s_name AS seller_city,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'a "b" \\c' END AS note
FROM supplier"""


def _ingest_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of one table: a file with a long row, then an empty source, which
    leaves the table as it is."""
    ensure_conf(spark)
    work = f"{shared_dir(spark)}/martlet-csv/{uuid.uuid4().hex}"
    first = ingest_csv(spark, _unclean_file(spark, sf_dir, work), f"{work}/staging")
    empty = f"{work}/empty.csv"
    spark.createDataFrame([(",".join(_UNCLEAN_HEADER),)], "line string").coalesce(1).write.text(empty)
    second = ingest_csv(spark, empty, f"{work}/staging", table=first.table)
    kept = spark.read.parquet(first.path).count()
    return report([first, second], spark).select(
        "table", "written", "source_rows", "target_rows", "dropped_rows", "match",
        F.lit(kept).cast("long").alias("rows_after"))


QUERIES["ingest_reconciliation"] = _ingest_reconciliation
ORACLE_SQL["ingest_reconciliation"] = """
SELECT 'stg_unclean_sellers' AS "table", n > 0 AS written, n AS source_rows, n AS target_rows,
       CAST(1 AS BIGINT) AS dropped_rows, n > 0 AS match, n AS rows_after
FROM (SELECT count(*) AS n FROM supplier)
UNION ALL
SELECT 'stg_unclean_sellers', FALSE, CAST(0 AS BIGINT), NULL, CAST(0 AS BIGINT), FALSE, count(*) FROM supplier"""


# -- rebuilding the mart under stable names (S15, S16) --------------------------


def _mart_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the facts twice and read the second build by the first one's name."""
    staged = stored_staging(spark, sf_dir)
    tag = uuid.uuid4().hex
    out, namespace = f"{shared_dir(spark)}/martlet-rebuild/{tag}", f"marts_{tag[:12]}"
    for _ in range(2):
        names = publish_mart(spark, write_mart(spark, Mart(staged), out, ("fact_orders",
                                                                          "fact_order_items")),
                             namespace)
    return spark.table(names["fact_order_items"]).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"))


QUERIES["mart_rebuild"] = _mart_rebuild
ORACLE_SQL["mart_rebuild"] = oracle.with_star(
    "SELECT order_id, count(*) AS lines FROM fact_order_items GROUP BY order_id")

# -- versions, upserts, maintenance, reconciliation, rejects, drift --------------
QUERIES |= warehouse.QUERIES
ORACLE_SQL |= warehouse.ORACLE_SQL

FLAGSHIP = "fact_orders"
