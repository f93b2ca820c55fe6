"""Build the star, run the data tests and write the dashboard metrics.

    spark-submit martlet/plans/build.py --staging-dir s3://.../staging --out s3://.../warehouse
    python -m martlet.plans.build --sf-dir /root/testdata/sf0.01 --out /tmp/run-x

Input is either a folder of staging tables (parquet, one sub-folder per
``stg_*`` table, as the ingest jobs write them) or, for the shared test
tables, ``--sf-dir`` (the staging adapter). Output under ``--out``:
``marts/<table>/<version>`` (the star, registered as ``marts.<table>``),
``tests/report`` and ``metrics/<name>``. The exit status is non-zero when a data test fails
and ``--fail-on-test-error`` is given.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from martlet.operators import checks
from martlet.plans.mart import MART_TABLES, METRICS, Mart, publish_mart, read_mart, write_mart
from martlet.session import ensure_conf, input_bytes, size_session
from martlet.sources.sinks import MART_NAMESPACE, write_table
from martlet.sources.staging import Staging
from martlet.sources.testdata import load_staging

# The dashboard tables written by a build.
DASHBOARD = (
    "sales_overview", "monthly_revenue_growth", "top_cities", "top_categories",
    "segments_by_state", "segments_by_city", "top_products_by_revenue",
    "top_products_by_quantity", "top_sellers_by_revenue", "top_sellers_by_quantity",
    "high_performers", "product_pareto", "sales_by_quantity", "customer_cohorts",
)


def staging_from_dir(spark: SparkSession, staging_dir: str) -> Staging:
    def t(name: str):
        return spark.read.parquet(f"{staging_dir.rstrip('/')}/{name}")
    return Staging(
        customers=t("stg_customers"), orders=t("stg_orders"), order_items=t("stg_order_items"),
        products=t("stg_products"), order_payments=t("stg_order_payments"),
        sellers=t("stg_sellers"), translation=t("stg_product_category_name_translation"),
    )


def build(spark: SparkSession, staging: Staging, out: str, *,
          namespace: str = MART_NAMESPACE) -> dict:
    """Write the star, the test report and the dashboard tables; return a summary.

    The star is written as a new version and only then published under the
    stable names ``namespace.<table>``.
    """
    ensure_conf(spark)
    out = out.rstrip("/")
    paths = write_mart(spark, Mart(staging), out)
    names = publish_mart(spark, paths, namespace)
    star = read_mart(spark, paths)
    tables = {name: star.table(name) for name in MART_TABLES}
    report_path = f"{out}/tests/report"
    write_table(checks.test_report(tables), report_path, skip_empty=False)
    report = spark.read.parquet(report_path)
    failed = [r.test_name for r in report.where("status = 'fail'").select("test_name").collect()]
    for name in DASHBOARD:
        write_table(METRICS[name](star), f"{out}/metrics/{name}", skip_empty=False)
    return {"marts": paths, "tables": names, "tests": report_path,
            "failed_tests": sorted(failed), "metrics": sorted(DASHBOARD)}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--staging-dir")
    src.add_argument("--sf-dir")
    ap.add_argument("--out", required=True)
    ap.add_argument("--namespace", default=MART_NAMESPACE)
    ap.add_argument("--fail-on-test-error", action="store_true")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("martlet-build").getOrCreate()
    ensure_conf(spark)
    size_session(spark, input_bytes(spark, args.staging_dir or args.sf_dir))
    staging = (staging_from_dir(spark, args.staging_dir) if args.staging_dir
               else load_staging(spark, args.sf_dir))
    summary = build(spark, staging, args.out, namespace=args.namespace)
    print(json.dumps(summary))
    return 1 if (args.fail_on_test_error and summary["failed_tests"]) else 0


if __name__ == "__main__":
    sys.exit(main())
