"""Benchmark: build each mart table, write the star, run tests and metrics.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Four phases, all timed:

* ``staging_write``: the staging layer derived from the shared test tables
  and written as parquet (the loaders' job);
* each of the six star tables planned over stored staging and executed in
  full into Spark's ``noop`` sink;
* ``star_write``: the production job writing all six tables as parquet
  (the order fact once, read back for the item fact);
* the data-test report and headline metrics over the stored star.

One warm-up pass runs first so JIT and class loading are not billed to the
first query; each query is then timed ``BENCH_REPEAT`` times (default 3) and
the median is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martlet.plans import catalog  # noqa: E402
from martlet.plans.mart import Mart, write_mart  # noqa: E402
from martlet.plans.store import stored_staging, write_staging  # noqa: E402
from martlet.sources.testdata import load_staging  # noqa: E402
from martlet.session import local_session, shared_dir  # noqa: E402

HEADLINE = (
    "staging_write", "dim_customers", "dim_date", "dim_products", "dim_sellers",
    "fact_orders", "fact_order_items", "star_write",
    "test_report", "sales_overview", "monthly_revenue_growth", "top_cities",
    "top_products_by_revenue", "customer_cohorts",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    if name == "staging_write":
        write_staging(load_staging(spark, sf_dir, extras=True),
                      f"{shared_dir(spark)}/bench-staging-{uuid.uuid4().hex}")
    elif name == "star_write":
        out = f"{shared_dir(spark)}/bench-star-{uuid.uuid4().hex}"
        write_mart(spark, Mart(stored_staging(spark, sf_dir)), out)
    else:
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(
        cpus, shuffle_partitions=max(cpus * 2, 8), app="martlet-bench",
        extra={"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"},
    )
    names = [n for n in HEADLINE if n in catalog.QUERIES or n.endswith("_write")]
    for n in names:  # warm-up
        run_once(spark, n, sf_dir)
    times = {}
    for n in names:
        times[n] = round(statistics.median(run_once(spark, n, sf_dir) for _ in range(repeat)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({
        "metric": "mart_build_and_report_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_val,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
