"""Materialize staging and the star once per application and source folder.

The layers are tables, as in a warehouse: loaders write the staging tables,
the models read staging and write the star, and data tests and metrics read
the star. Here the first request for a layer writes it as parquet under the
session's checkpoint folder (the shared folder the cluster names in
``spark.checkpoint.dir``; see ``session.shared_dir``); later requests in the same application read
the stored files, with column pruning and filter pushdown, instead of
re-planning everything from the raw tables. Writing to durable shared
storage also cuts lineage: a lost executor recomputes a task from the stored
files, not from the raw tables.
"""

from __future__ import annotations

import hashlib
import os
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from martlet.plans.mart import Mart, read_mart, write_mart
from martlet.session import TOGETHER_BYTES, app_id, ensure_conf, fit_tasks, input_bytes, shared_dir
from martlet.sources.sinks import write_table
from martlet.sources.staging import Staging
from martlet.sources.testdata import RAW_TABLES, load_staging, raw_path

_LOCK = threading.Lock()
_STORED: dict[tuple[str, str], Mart] = {}
_STAGED: dict[tuple[str, str], Staging] = {}


def _folder(spark: SparkSession, sf_dir: str, layer: str) -> tuple[tuple[str, str], str]:
    src = os.path.abspath(sf_dir)
    key = (app_id(spark), src)
    tag = hashlib.sha1(src.encode()).hexdigest()[:12]
    return key, f"{shared_dir(spark)}/martlet-{layer}/{key[0]}/{tag}"


def _raw_bytes(spark: SparkSession, sf_dir: str) -> int:
    return input_bytes(spark, *(raw_path(sf_dir, name) for name in RAW_TABLES))


def write_together(spark: SparkSession, sf_dir: str) -> bool:
    """Whether the tables over ``sf_dir`` are small enough to be written at once."""
    return _raw_bytes(spark, sf_dir) <= TOGETHER_BYTES


def write_staging(staging: Staging, out_dir: str, concurrent: bool = True) -> dict[str, str]:
    """Write every staging table; the independent jobs are submitted together
    so that one table's narrow stages do not leave the other cores idle."""
    tables = staging.as_tables()
    paths = {name: f"{out_dir}/staging/{name}" for name in tables}

    def write(name: str) -> None:
        write_table(tables[name], paths[name], skip_empty=False)

    if concurrent:
        with ThreadPoolExecutor(max_workers=min(len(tables), 4)) as pool:
            for f in [pool.submit(write, n) for n in tables]:
                f.result()
    else:
        for n in tables:
            write(n)
    return paths


def read_staging(spark: SparkSession, paths: dict[str, str]) -> Staging:
    r = {name: spark.read.parquet(p) for name, p in paths.items()}
    return Staging(
        customers=r["stg_customers"], orders=r["stg_orders"], order_items=r["stg_order_items"],
        products=r["stg_products"], order_payments=r["stg_order_payments"],
        sellers=r["stg_sellers"], translation=r["stg_product_category_name_translation"],
        geolocation=r.get("stg_geolocation"), order_reviews=r.get("stg_order_reviews"),
    )


def stored_staging(spark: SparkSession, sf_dir: str) -> Staging:
    """The staging layer over ``sf_dir``, written on first use in this application."""
    ensure_conf(spark)
    key, out = _folder(spark, sf_dir, "staging")
    with _LOCK:
        staged = _STAGED.get(key)
        if staged is None:
            fit_tasks(spark, _raw_bytes(spark, sf_dir))
            paths = write_staging(load_staging(spark, sf_dir, extras=True), out,
                                  concurrent=write_together(spark, sf_dir))
            staged = _STAGED[key] = read_staging(spark, paths)
    return staged


def stored_mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The star over ``sf_dir``, built and written on first use in this application."""
    staging = stored_staging(spark, sf_dir)
    key, out = _folder(spark, sf_dir, "star")
    with _LOCK:
        star = _STORED.get(key)
        if star is None:
            star = _STORED[key] = read_mart(spark, write_mart(
                spark, Mart(staging), out, concurrent=write_together(spark, sf_dir)))
    return star


def forget(spark: SparkSession | None = None) -> None:
    """Drop the registry (files stay; a new build writes a new folder)."""
    with _LOCK:
        for reg in (_STORED, _STAGED):
            for k in [k for k in reg if spark is None or k[0] == app_id(spark)]:
                del reg[k]
