"""Table writes: full refresh, the empty-source guard, and row-count reconciliation.

* Full refresh (create-or-replace) is ``mode("overwrite")``; executors write
  their partitions in parallel and the driver only commits.
* An empty source is not written at all, so the previous table survives
  (the check reads at most one row).
* Never overwrite a path that the same plan reads: Spark refuses it, and a
  retried task could otherwise read half-replaced files.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.session import shuffles_removed

log = logging.getLogger(__name__)

# Namespace the mart tables land in (the custom schema name, used verbatim).
MART_NAMESPACE = "marts"

# How tables are packed: keys and times staged as text shrink well.
PACKED = {"compression": "zstd"}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", *,
                partition_by: list[str] | None = None, skip_empty: bool = True) -> bool:
    """Replace the table at ``path`` with ``df``; keep the old one if ``df`` is empty.

    Returns whether a write happened.
    """
    with shuffles_removed(df.sparkSession):
        if skip_empty and df.isEmpty():
            log.warning("source for %s is empty; keeping the existing table", path)
            return False
        writer = df.write.mode("overwrite").format(fmt).options(**(PACKED if fmt == "parquet" else {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(path)
    return True


def publish(spark: SparkSession, name: str, path: str, namespace: str = MART_NAMESPACE) -> str:
    """Let the catalog table ``namespace.name`` stand for the finished files at ``path``.

    The table keeps its name over rebuilds: its location is switched once the
    new version is complete, so a failed build leaves the old version in place
    and a reader sees one version or the other. Returns the qualified name.
    """
    table = f"{namespace}.{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    schema = spark.read.parquet(path).schema
    if spark.catalog.tableExists(table) and spark.table(table).schema != schema:
        spark.sql(f"DROP TABLE {table}")  # external: its files stay
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=schema)
    return table


def drop_files(spark: SparkSession, path: str) -> None:
    """Remove a folder through Hadoop's file systems (wherever it is stored)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, in order; none if it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) \
        if fs.exists(p) else []


def has_parquet(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder with anything but the marks of a writer in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and any(
        not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def reconcile(spark: SparkSession, pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(table, source_rows, target_rows, match) for each (source, target) pair.

    Each count is a distributed aggregate; only one row per table reaches the
    driver when the result is shown.
    """
    rows = []
    for name, (src, tgt) in pairs.items():
        s = row_count(src).select(F.col("rows").alias("source_rows"))
        t = row_count(tgt).select(F.col("rows").alias("target_rows"))
        rows.append(s.select(
            F.lit(name).alias("table"), "source_rows", t.select("target_rows").scalar().alias("target_rows"),
        ))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("match", F.col("source_rows") == F.col("target_rows"))
