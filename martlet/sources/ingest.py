"""Ingest jobs: source -> clean -> staging table -> row-count reconciliation.

One job per source table; each is an independent Spark job (submit them from
separate threads or separate applications to run several at once). A source
that turns out empty is not written, so the previous staging table survives.
"""

from __future__ import annotations

import logging
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlet.session import ensure_conf, input_bytes, size_session
from martlet.sources.csv import land, read_csv, shaped
from martlet.sources.jdbc import JdbcSource, read_jdbc
from martlet.sources.reconcile import ROWS, digest, digest_columns, digest_of
from martlet.sources.sinks import drop_files, row_count, subfolders, write_table

log = logging.getLogger(__name__)

# File-name parts removed when naming a staging table, and the
# staging prefix.
FILE_PREFIX = "olist_"
FILE_SUFFIX = "_dataset"
STAGING_PREFIX = "stg_"

# The relational tables and the CSV-sourced tables that make up
# staging.
RELATIONAL_TABLES = ("customers", "orders", "order_items", "products")
CSV_TABLES = (
    "geolocation", "order_payments", "order_reviews", "sellers",
    "product_category_name_translation",
)


# Column, lower and upper bound, and number of connections of a parallel read.
JdbcPartitions = tuple[str, int, int, int]


def staging_name_for_file(file_name: str) -> str:
    base = os.path.basename(file_name)
    if base.endswith(".csv"):
        base = base[: -len(".csv")]
    base = base.replace(FILE_PREFIX, "").replace(FILE_SUFFIX, "")
    return STAGING_PREFIX + base


def staging_name_for_table(table: str) -> str:
    return STAGING_PREFIX + table


@dataclass
class IngestResult:
    table: str
    path: str
    written: bool
    source_rows: int
    target_rows: int | None
    dropped_rows: int = 0
    encoding: str | None = None
    source_content: dict[str, tuple] | None = None  # digests, where asked for
    target_content: dict[str, tuple] | None = None
    rejects: str | None = None  # folder of the rejected records, where kept

    @property
    def match(self) -> bool:
        """Row counts agree and, where content was digested, so does every column and row."""
        return (self.written and self.source_rows == self.target_rows
                and self.source_content == self.target_content)


def _load(spark: SparkSession, df: DataFrame, counts: Observation, name: str, out_dir: str,
          probe: DataFrame, encoding: str | None = None, content: bool = False) -> IngestResult:
    """Empty guard, full-refresh write, then row counts of source and target.

    The guard reads one row of ``probe``. The source is read once more, by the
    write, which counts its rows into ``counts`` on the way, so both figures
    belong to one snapshot of it; the target's count reads Parquet footers. With
    ``content`` the same write also digests what it writes, and the target is read
    back once and digested, too.
    """
    path = f"{out_dir.rstrip('/')}/{name}"
    if probe.isEmpty():
        log.warning("%s: source is empty; keeping the existing table", name)
        return IngestResult(name, path, False, 0, None, 0, encoding)
    digested = Observation()
    write_table(df.observe(digested, *digest_columns(df.columns)) if content else df, path,
                skip_empty=False)
    source_rows = counts.get["source_rows"]
    dropped = counts.get.get("dropped_rows", 0)
    if dropped:
        log.warning("%s: skipped %d rows with too many fields", name, dropped)
    source = target = None
    if content:
        source, target = digest_of(digested.get, df.columns), digest(spark.read.parquet(path))
        target_rows = target[ROWS][0]
    else:
        target_rows = row_count(spark.read.parquet(path)).first()["rows"]
    log.info("%s: %d source rows, %d staged rows", name, source_rows, target_rows)
    return IngestResult(name, path, True, source_rows, target_rows, dropped, encoding, source, target)


def ingest_csv(spark: SparkSession, csv_path: str, out_dir: str, *, encoding: str = "auto",
               table: str | None = None, schema=None, multi_line: bool = True,
               content: bool = False, rejects_dir: str | None = None) -> IngestResult:
    """Load a CSV file into staging.

    ``content``: reconcile by content, too. ``rejects_dir``: keep rejected records there
    (``read_rejects``); with a declared schema, records with a value that is not of its
    column's type are then rejected, where otherwise the load fails.
    """
    name = table or staging_name_for_file(csv_path)
    if rejects_dir:
        return _ingest_with_rejects(spark, csv_path, out_dir, name, rejects_dir, content=content,
                                    schema=schema, encoding=encoding, multi_line=multi_line)
    read = read_csv(spark, csv_path, encoding=encoding, schema=schema, multi_line=multi_line)
    counts = Observation()
    return _load(spark, read.observed(counts), counts, name, out_dir, read.df, read.encoding, content)


def _ingest_with_rejects(spark: SparkSession, csv_path: str, out_dir: str, name: str, rejects_dir: str,
                         *, content: bool, schema, encoding: str, multi_line: bool) -> IngestResult:
    """The file is parsed once, into a landing folder that holds kept and rejected records
    apart; types are inferred and staging is written from the kept ones there. The kept
    half is removed after the load, the rejected half is the reject store."""
    landed, names, encoding = land(spark, csv_path, schema=schema, encoding=encoding,
                                   multi_line=multi_line)
    folder = f"{rejects_dir.rstrip('/')}/{name}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    counts = Observation()
    landed.observe(counts, F.count_if("_kept").alias("source_rows"),
                   F.count_if(~F.col("_kept")).alias("dropped_rows")).write.partitionBy("_kept").parquet(folder)
    text = landed.drop("_kept", "_reject").schema
    kept = spark.read.schema(text).parquet(f"{folder}/_kept=true") \
        if "_kept=true" in subfolders(spark, folder) else spark.createDataFrame([], text)
    df = shaped(kept, names, schema)
    result = _load(spark, df, counts, name, out_dir, kept, encoding, content)
    result.dropped_rows, result.rejects = counts.get["dropped_rows"], folder
    drop_files(spark, f"{folder}/_kept=true")
    return result


_REJECT = ("struct<reason: string, record: string, file: string, split_start: long, "
           "split_length: long, number: long>")


def read_rejects(spark: SparkSession, *folders: str) -> DataFrame:
    """The rejected records of loads (``IngestResult.rejects``), in the order of their place."""
    halves = [f"{f}/_kept=false" for f in folders if "_kept=false" in subfolders(spark, f)]
    schema = f"_reject {_REJECT}"
    rows = spark.read.schema(schema).parquet(*halves) if halves else spark.createDataFrame([], schema)
    return rows.select("_reject.*").orderBy("file", "split_start", "number")


def ingest_jdbc(spark: SparkSession, source: JdbcSource, out_dir: str,
                table: str | None = None, content: bool = False) -> IngestResult:
    df = read_jdbc(spark, source)
    counts = Observation()
    return _load(spark, df.observe(counts, F.count(F.lit(1)).alias("source_rows")), counts,
                 table or staging_name_for_table(source.table), out_dir, df, content=content)


def report(results: list[IngestResult], spark: SparkSession) -> DataFrame:
    """The reconciliation as a small DataFrame (one row per table)."""
    rows = [(r.table, r.path, r.written, r.source_rows, r.target_rows, r.dropped_rows, r.match)
            for r in results]
    schema = ("table string, path string, written boolean, source_rows long, "
              "target_rows long, dropped_rows long, match boolean")
    return spark.createDataFrame(rows, schema).withColumn("checked_at", F.current_timestamp())


def csv_file_name(table: str) -> str:
    """File name of a CSV-sourced table in the source folder."""
    if table == "product_category_name_translation":
        return f"{table}.csv"
    return f"{FILE_PREFIX}{table}{FILE_SUFFIX}.csv"


def ingest_all(spark: SparkSession, out_dir: str, *, csv_dir: str | None = None,
               jdbc_url: str | None = None, jdbc_properties: dict[str, str] | None = None,
               jdbc_partitions: dict[str, JdbcPartitions] | None = None,
               single_line: tuple[str, ...] = (), max_parallel: int = 4) -> list[IngestResult]:
    """Load every staging table: the relational tables over JDBC and the CSV
    files, each as its own Spark job, several at a time.

    ``jdbc_partitions``: how a relational table is split over connections.
    ``single_line``: CSV tables without line breaks in fields, whose files Spark
    may split over tasks.
    """
    jobs = []
    if csv_dir:
        for t in CSV_TABLES:
            path = f"{csv_dir.rstrip('/')}/{csv_file_name(t)}"
            jobs.append(lambda p=path, m=t not in single_line: ingest_csv(
                spark, p, out_dir, multi_line=m))
    if jdbc_url:
        for t in RELATIONAL_TABLES:
            src = JdbcSource(jdbc_url, t, dict(jdbc_properties or {}),
                             *(jdbc_partitions or {}).get(t, ()))
            jobs.append(lambda s=src: ingest_jdbc(spark, s, out_dir))
    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def parse_partitions(text: str) -> tuple[str, JdbcPartitions]:
    """``table:column:lower:upper:count`` of the command line."""
    table, column, lower, upper, count = text.split(":")
    if table not in RELATIONAL_TABLES:
        raise ValueError(f"unknown relational table {table}")
    return table, (column, int(lower), int(upper), int(count))


def main(argv: list[str] | None = None) -> int:
    import argparse
    import json

    ap = argparse.ArgumentParser(description="Load the staging tables.")
    ap.add_argument("--out", required=True)
    ap.add_argument("--csv-dir")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    ap.add_argument("--jdbc-partitions", action="append", default=[], type=parse_partitions,
                    metavar="TABLE:COLUMN:LOWER:UPPER:COUNT", help="read a table over COUNT connections")
    ap.add_argument("--single-line", nargs="*", default=(), choices=CSV_TABLES, metavar="TABLE",
                    help="CSV tables whose fields hold no line breaks (their files are split)")
    args = ap.parse_args(argv)
    props = {}
    if args.jdbc_user:
        props["user"] = args.jdbc_user
    if args.jdbc_password_env:
        props["password"] = os.environ[args.jdbc_password_env]
    spark = ensure_conf(SparkSession.builder.appName("martlet-ingest").getOrCreate())
    if args.csv_dir:
        size_session(spark, input_bytes(spark, args.csv_dir))
    results = ingest_all(spark, args.out, csv_dir=args.csv_dir, jdbc_url=args.jdbc_url,
                         jdbc_properties=props, jdbc_partitions=dict(args.jdbc_partitions),
                         single_line=tuple(args.single_line))
    print(json.dumps([{"table": r.table, "written": r.written, "source_rows": r.source_rows,
                       "target_rows": r.target_rows, "dropped_rows": r.dropped_rows,
                       "match": r.match} for r in results]))
    return 0 if all(r.match or not r.written for r in results) else 1


if __name__ == "__main__":
    import sys
    sys.exit(main())
