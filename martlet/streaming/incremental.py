"""Incremental loading with Structured Streaming.

New source files are picked up by a file stream; the stream's own checkpoint
records which files were processed, so each file is loaded once even across
restarts. ``trigger(availableNow=True)`` processes everything that is there
and stops -- a batch job that only reads new files -- and the same code runs
continuously with a processing-time trigger.

Each micro-batch is applied with ``foreachBatch``. A key is written once: of
several rows with one key in a batch the least in column order wins, and rows
whose key is already in the target are skipped. NULL key parts equal one
another, so a NULL key is written once, too. Re-running a batch after a failure
therefore appends nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.sources.sinks import has_parquet


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The target, or None where nothing was written yet; any other failure is raised."""
    return spark.read.parquet(path) if has_parquet(spark, path) else None


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def one_row_per_key(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows with equal keys the least, compared column by column (NULL first).

    A minimum combines map-side, so a key that fills a batch costs a row a task.
    """
    return batch.groupBy(*keys).agg(F.min(F.struct(*batch.columns)).alias("row")).select("row.*")


def append_new_keys(batch: DataFrame, target_path: str, keys: list[str]) -> int:
    """Append the rows of ``batch`` whose key is not yet in the target; return their count.

    The target can be far larger than a batch, so its keys are first reduced to
    those present in the batch by a semi-join; only that remainder meets the
    batch in the anti-join.
    """
    spark = batch.sparkSession
    new = one_row_per_key(batch, keys)
    current = _existing(spark, target_path)
    if current is not None:
        held = current.select(*keys)
        asked = batch.select(*keys).distinct()
        seen = held.join(asked, _same_keys(held, asked, keys), "left_semi").distinct()
        new = new.join(seen, _same_keys(new, seen, keys), "left_anti")
    new = new.persist()
    try:
        n = new.count()
        if n:
            new.write.mode("append").parquet(target_path)
        return n
    finally:
        new.unpersist()


def source_of(spark: SparkSession, path: str) -> tuple[str, dict[str, str]]:
    """(folder, reader options) of a file stream over ``path``: a folder of part
    files, however deep, or a single file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isDirectory():
        return path, {"recursiveFileLookup": "true"}
    return p.getParent().toString(), {"pathGlobFilter": p.getName()}


def incremental_load(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    target_path: str,
    keys: list[str],
    checkpoint_path: str,
    *,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> list[int]:
    """Load new files under ``source_path`` into the parquet table at ``target_path``.

    Runs until the files present at start are processed; returns the number
    of rows appended per micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_path)
    if transform is not None:
        stream = transform(stream)
    appended: list[int] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        appended.append(append_new_keys(batch, target_path, keys))

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return appended


def incremental_orders_load(spark: SparkSession, sf_dir: str, out_dir: str) -> DataFrame:
    """The orders table, arriving in two waves, streamed through the staging
    adapter into a fresh staging table under ``out_dir``; the loaded table.

    The first wave are the finished orders, the second is the whole table: it
    sends the first wave's keys again.
    """
    from martlet.sources.testdata import stg_orders

    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    arrivals, target = f"{out_dir}/arrivals", f"{out_dir}/stg_orders"
    for wave, rows in enumerate((orders.where("o_orderstatus = 'F'"), orders)):
        rows.write.parquet(f"{arrivals}/wave={wave}")
        folder, options = source_of(spark, arrivals)
        incremental_load(spark, folder, orders.schema, target, ["order_id"],
                         f"{out_dir}/_checkpoint", transform=stg_orders, options=options)
    return spark.read.parquet(target)
