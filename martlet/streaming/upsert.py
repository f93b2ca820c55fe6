"""Upserts: changed and deleted rows reach a loaded table, bucket by bucket.

The target is a versioned table whose parts are buckets of the key's hash. ``merge`` takes a
batch of changes, reads only the buckets that hold a key of the batch, keeps of every key
the newest row by event time, and writes those buckets anew (copy on write); the manifest
then switches them all at once. Other buckets are neither read nor written.

* The newest event time wins, whatever order changes arrive in; at equal times a deletion
  wins over a row, then the greater row, column by column (NULL least).
* A deletion stays in its bucket as a mark with its time, so that a change that happened
  before it and arrives after it does not bring the row back; ``rows`` leaves marks out.
* Merging a batch again changes nothing. The stream's batch number is stored with the
  version, so a batch that was committed before a failure is skipped, not merged again.
* NULL key parts equal one another. A change without an event time loses to any with one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.sources.versioned import Conflict, Manifest, TableVersion, VersionedTables

TIME, DELETED = "_changed_at", "_deleted"


class UpsertTable:
    """The table ``name`` of the set under ``root``, keyed by ``keys``, in ``buckets`` parts.

    The number of buckets is stored with the first version and stays; later callers use it.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, keys: list[str], buckets: int = 64):
        self.tables, self.name, self.keys = VersionedTables(spark, root), name, list(keys)
        self._buckets = buckets

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("string")

    def rows(self, version: int | None = None) -> DataFrame:
        """The table's rows in one version (the newest by default)."""
        manifest = self.tables.manifest(version)
        return self.tables.read(manifest, self.name).where(~F.col(DELETED)).drop(TIME, DELETED)

    def merge(self, changes: DataFrame, time: Column, deleted: Column | None = None, *,
              batch: tuple[str, int] | None = None, attempts: int = 3) -> Manifest:
        """Apply ``changes`` (the table's columns, and any that ``time`` and ``deleted`` need).

        ``batch``: (stream, number), skipped if the table has seen that number or a later one.
        A merge that loses a race starts again from the version that won."""
        columns = self._columns(changes, time, deleted)
        marked = changes.select(
            *columns, time.cast("timestamp").alias(TIME),
            F.coalesce(F.lit(False) if deleted is None else deleted, F.lit(False)).alias(DELETED))
        for left in reversed(range(attempts)):
            try:
                return self._merge(marked, batch)
            except Conflict:
                if not left:
                    raise

    def _columns(self, changes: DataFrame, time: Column, deleted: Column | None) -> list[str]:
        """The table's columns: those it has, or for a new table all but the marks."""
        held = self.tables.manifest().tables.get(self.name)
        if held:
            return [f.name for f in held.schema.fields if f.name not in (TIME, DELETED)]
        return [c for c in changes.columns if c not in (TIME, DELETED)]

    def _merge(self, marked: DataFrame, batch: tuple[str, int] | None) -> Manifest:
        base = self.tables.manifest()
        seen = dict(base.info.get("batches", {}))
        if batch and seen.get(batch[0], -1) >= batch[1]:
            return base
        buckets = base.info.get("buckets", self._buckets)
        # at most one row a bucket reaches the driver
        touched = [r[0] for r in marked.select(self._bucket(buckets)).distinct().collect()]
        held = base.tables.get(self.name)
        both = marked
        if held:
            both = self.tables.read(base, self.name, touched).unionByName(marked)
        rest = [c for c in marked.columns if c not in (*self.keys, TIME, DELETED)]
        newest = both.groupBy(*self.keys).agg(
            F.max(F.struct(TIME, DELETED, *rest)).alias("_newest")).select(
                *self.keys, *[F.col(f"_newest.{c}").alias(c) for c in (*rest, TIME, DELETED)])
        new = {}
        if touched:
            new[self.name] = self.tables.write(self.name, newest.select(marked.columns),
                                               self._bucket(buckets))
        elif not held:
            new[self.name] = TableVersion(marked.schema, {})
        if batch:
            seen[batch[0]] = batch[1]
        return self.tables.commit(base, new, {self.name: touched}, kind="merge", buckets=buckets,
                                  batches=seen)


def incremental_upsert(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    target: UpsertTable,
    time: Column,
    checkpoint_path: str,
    *,
    deleted: Column | None = None,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    options: dict[str, str] | None = None,
) -> list[int]:
    """Merge the change files that are new under ``source_path``; the versions committed.

    ``transform`` shapes a batch; ``time`` and ``deleted`` are over its result."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    committed: list[int] = []

    def apply(batch: DataFrame, number: int) -> None:
        shaped = transform(batch) if transform else batch
        committed.append(target.merge(shaped, time, deleted, batch=(checkpoint_path, number)).version)

    reader.load(source_path).writeStream.foreachBatch(apply).option(
        "checkpointLocation", checkpoint_path).trigger(availableNow=True).start().awaitTermination()
    return committed
