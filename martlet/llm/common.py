"""Helpers shared by the operators of this subpackage.

*Staged tables.* Iterative operators cut lineage by writing a table to the
shared folder the cluster names in ``spark.checkpoint.dir`` and reading it
back, so a lost executor costs a task of the current round and not the whole
history. ``Stage`` keeps track of the tables of one operator call; tables that
no later plan reads are released, and the shuffle files behind a table go once it
is written, not when the driver's garbage collector next meets them.

*Fixed hash folds.* Contracts define held-out rows by ``crc32`` of the id as
text, ``fold`` spells that once.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlet.session import CLEANUP, app_id, shared_dir

# Rows of an Arrow batch handed to Python: bounds a batch of very long texts.
ARROW_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """What the operators rely on: short Arrow batches, and Python workers that
    find this package where it lies on the driver (on a cluster that does not
    share that folder, ship it with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


class Stage:
    """Tables one operator call writes to the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/martlet-llm/{app_id(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0
        self._paths: dict[int, str] = {}
        self._keep: list[DataFrame] = []

    def write(self, df: DataFrame, what: str) -> DataFrame:
        """``df`` written as Parquet and read back."""
        path = f"{self.root}/{self._count:03d}-{what}"
        self._count += 1
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:  # the caller's own queries keep theirs
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = path
        self._keep.append(back)
        return back

    def release_all_but(self, *tables: DataFrame) -> None:
        """Delete every staged table but these."""
        kept = {id(t) for t in tables}
        self.release(*[t for t in self._keep if id(t) not in kept])

    def release(self, *tables: DataFrame) -> None:
        """Delete staged tables that no plan reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = self._paths.pop(id(table), None)
            if path is not None:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % F.lit(parts)).cast("int")


def first_by_hash(rows: DataFrame, key: str, most: int, count: int) -> DataFrame:
    """The ``most`` rows (of ``count``, about) that come first in the order of a hash of
    ``key``. A threshold on the hash lets only little more than ``most`` reach the sort,
    however many tasks read the rows."""
    steps = 1 << 30
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(steps)), F.lit(steps))
    share = (most + 8 * most**0.5 + 64) / max(1, count)
    return rows.where(draw < int(min(1.0, share) * steps)).orderBy(draw, key).limit(most)


def whole_text(col: Column) -> Column:
    """The text, empty where null."""
    return F.coalesce(col.cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extended(schema: StructType, ddl: str) -> StructType:
    """``schema`` with the fields of a DDL text behind it."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])
