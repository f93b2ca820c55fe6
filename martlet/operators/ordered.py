"""Running totals in a global order without funnelling rows into one task.

``sum(x) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING)`` with no partition key
makes Spark move every row to a single task. ``running_total`` computes the
same exact result in parallel:

1. range-partition the rows on the full, tie-free order key (a hot value of
   the leading key is split across partitions by the later keys) and tag each
   row with its partition;
2. write the rows to the shared folder, so that the partition each row landed
   in is fixed even if an executor is lost and work is redone;
3. total ``x`` per partition -- one small row per partition -- and turn those
   into exclusive offsets with a window over the partition totals, whose size
   is the partition count, not the data;
4. add each partition's offset to a running sum computed inside the partition.

Sums are DECIMAL or integral, so the result does not depend on how rows are
split. NULL values add nothing; the total is NULL only where no value up to
that row is present, as in SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.session import app_id, shared_dir

_PID = "_range_part"


def running_total(df: DataFrame, order: list[Column], value: str, out: str,
                  num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``out`` = sum of ``value`` over all rows up to this one in ``order``.

    ``order`` must be a total order (end it with a unique key); ``value``
    should be DECIMAL or integral for an exact result. The range partitions are
    the session's shuffle partitions unless ``num_partitions`` says otherwise.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(spark)}/martlet-ordered/{app_id(spark)}/{uuid.uuid4().hex}"
    ranged = df.repartitionByRange(n, *order).withColumn(_PID, F.spark_partition_id())
    ranged.write.parquet(path)
    tagged = spark.read.schema(ranged.schema).parquet(path)
    totals = tagged.groupBy(_PID).agg(F.sum(value).alias("_part_total"))
    offsets = totals.select(
        _PID,
        F.sum("_part_total").over(
            Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)).alias("_offset"),
    )
    w = Window.partitionBy(_PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.withColumn("_local", F.sum(value).over(w))
    # offsets has one row per range partition (bounded by n): broadcast it
    joined = local.join(F.broadcast(offsets), _PID)
    both = F.coalesce(F.col("_offset") + F.col("_local"), "_offset", "_local")
    return joined.withColumn(out, both).drop(
        _PID, "_local", "_offset")
