"""What keeps a task's share, and the bytes moved, in proportion to the input."""

import os

from martlet.session import fit_tasks
from martlet.sources.sinks import write_table
from martlet.sources.testdata import read_raw


def test_large_tables_are_dealt_out_by_key_without_a_sort(spark, tmp_dir):
    spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "b")], "o_orderkey long, v string").write.parquet(
        f"{tmp_dir}/orders.parquet")
    rows = read_raw(spark, tmp_dir, "orders")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(o_orderkey" in plan and "RoundRobin" not in plan
    assert sorted(map(str, rows.collect())) == sorted(map(str, spark.read.parquet(f"{tmp_dir}/orders.parquet").collect()))


def test_partitions_are_raised_with_the_input_only(spark):
    name, split = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    before, was = spark.conf.get(name, None), spark.conf.get(split)
    try:
        spark.conf.unset(name)
        fit_tasks(spark, 1 << 20)
        assert spark.conf.get(name, None) is None
        fit_tasks(spark, 6 << 30)
        assert int(spark.conf.get(name)) == 1536 and spark.conf.get(split) == str(16 << 20)
        fit_tasks(spark, 1 << 30)
        assert int(spark.conf.get(name)) == 1536
    finally:
        spark.conf.set(split, was)
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_tables_are_packed(spark, tmp_dir):
    write_table(spark.range(3).toDF("k"), f"{tmp_dir}/t")
    assert any(".zstd." in f for f in os.listdir(f"{tmp_dir}/t"))
