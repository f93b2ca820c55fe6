"""What finished jobs leave on disk: no shuffle files, and few of them at once."""

import glob
import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial

from pyspark.sql import functions as F

from martlet.plans import mart, store
from martlet.plans.star_versions import StarVersions, _at_once, staging_changes
from martlet.session import CLEANUP, shuffles_removed
from martlet.sources.sinks import write_table
from tests.fixtures import item, order, payment, staging


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirs() for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def left_over(spark, before):
    """Shuffle files that came after ``before`` and stay (they are removed in the background)."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return new


def counted(spark):
    return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_dir):
    before = shuffle_files(spark)
    write_table(counted(spark), f"{tmp_dir}/t", skip_empty=False)
    assert left_over(spark, before) == set()
    assert spark.read.parquet(f"{tmp_dir}/t").agg(F.sum("n")).first()[0] == 1000


def test_the_callers_own_setting_comes_back(spark):
    was = spark.conf.get(CLEANUP, None)
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            pass
        assert spark.conf.get(CLEANUP) == "true"

    def block(_):
        with shuffles_removed(spark):
            time.sleep(0.05)
            return spark.conf.get(CLEANUP)

    with ThreadPoolExecutor(4) as pool:
        assert set(pool.map(block, range(8))) == {"true"}
    assert spark.conf.get(CLEANUP, None) == was


def test_a_query_of_the_caller_can_run_twice(spark, tmp_dir):
    found = counted(spark)
    first = sorted(map(tuple, found.collect()))
    write_table(found, f"{tmp_dir}/t")
    assert sorted(map(tuple, found.collect())) == first


def test_large_tables_are_written_one_after_another(spark, tmp_dir, monkeypatch):
    for name in store.RAW_TABLES:
        os.makedirs(f"{tmp_dir}/{name}.parquet")
        with open(f"{tmp_dir}/{name}.parquet/part", "w") as f:
            f.write("x" * 10)
    assert store.write_together(spark, tmp_dir)
    monkeypatch.setattr(store, "TOGETHER_BYTES", 10 * len(store.RAW_TABLES) - 1)
    assert not store.write_together(spark, tmp_dir)

    now, most = [], []

    def write(df, path, **_):
        now.append(path)
        most.append(len(now))
        time.sleep(0.05)
        now.remove(path)
        return False

    monkeypatch.setattr(mart, "write_table", write)
    tables = mart.Mart.from_tables(dict.fromkeys(mart.MART_TABLES))
    mart.write_mart(spark, tables, tmp_dir, mart.MART_TABLES[:4], concurrent=False)
    assert most == [1, 1, 1, 1]


def test_a_versioned_star_leaves_neither_shuffles_nor_work(spark, tmp_dir):
    st = staging(
        spark, customers=[(f"c{i}", f"u{i % 5}", "1", "x", "S") for i in range(20)],
        orders=[order(f"o{i}", f"c{i}", p=f"2017-0{1 + i % 3}-01 10:00:00", a=f"2017-0{1 + i % 3}-01 11:00:00",
                      c=None, d=None, e="2017-12-01 10:00:00") for i in range(20)],
        items=[item(f"o{i % 20}", i, pid=f"p{i % 7}") for i in range(60)],
        payments=[payment(f"o{i}", 1) for i in range(20)])
    later = replace(st, order_items=st.order_items.where("order_id <> 'o3'"))
    before = shuffle_files(spark)
    star = StarVersions(spark, tmp_dir, together=False)
    star.rebuild(st)
    assert left_over(spark, before) == set()
    assert star.mart().fact_order_items.agg(F.sum("quantity")).first()[0] == 60
    done = star.maintain(later, staging_changes(st, later))
    assert done.info["replaced"]["fact_orders"] == ["201701"]
    assert star.mart().fact_order_items.agg(F.sum("quantity")).first()[0] == 57
    assert os.listdir(f"{tmp_dir}/work") == []


def test_jobs_run_one_after_another_where_asked(spark):
    now, most = [], []

    def job(i):
        now.append(i)
        most.append(len(now))
        time.sleep(0.05)
        now.remove(i)
        return i

    jobs = {i: partial(job, i) for i in range(4)}
    assert _at_once(jobs, together=False) == {i: i for i in range(4)} and set(most) == {1}
