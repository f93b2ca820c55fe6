import os

from pyspark.sql import functions as F

from martlet.sources.testdata import stg_orders
from martlet.streaming.incremental import (
    append_new_keys,
    incremental_load,
    incremental_orders_load,
    source_of,
)
from tests.conftest import SF_SMALL


def test_incremental_load_new_files_only(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    src, target, ck = (os.path.join(tmp_dir, x) for x in ("src", "target", "ck"))
    first = orders.where(F.col("o_orderkey") < 700)
    first.write.parquet(f"{src}/part=1")
    got1 = incremental_load(spark, src, orders.schema, target, ["order_id"], ck, transform=stg_orders,
                            options={"recursiveFileLookup": "true"})
    assert sum(got1) == first.count()
    # second wave: new orders plus a re-sent copy of old ones
    orders.where(F.col("o_orderkey") >= 650).write.parquet(f"{src}/part=2")
    got2 = incremental_load(spark, src, orders.schema, target, ["order_id"], ck, transform=stg_orders,
                            options={"recursiveFileLookup": "true"})
    assert sum(got2) == orders.where(F.col("o_orderkey") >= 700).count()
    loaded = spark.read.parquet(target)
    assert loaded.count() == orders.count() == loaded.select("order_id").distinct().count()
    # nothing new: nothing appended
    assert sum(incremental_load(spark, src, orders.schema, target, ["order_id"], ck,
                                transform=stg_orders, options={"recursiveFileLookup": "true"})) == 0


def test_null_keys_and_one_row_per_key(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    batch = spark.createDataFrame([(None, "b"), (None, "a"), ("k", "y"), ("k", "x")], "id string, v string")
    assert append_new_keys(batch, target, ["id"]) == 2
    assert append_new_keys(batch, target, ["id"]) == 0
    assert {tuple(r) for r in spark.read.parquet(target).collect()} == {(None, "a"), ("k", "x")}


def test_sources_are_files_or_folders(spark, tmp_dir):
    """The orders table as one file and as a folder of part files, as it is at scale."""
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.repartition(3).write.parquet(f"{tmp_dir}/sf/orders.parquet")
    for i, sf in enumerate((SF_SMALL, f"{tmp_dir}/sf")):
        folder, options = source_of(spark, f"{sf}/orders.parquet")
        n = incremental_load(spark, folder, orders.schema, f"{tmp_dir}/t{i}", ["order_id"], f"{tmp_dir}/c{i}",
                             transform=stg_orders, options=options)
        assert sum(n) == orders.count()
        assert incremental_orders_load(spark, sf, f"{tmp_dir}/load{i}").count() == orders.count()
