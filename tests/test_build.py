import os

import pytest

from martlet import session
from martlet.plans.build import build
from martlet.plans.mart import Mart, publish_mart, write_mart
from martlet.plans.store import stored_staging
from tests.conftest import SF_SMALL


def test_build_writes_star_report_and_metrics(spark, tmp_dir):
    summary = build(spark, stored_staging(spark, SF_SMALL), tmp_dir, namespace="marts_test")
    assert set(summary["marts"]) == {"dim_customers", "dim_date", "dim_products", "dim_sellers",
                                     "fact_orders", "fact_order_items"}
    assert summary["failed_tests"] == ["assert_unique_fact_order_items"]
    assert spark.read.parquet(f"{tmp_dir}/metrics/sales_overview").first().total_orders == 1454
    assert spark.read.parquet(f"{tmp_dir}/tests/report").count() == 27


def test_a_rebuild_keeps_the_name_and_every_row(spark, tmp_dir):
    staging = stored_staging(spark, SF_SMALL)
    for _ in range(3):
        names = publish_mart(spark, write_mart(spark, Mart(staging), tmp_dir), "marts_rebuild")
        assert names["fact_orders"] == "marts_rebuild.fact_orders"
        assert spark.table("marts_rebuild.fact_orders").groupBy("order_id").count().count() == 1454
    assert len(os.listdir(f"{tmp_dir}/marts/fact_orders")) == 2  # the current version and the one before
    assert spark.table("marts_rebuild.dim_date").count() > 0
    with pytest.raises(Exception):  # a failing build leaves the published table as it is
        write_mart(spark, Mart(None, fact_orders=None), tmp_dir, ("dim_sellers",))
    assert spark.table("marts_rebuild.dim_sellers").count() > 0


def test_a_cluster_needs_a_shared_folder(monkeypatch, spark):
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    monkeypatch.setattr(session, "is_local", lambda s: False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(spark)
