
import os
import sys

from martlet.operators import dims, facts
from martlet.plans.store import stored_staging
from martlet.session import cluster_conf
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from rewrites import fan_out_payment_summary, plain_join_items, same, union_calendar  # noqa: E402


def test_r1_r2_r4_equal_literal_forms(spark):
    st = stored_staging(spark, SF_SMALL)
    fo = facts.fact_orders(st.orders, st.customers, st.order_items, st.order_payments)
    assert same(fan_out_payment_summary(st.order_items, st.order_payments),
                facts.payment_summary(st.order_items, st.order_payments))
    assert same(union_calendar(st.orders, st.order_items),
                dims.dim_date(st.orders, st.order_items).select("date_id", "full_datetime"))
    assert same(plain_join_items(st.order_items, fo), facts.fact_order_items(st.order_items, fo))


def test_cluster_conf_sizing():
    small = cluster_conf(64, 10 * 2**30)
    assert int(small["spark.sql.shuffle.partitions"]) == 192  # 3 per core wins
    big = cluster_conf(8000, 100 * 2**40)
    assert int(big["spark.sql.shuffle.partitions"]) == 102_400  # 256 MB of a quarter of the input
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
