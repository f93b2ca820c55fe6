"""Hot keys: results must equal a brute-force computation on the same rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.operators import dims, facts
from martlet.operators.ordered import running_total
from tests.fixtures import item, order, payment, staging


def test_running_total_with_a_hot_tie(spark):
    rnd = random.Random(7)
    rows = [(f"p{i:05d}", Decimal(rnd.randint(0, 500)) / 100) for i in range(3000)]
    rows += [(f"h{i:05d}", Decimal("1.23")) for i in range(1500)]  # a third share one value
    df = spark.createDataFrame(rows, "id string, v decimal(18,2)")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r.id: r.cum for r in running_total(df, order, "v", "cum", num_partitions=7).collect()}
    acc, want = Decimal(0), {}
    for i, v in sorted(rows, key=lambda r: (-r[1], r[0])):
        acc += v
        want[i] = acc
    assert got == want


@pytest.mark.parametrize("parts", [1, 2, 4, 8])
def test_running_total_over_nulls(spark, parts):
    """NULLs add nothing, wherever the range partitions fall."""
    rows = [("a", Decimal(10)), ("b", Decimal(5))] + [(f"n{i}", None) for i in range(9)]
    df = spark.createDataFrame(rows, "id string, v decimal(18,2)")
    down = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = {r.id: r.cum for r in running_total(df, down, "v", "cum", num_partitions=parts).collect()}
    assert got["a"] == 10 and {got[i] for i in got if i != "a"} == {15}
    up = [F.col("v").asc_nulls_first(), F.col("id").asc()]
    got = {r.id: r.cum for r in running_total(df, up, "v", "cum", num_partitions=parts).collect()}
    assert got["b"] == 5 and got["a"] == 15 and {got[f"n{i}"] for i in range(9)} == {None}


def test_hot_customer_and_hot_order(spark):
    n = 600
    orders, customers, items, pays = [], [], [], []
    for i in range(n):
        cid = f"c{i}"
        uid = "hot" if i % 3 == 0 else f"u{i}"  # one person holds a third of the orders
        zip_code = f"{i % 7:05d}"
        customers.append((cid, uid, zip_code, f"city{i % 7}", "S"))
        minute = i % 60
        orders.append(order(f"o{i}", cid, p=f"2017-01-01 10:{minute:02d}:00",
                            a=f"2017-01-01 11:{minute:02d}:00"))
        items.append(item(f"o{i}", 1, price="1.00"))
        pays.append(payment(f"o{i}", 1))
    # one order holds a third of all items and payments
    items += [item("o1", k, pid=f"p{k % 5}", price="2.00") for k in range(2, 302)]
    pays += [payment("o1", s, "boleto") for s in range(2, 302)]
    st = staging(spark, customers=customers, orders=orders, items=items, payments=pays)

    dc = {r.customer_id: r.zip_code for r in dims.dim_customers(st.customers, st.orders).collect()}
    hot = [c for c in customers if c[1] == "hot"]
    latest = max((orders[int(c[0][1:])][3], c[2]) for c in hot)
    best = min(c[2] for c in hot if orders[int(c[0][1:])][3] == latest[0])
    assert dc["hot"] == best and len(dc) == 1 + sum(1 for c in customers if c[1] != "hot")

    fo = {r.order_id: r for r in facts.fact_orders(st.orders, st.customers, st.order_items,
                                                    st.order_payments).collect()}
    assert fo["o1"].total_order_amount == (1.00 + 300 * 2.00) * 301
    assert fo["o1"].payment_type == "Bank Transfer, Credit Card"
    assert fo["o2"].total_order_amount == 1.0
