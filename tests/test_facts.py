import itertools

import pytest
from pyspark.sql import functions as F

from martlet.operators import facts
from tests.fixtures import item, order, payment, staging

T = {"earlier": "2017-03-01 09:00:00", "equal": "2017-03-01 10:00:00", "later": "2017-03-01 11:00:00"}
CHOICES = [None, "", "earlier", "equal", "later"]


def _value(choice):
    return T.get(choice, choice)


def _le(x, y):
    return None if x is None or y is None else x <= y


def _or(*vals):
    if any(v is True for v in vals):
        return True
    return None if any(v is None for v in vals) else False


def _kept(p, a, c, d, e):
    p, a, c, d, e = (None if v in (None, "") else v for v in (p, a, c, d, e))
    rules = [
        _or(a is None, _le(p, a)),
        _or(c is None, a is None, _le(a, c)),
        _or(d is None, c is None, _le(c, d)),
        _or(e is None, _le(p, e)),
    ]
    return all(r is True for r in rules)


def test_lifecycle_truth_table(spark):
    rows, expected = [], set()
    for i, combo in enumerate(itertools.product(CHOICES, repeat=5)):
        vals = [_value(c) for c in combo]
        rows.append(order(str(i), "c1", "delivered", *vals))
        if _kept(*vals):
            expected.add(str(i))
    st = staging(spark, orders=rows, customers=[("c1", "u1", "01001", "city", "st")])
    fo = facts.fact_orders(st.orders, st.customers, st.order_items, st.order_payments)
    got = {r.order_id for r in fo.select("order_id").collect()}
    assert got == expected
    # a NULL purchase with a non-NULL approval is dropped
    assert not _kept(None, T["equal"], None, None, None)


def test_fan_out_amount_and_labels(spark):
    st = staging(
        spark,
        orders=[order("o1"), order("o2"), order("o3")],
        customers=[("c1", "u1", "01001", "city", "st")],
        items=[item("o1", 1, price="10.00"), item("o1", 2, pid="p2", price="5.50"),
               item("o2", 1, price="7.25"), item("o3", 1, price="1.00")],
        payments=[payment("o1", 1, "boleto"), payment("o1", 2, "credit_card"),
                  payment("o1", 3, "voucher"),
                  payment("o3", 1, "mystery"), payment("o3", 2, None)],
    )
    fo = facts.fact_orders(st.orders, st.customers, st.order_items, st.order_payments)
    got = {r.order_id: (r.total_order_amount, r.payment_type) for r in fo.collect()}
    assert got["o1"] == (46.5, "Bank Transfer, Credit Card, Other")  # 3 x (10.00 + 5.50)
    assert got["o2"] == (None, None)  # items but no payments
    assert got["o3"] == (2.0, "Other")  # unknown and NULL codes


def test_fact_orders_keys_and_customer(spark):
    st = staging(
        spark,
        orders=[order("o1", a="not a time", c=None, d=None), order("o2", cid="missing")],
        customers=[("c1", "u1", "01001", "city", "st")],
    )
    fo = facts.fact_orders(st.orders, st.customers, st.order_items, st.order_payments)
    rows = {r.order_id: r for r in fo.collect()}
    assert rows["o1"].purchase_date_id == 201701011000
    assert rows["o1"].approved_date_id is None  # lenient key
    assert rows["o1"].customer_id == "u1"
    assert rows["o2"].customer_id is None  # unmatched customer kept (left join)
    assert fo.columns == facts.FACT_ORDERS_COLUMNS


def test_fact_order_items_groups_and_strict_key(spark):
    st = staging(
        spark,
        orders=[order("o1"), order("o2")],
        customers=[("c1", "u1", "01001", "city", "st")],
        items=[item("o1", 1, price="10.00", freight="1.00"), item("o1", 2, price="2.50", freight="0.50"),
               item("o1", 3, limit="2017-01-03 10:00:30"),  # same minute, other raw text
               item("o9", 1)],  # order not in the fact
    )
    fo = facts.fact_orders(st.orders, st.customers, st.order_items, st.order_payments)
    fi = facts.fact_order_items(st.order_items, fo)
    rows = sorted((r.quantity, r.total_price, r.total_freight, r.shipping_limit_date_id)
                  for r in fi.collect())
    assert rows == [(1, 10.0, 1.5, 201701031000), (2, 12.5, 1.5, 201701031000)]

    bad = staging(spark, orders=[order("o1")], customers=[("c1", "u1", "z", "c", "s")],
                  items=[item("o1", 1, limit="")])
    fo2 = facts.fact_orders(bad.orders, bad.customers, bad.order_items, bad.order_payments)
    with pytest.raises(Exception):
        facts.fact_order_items(bad.order_items, fo2).collect()


def test_fact_order_items_repeats_for_duplicate_order_rows(spark):
    st = staging(spark, items=[item("o1", 1)])
    fo = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    fi = facts.fact_order_items(st.order_items, fo)
    assert fi.count() == 2  # exactly what an inner join gives


def test_payment_summary_matches_fan_out_join(spark):
    st = staging(
        spark,
        items=[item("o1", i, price=f"{i}.10") for i in range(1, 5)],
        payments=[payment("o1", s, c) for s, c in enumerate(["boleto", "debit_card", "x"], 1)],
    )
    ps = facts.payment_summary(st.order_items, st.order_payments).first()
    fan = (st.order_items.join(st.order_payments, "order_id")
           .agg(F.sum(F.col("price").cast("decimal(18,2)")).cast("double")).first()[0])
    assert ps.total_order_amount == fan
    assert ps.payment_type == "Bank Transfer, Debit Card, Other"
