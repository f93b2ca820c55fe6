import pytest

from martlet.operators import dims
from tests.fixtures import item, order, staging


def test_dim_customers_latest_address_ties_and_nulls(spark):
    customers = [
        ("a1", "u1", "00001", "cityA", "S"), ("a2", "u1", "00002", "cityB", "S"),
        ("a3", "u1", "00001", "cityA", "S"),
        ("b1", "u2", "00009", "cityX", "S"), ("b2", "u2", "00003", "cityY", "S"),
        ("n1", "u3", "00005", "cityN", "S"), ("n2", "u3", "00004", "cityM", "S"),
        ("z1", "u4", "00007", "cityZ", "S"),  # no orders: dropped
    ]
    orders = [
        order("1", "a1", p="2017-01-01 10:00:00"), order("2", "a2", p="2017-02-01 10:00:00"),
        order("3", "a3", p="2017-03-01 10:00:00"),
        order("4", "b1", p="2017-05-01 10:00:00"), order("5", "b2", p="2017-05-01 10:00:00"),
        order("6", "n1", p=None), order("7", "n2", p="2018-01-01 10:00:00"),
    ]
    st = staging(spark, customers=customers, orders=orders)
    got = {r.customer_id: (r.zip_code, r.city) for r in dims.dim_customers(st.customers, st.orders).collect()}
    assert got == {
        "u1": ("00001", "cityA"),  # latest order (March) is at address A
        "u2": ("00003", "cityY"),  # tie on time: lowest zip
        "u3": ("00005", "cityN"),  # a NULL latest time ranks first
    }


def test_dim_products_clean_up(spark):
    products = [
        ("p1", "medium", "100", "1", "2", "3"), ("p2", "small", "100", "1", "2", "3"),
        ("p3", "promo", "100", "1", "2", "3"), ("p4", None, "100", "1", "2", "3"),
        (None, "medium", "100", "1", "2", "3"), ("p5", "economy", "100", "1", "2", "3"),
        ("p5", "economy", "100", "1", "2", "3"),
    ]
    tr = [("medium", " perfumery "), ("small", "  "), ("economy", "health_beauty")]
    st = staging(spark, products=products, translation=tr)
    got = {r.product_id: r.category_name for r in dims.dim_products(st.products, st.translation).collect()}
    assert got == {"p1": "perfumery", "p2": "Unknown", "p3": "Unknown", "p4": "Unknown",
                   "p5": "health_beauty"}
    assert dims.dim_products(st.products, st.translation).count() == 5


def test_dim_sellers_distinct(spark):
    st = staging(spark, sellers=[("s1", 1001, "c", "S"), ("s1", 1001, "c", "S"), ("s1", 2, "d", "S")])
    out = dims.dim_sellers(st.sellers)
    assert out.columns == ["seller_id", "city", "state", "zip_code"]
    assert out.count() == 2  # a key repeats when attributes differ


def test_dim_date_minutes_and_parts(spark):
    st = staging(
        spark,
        orders=[order("1", p="2017-10-15 00:30:45", a="", c=None, d="2017-10-15 00:30:10",
                      e="2017-12-31 23:59:59")],
        items=[item("1", 1, limit="2017-10-15 00:30:00")],
    )
    rows = {r.date_id: r for r in dims.dim_date(st.orders, st.order_items).collect()}
    assert set(rows) == {201710150030, 201712312359}
    r = rows[201710150030]
    assert (r.year, r.month, r.day, r.hour, r.day_of_week, r.year_quarter) == (
        2017, 10, 15, 0, "Sunday", "2017Q4")
    assert str(r.full_datetime) == "2017-10-15 00:30:00"


def test_dim_date_strict_on_bad_text(spark):
    st = staging(spark, orders=[order("1", a="yesterday")])
    with pytest.raises(Exception):
        dims.dim_date(st.orders, st.order_items).collect()
