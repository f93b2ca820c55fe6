"""Hand-made staging rows for unit tests."""

from martlet.sources.staging import STAGING_SCHEMAS, Staging


def frame(spark, table, rows):
    return spark.createDataFrame(rows, STAGING_SCHEMAS[table])


def staging(spark, *, customers=(), orders=(), items=(), products=(), payments=(),
            sellers=(), translation=()):
    return Staging(
        customers=frame(spark, "stg_customers", list(customers)),
        orders=frame(spark, "stg_orders", list(orders)),
        order_items=frame(spark, "stg_order_items", list(items)),
        products=frame(spark, "stg_products", list(products)),
        order_payments=frame(spark, "stg_order_payments", list(payments)),
        sellers=frame(spark, "stg_sellers", list(sellers)),
        translation=frame(spark, "stg_product_category_name_translation", list(translation)),
    )


def order(oid, cid="c1", status="delivered", p="2017-01-01 10:00:00", a="2017-01-01 11:00:00",
          c="2017-01-02 10:00:00", d="2017-01-05 10:00:00", e="2017-01-10 10:00:00"):
    return (oid, cid, status, p, a, c, d, e)


def item(oid, n, pid="p1", sid="s1", limit="2017-01-03 10:00:00", price="10.00", freight="1.50"):
    return (oid, str(n), pid, sid, limit, price, freight)


def payment(oid, seq, code="credit_card", value=10.0):
    return (oid, seq, code, 1, value)
