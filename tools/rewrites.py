"""Time the literal plan shapes against the rewrites the models use.

    python tools/rewrites.py [sf_dir]

R1  payment summary: items x payments fan-out join, then aggregate
    -> aggregate each side per order, amount = sum(price) * count(payments)
R2  calendar: six-way UNION DISTINCT of time text, then DISTINCT keys
    -> one scan with explode(array(...)), truncate to the minute, one DISTINCT

    -> join with (order id, multiplicity)
Each form is checked to give the same rows, then timed (median of 3) into the
``noop`` sink over the stored staging layer.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from martlet.functions.labels import payment_label  # noqa: E402
from martlet.functions.money import money_sum  # noqa: E402
from martlet.functions.timekeys import blank_to_null, minute_floor, minute_key_of, parse_time_strict  # noqa: E402
from martlet.operators import dims, facts  # noqa: E402
from martlet.plans.store import stored_staging  # noqa: E402
from martlet.session import local_session  # noqa: E402


def fan_out_payment_summary(items, payments):
    j = items.join(payments, "order_id")
    return j.groupBy("order_id").agg(
        money_sum("price").cast("double").alias("total_order_amount"),
        F.array_join(F.array_sort(F.collect_set(payment_label("payment_type"))), ", ").alias("payment_type"),
    )


def union_calendar(orders, items):
    cols = list(dims.ORDER_TIME_COLUMNS)
    parts = [orders.where(F.col(c).isNotNull()).select(blank_to_null(c).alias("t")) for c in cols]
    parts.append(items.where(F.col("shipping_limit_date").isNotNull())
                 .select(blank_to_null("shipping_limit_date").alias("t")))
    u = parts[0]
    for p in parts[1:]:
        u = u.union(p)
    ts = parse_time_strict(F.col("t"))
    return u.distinct().select(minute_key_of(ts).alias("date_id"), minute_floor(ts).alias("full_datetime")) \
        .distinct().where(F.col("date_id").isNotNull())


def plain_join_items(items, fo):
    return facts.aggregated_items(items).join(fo.select("order_id"), "order_id")


def timed(df, repeat=3):
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    st = stored_staging(spark, sf_dir)
    fo = facts.fact_orders(st.orders, st.customers, st.order_items, st.order_payments).cache()
    fo.count()
    pairs = {
        "R1_payment_summary": (fan_out_payment_summary(st.order_items, st.order_payments),
                               facts.payment_summary(st.order_items, st.order_payments)),
        "R2_calendar_minutes": (union_calendar(st.orders, st.order_items),
                                dims.dim_date(st.orders, st.order_items).select("date_id", "full_datetime")),
        "R4_item_fact_join": (plain_join_items(st.order_items, fo),
                              facts.fact_order_items(st.order_items, fo)),
    }
    out = {}
    for name, (literal, rewrite) in pairs.items():
        timed(literal, 1)
        timed(rewrite, 1)
        out[name] = {"equal": same(literal, rewrite), "literal_s": timed(literal),
                     "rewrite_s": timed(rewrite)}
        print(name, out[name], flush=True)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
