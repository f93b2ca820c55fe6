"""Independent SQL (DuckDB dialect) for every registered query.

Each statement reads only the shared test tables (``orders``, ``lineitem``,
``customer``, ``part``, ``supplier``, ``nation``, ``region``) and restates the
staging adapter, the star and the query in plain SQL from their definitions in
the survey. The order of an order's life comes from the one table of pairs in
``operators.lifecycle``, which the Spark side reads, too.
"""

from __future__ import annotations

from martlet.operators import lifecycle

_TS = "'%Y-%m-%d %H:%M:%S'"


def _fmt(expr: str) -> str:
    return f"strftime({expr}, {_TS})"


def _plus(ts: str, minutes: str) -> str:
    return f"({ts} + to_minutes(CAST({minutes} AS BIGINT)))"


STAGING = {
    "stg_orders": f"""
SELECT CAST(k AS VARCHAR) AS order_id,
       'c' || CAST(k AS VARCHAR) AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                          WHEN 'P' THEN 'processing' END AS order_status,
       {_fmt('p')} AS order_purchase_timestamp,
       CASE WHEN k % 100 = 0 THEN NULL WHEN k % 100 = 50 THEN ''
            ELSE {_fmt(_plus('p', '(k * 37) % 2880 - 60'))} END AS order_approved_at,
       CASE WHEN o_orderstatus = 'P' THEN NULL WHEN k % 41 = 0 THEN ''
            ELSE {_fmt(_plus('p', '2700 + (k * 53) % 7200'))} END AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus <> 'F' THEN ''
            ELSE {_fmt(_plus('p', '9000 + (k * 71) % 20000'))} END AS order_delivered_customer_date,
       {_fmt(_plus('p', '(k * 91) % 43200 - 300'))} AS order_estimated_delivery_date
FROM (SELECT *, o_orderkey AS k, {_plus('o_orderdate', 'o_orderkey % 1440')} AS p FROM orders)""",
    "stg_customers": """
SELECT 'c' || CAST(o.o_orderkey AS VARCHAR) AS customer_id,
       CAST(o.o_custkey AS VARCHAR) AS customer_unique_id,
       lpad(CAST((o.o_custkey * 7 + o.o_orderkey % 3) % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       n.n_name AS customer_city,
       r.r_name AS customer_state
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON n.n_nationkey = (c.c_nationkey + o.o_orderkey % 3) % 25
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "stg_order_items": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_linenumber * 10 + copy AS VARCHAR) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS seller_id,
       {_fmt(_plus('l_shipdate', 'l_partkey % 1440'))} AS shipping_limit_date,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS freight_value
FROM (SELECT *, unnest(generate_series(1, 1 + l_linenumber % 3)) AS copy FROM lineitem)""",
    "stg_order_payments": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(seq AS BIGINT) AS payment_sequential,
       CASE (o_orderkey + seq) % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto'
            WHEN 2 THEN 'debit_card' WHEN 3 THEN 'voucher' WHEN 4 THEN 'not_defined' END AS payment_type,
       CAST(1 + o_orderkey % 10 AS BIGINT) AS payment_installments,
       CAST((2 * CAST(round(o_totalprice * 100) AS BIGINT) + (1 + o_orderkey % 3))
            // (2 * (1 + o_orderkey % 3)) AS DOUBLE) / 100.0 AS payment_value
FROM (SELECT *, unnest(generate_series(1, 1 + o_orderkey % 3)) AS seq FROM orders)""",
    "stg_products": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE lower(p_type) END AS product_category_name,
       CAST(p_size * 100 AS VARCHAR) AS product_weight_g,
       CAST(p_size + 5 AS VARCHAR) AS product_length_cm,
       CAST(p_size + 2 AS VARCHAR) AS product_height_cm,
       CAST(p_size + 3 AS VARCHAR) AS product_width_cm
FROM part""",
    "stg_translation": """
SELECT * FROM (VALUES ('economy', 'health_beauty'), ('standard', 'auto'),
                      ('large', 'bed_bath_table'), ('medium', ' perfumery '), ('small', '  '))
       AS t(product_category_name, product_category_name_english)""",
    "stg_sellers": """
SELECT CAST(s.s_suppkey AS VARCHAR) AS seller_id,
       CAST((s.s_suppkey * 11) % 100000 AS BIGINT) AS seller_zip_code_prefix,
       n.n_name AS seller_city,
       r.r_name AS seller_state
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "stg_geolocation": """
SELECT CAST(n.n_nationkey * 1000 AS BIGINT) AS geolocation_zip_code_prefix,
       CAST(n.n_nationkey - 12 AS DOUBLE) AS geolocation_lat,
       CAST(n.n_nationkey * 2 - 24 AS DOUBLE) AS geolocation_lng,
       n.n_name AS geolocation_city,
       r.r_name AS geolocation_state
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "stg_order_reviews": f"""
SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS review_id,
       CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(1 + o_orderkey % 5 AS BIGINT) AS review_score,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderpriority END AS review_comment_title,
       CASE WHEN o_orderkey % 12 = 0 THEN NULL
            ELSE 'note "' || o_orderpriority || '", a\\b' || chr(10) || 'end' END AS review_comment_message,
       {_fmt(_plus('o_orderdate', '43200'))} AS review_creation_date,
       {_fmt(_plus('o_orderdate', '44640 + o_orderkey % 1440'))} AS review_answer_timestamp
FROM orders""",
}

# Times of an order in the order fact, by staged column.
_TIMES = {
    "order_purchase_timestamp": "purchase",
    "order_approved_at": "approved",
    "order_delivered_carrier_date": "delivered_carrier",
    "order_delivered_customer_date": "delivered_customer",
    "order_estimated_delivery_date": "estimated_delivery",
}


def _minute_id(ts: str) -> str:
    """yyyyMMddHHmm of a TIMESTAMP as a BIGINT."""
    parts = (("year", 10**8), ("month", 10**6), ("day", 10**4), ("hour", 100), ("minute", 1))
    return "CAST(" + " + ".join(f"date_part('{p}', {ts}) * {n}" for p, n in parts) + " AS BIGINT)"


def _in_order(columns: str) -> str:
    """TRUE where no pair of lifecycle times breaks its rule (``columns``: a name
    pattern with {} for the lifecycle column)."""
    tests = []
    for earlier, later, may_miss in lifecycle.PAIRS:
        e, t = columns.format(earlier), columns.format(later)
        missing = f"{t} IS NULL" + (f" OR {e} IS NULL" if may_miss else "")
        tests.append(f"coalesce({missing} OR {e} <= {t}, FALSE)")
    return f"list_bool_and([{', '.join(tests)}])"


def _out_of_order(columns: str) -> str:
    tests = [f"coalesce({columns.format(e)} > {columns.format(t)}, FALSE)"
             for e, t, _ in lifecycle.PAIRS]
    return f"list_bool_or([{', '.join(tests)}])"


_CENTS = "CAST(round(CAST({} AS DECIMAL(18,2)) * 100) AS HUGEINT)"


def _euros(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(38,0)) / 100 AS DOUBLE)"


MARTS = {
    # an address counts from its last order; one without any time comes first
    "dim_customers": """
SELECT customer_unique_id AS customer_id, best.city, best.state, best.zip_code
FROM (SELECT customer_unique_id,
             first(place ORDER BY latest DESC NULLS FIRST, place.zip_code NULLS LAST,
                   place.city NULLS LAST, place.state NULLS LAST) AS best
      FROM (SELECT customer_unique_id, max(order_purchase_timestamp) AS latest,
                   {'city': customer_city, 'state': customer_state,
                    'zip_code': customer_zip_code_prefix} AS place
            FROM stg_orders JOIN stg_customers USING (customer_id)
            GROUP BY customer_unique_id, customer_city, customer_state, customer_zip_code_prefix)
      GROUP BY customer_unique_id)""",
    "dim_date": f"""
SELECT {_minute_id('full_datetime')} AS date_id, full_datetime,
       CAST(date_part('year', full_datetime) AS INTEGER) AS year,
       CAST(date_part('month', full_datetime) AS INTEGER) AS month,
       CAST(date_part('day', full_datetime) AS INTEGER) AS day,
       dayname(full_datetime) AS day_of_week,
       CAST(date_part('hour', full_datetime) AS INTEGER) AS hour,
       format('{{}}Q{{}}', date_part('year', full_datetime), date_part('quarter', full_datetime)) AS year_quarter
FROM (SELECT date_trunc('minute', CAST(moment AS TIMESTAMP)) AS full_datetime
      FROM (SELECT unnest([{', '.join(_TIMES)}]) AS moment FROM stg_orders
            UNION ALL SELECT shipping_limit_date FROM stg_order_items)
      WHERE length(moment) > 0
      GROUP BY 1)""",
    "dim_products": """
SELECT p.product_id,
       CASE WHEN length(trim(t.product_category_name_english)) > 0
            THEN trim(t.product_category_name_english) ELSE 'Unknown' END AS category_name,
       p.product_weight_g AS weight_g, p.product_length_cm AS length_cm,
       p.product_height_cm AS height_cm, p.product_width_cm AS width_cm
FROM stg_products p LEFT JOIN stg_translation t USING (product_category_name)
WHERE p.product_id IS NOT NULL
GROUP BY ALL""",
    "dim_sellers": """
SELECT seller_id, seller_city AS city, seller_state AS state, seller_zip_code_prefix AS zip_code
FROM stg_sellers GROUP BY ALL""",
    # every item meets every payment of its order: both sides may be summed apart
    "payment_summary": f"""
SELECT order_id, {_euros('cents * payments')} AS total_order_amount, payment_type
FROM (SELECT order_id, sum({_CENTS.format('price')}) AS cents FROM stg_order_items GROUP BY order_id)
JOIN (SELECT order_id, count(*) AS payments,
             array_to_string(list_sort(list_distinct(list(
                 coalesce(map {{'boleto': 'Bank Transfer', 'credit_card': 'Credit Card',
                               'debit_card': 'Debit Card'}}[payment_type], 'Other')))), ', ') AS payment_type
      FROM stg_order_payments GROUP BY order_id) USING (order_id)""",
    "fact_orders": f"""
SELECT lived.*, total_order_amount, payment_type,
       {', '.join(f"{_minute_id(f'TRY_CAST({n}_timestamp_id AS TIMESTAMP)')} AS {n}_date_id" for n in _TIMES.values())}
FROM (SELECT o.order_id, c.customer_unique_id AS customer_id, o.order_status AS status,
             {', '.join(f"CASE WHEN o.{c} <> '' THEN o.{c} END AS {n}_timestamp_id" for c, n in _TIMES.items())}
      FROM stg_orders o LEFT JOIN stg_customers c USING (customer_id)
      WHERE o.order_id IS NOT NULL
      GROUP BY ALL) lived
LEFT JOIN payment_summary USING (order_id)
WHERE {_in_order('lived.{}')}""",
    "fact_order_items": f"""
SELECT order_id, product_id, seller_id, quantity, total_price, total_freight, shipping_limit_date_id
FROM fact_orders JOIN (
  SELECT order_id, product_id, seller_id, count(*) AS quantity,
         {_euros(f"sum({_CENTS.format('price')})")} AS total_price,
         {_euros(f"sum({_CENTS.format('freight_value')})")} AS total_freight,
         {_minute_id('CAST(shipping_limit_date AS TIMESTAMP)')} AS shipping_limit_date_id
  FROM stg_order_items GROUP BY order_id, product_id, seller_id, shipping_limit_date) USING (order_id)""",
}


def with_star(select_sql: str) -> str:
    """Prefix ``select_sql`` with the staging and star definitions as CTEs."""
    parts = [f"{name} AS ({body}\n)" for name, body in {**STAGING, **MARTS}.items()]
    return "WITH " + ",\n".join(parts) + "\n" + select_sql


def table_sql(name: str) -> str:
    return with_star(f"SELECT * FROM {name}")


# The data tests, written down apart from the Spark suite: the key of each
# table, its other required columns, and (table, column, parent) references.
_KEYS = {"dim_customers": "customer_id", "dim_sellers": "seller_id", "dim_products": "product_id",
         "dim_date": "date_id", "fact_orders": "order_id"}
_REQUIRED = {"fact_orders": ("customer_id", "purchase_date_id"),
             "fact_order_items": ("order_id", "product_id", "seller_id")}
_REFERENCES = (
    ("fact_orders", "customer_id", "dim_customers"),
    *((("fact_orders", f"{n}_date_id", "dim_date")) for n in _TIMES.values()),
    ("fact_order_items", "order_id", "fact_orders"),
    ("fact_order_items", "product_id", "dim_products"),
    ("fact_order_items", "seller_id", "dim_sellers"),
    ("fact_order_items", "shipping_limit_date_id", "dim_date"),
)

DUPLICATE_ITEMS_SQL = """
SELECT DISTINCT order_id, product_id, copies AS duplicate_count
FROM (SELECT order_id, product_id, count(*) OVER (PARTITION BY order_id, product_id) AS copies
      FROM fact_order_items)
WHERE copies > 1"""
SEQUENCE_SQL = f"SELECT * FROM fact_orders WHERE {_out_of_order('{}')}"
# The same test over orders that the lifecycle filter has not seen.
RAW_SEQUENCE_SQL = f"""
SELECT order_id, {', '.join(f"{n}_timestamp_id" for n in _TIMES.values())}
FROM (SELECT order_id, {', '.join(f"CASE WHEN {c} <> '' THEN {c} END AS {n}_timestamp_id" for c, n in _TIMES.items())}
      FROM stg_orders)
WHERE {_out_of_order('{}')}"""


def report_sql(kinds: tuple[str, ...] | None) -> str:
    tests = []  # name, table, column, kind, failures
    for t, k in _KEYS.items():
        tests.append((f"unique_{t}_{k}", t, k, "unique",
                      f"SELECT count(*) FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k}) "
                      f"WHERE n > 1 AND {k} IS NOT NULL"))
    for t in dict.fromkeys([*_KEYS, *_REQUIRED]):
        for c in ([_KEYS[t]] if t in _KEYS else []) + list(_REQUIRED.get(t, ())):
            tests.append((f"not_null_{t}_{c}", t, c, "not_null",
                          f"SELECT count(*) - count({c}) FROM {t}"))
    for t, c, parent in _REFERENCES:
        tests.append((f"relationships_{t}_{c}", t, c, "relationships",
                      f"SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                      f"(SELECT 1 FROM {parent} y WHERE y.{_KEYS[parent]} = x.{c})"))
    tests.append(("assert_unique_fact_order_items", "fact_order_items", "order_id, product_id", "custom",
                  f"SELECT count(*) FROM ({DUPLICATE_ITEMS_SQL})"))
    tests.append(("assert_order_process_sequence", "fact_orders", "", "custom",
                  f"SELECT count(*) FROM ({SEQUENCE_SQL})"))
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS test_name, '{t}' AS table_name, '{c}' AS column_name, "
        f"'{kind}' AS test_kind, n AS failures, CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS status "
        f"FROM (SELECT CAST(({count}) AS BIGINT) AS n)"
        for name, t, c, kind, count in tests if kinds is None or kind in kinds)


_REV = "CAST(total_price AS DECIMAL(18,2))"
_PRODUCT_SALES = f"""(SELECT product_id, CAST(sum({_REV}) AS DOUBLE) AS revenue,
        CAST(sum(quantity) AS BIGINT) AS quantity FROM fact_order_items GROUP BY product_id)"""
_SELLER_SALES = f"""(SELECT seller_id, CAST(sum({_REV}) AS DOUBLE) AS revenue,
        CAST(sum(quantity) AS BIGINT) AS quantity FROM fact_order_items GROUP BY seller_id)"""
_TOTAL = f"(SELECT CAST(sum({_REV}) AS DOUBLE) FROM fact_order_items)"


def _place_sql(keys: str) -> str:
    cols = ", ".join(f"c.{k}" for k in keys.split(", "))
    return f"""
SELECT {cols}, CAST(sum(CAST(i.total_price AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       count(DISTINCT i.order_id) AS orders, count(DISTINCT c.customer_id) AS customers
FROM fact_order_items i JOIN fact_orders o ON i.order_id = o.order_id
JOIN dim_customers c ON o.customer_id = c.customer_id
GROUP BY {cols}"""


def _top_sql(sales: str, key: str, by: str, dim: str, attrs: str) -> str:
    return f"""
SELECT t.{key}, {attrs}, t.revenue, t.quantity
FROM (SELECT * FROM {sales} ORDER BY {by} DESC NULLS LAST, {key} ASC NULLS LAST LIMIT 10) t
LEFT JOIN {dim} d ON t.{key} = d.{key}"""


METRICS_SQL = {
    "total_revenue": f"SELECT CAST(sum({_REV}) AS DOUBLE) AS total_revenue FROM fact_order_items",
    "total_customers": "SELECT count(DISTINCT customer_id) AS total_customers FROM fact_orders",
    "total_orders": "SELECT count(DISTINCT order_id) AS total_orders FROM fact_orders",
    "average_order_value": f"""
SELECT CAST(sum({_REV}) AS DOUBLE) / CAST(count(DISTINCT order_id) AS DOUBLE) AS average_order_value,
       count(DISTINCT order_id) AS orders_with_items
FROM fact_order_items""",
    "sales_overview": f"""
SELECT {_TOTAL} AS total_revenue,
       count(DISTINCT customer_id) AS total_customers,
       count(DISTINCT order_id) AS total_orders,
       {_TOTAL} / CAST((SELECT count(DISTINCT order_id) FROM fact_order_items) AS DOUBLE) AS average_order_value
FROM fact_orders""",
    "monthly_revenue_growth": f"""
SELECT year, month, CAST(revenue AS DOUBLE) AS revenue, orders,
       CAST(lag(revenue) OVER (ORDER BY year, month) AS DOUBLE) AS prev_revenue,
       (CAST(revenue AS DOUBLE) - CAST(lag(revenue) OVER (ORDER BY year, month) AS DOUBLE))
         / CAST(lag(revenue) OVER (ORDER BY year, month) AS DOUBLE) AS growth
FROM (SELECT d.year, d.month, sum(po.revenue) AS revenue, count(*) AS orders
      FROM (SELECT order_id, sum({_REV}) AS revenue FROM fact_order_items GROUP BY order_id) po
      JOIN fact_orders o ON po.order_id = o.order_id
      JOIN dim_date d ON o.purchase_date_id = d.date_id
      GROUP BY d.year, d.month)""",
    "top_cities": _place_sql("city, state")
    + "\nORDER BY revenue DESC NULLS LAST, city ASC NULLS LAST, state ASC NULLS LAST LIMIT 10",
    "segments_by_state": _place_sql("state"),
    "segments_by_city": _place_sql("state, city"),
    "top_categories": f"""
SELECT p.category_name, CAST(sum(CAST(i.total_price AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST(sum(i.quantity) AS BIGINT) AS quantity
FROM fact_order_items i JOIN dim_products p ON i.product_id = p.product_id
GROUP BY p.category_name
ORDER BY revenue DESC NULLS LAST, category_name ASC NULLS LAST LIMIT 10""",
    "top_products_by_revenue": _top_sql(_PRODUCT_SALES, "product_id", "revenue", "dim_products",
                                        "d.category_name"),
    "top_products_by_quantity": _top_sql(_PRODUCT_SALES, "product_id", "quantity", "dim_products",
                                         "d.category_name"),
    "top_sellers_by_revenue": _top_sql(_SELLER_SALES, "seller_id", "revenue", "dim_sellers",
                                       "d.city, d.state"),
    "top_sellers_by_quantity": _top_sql(_SELLER_SALES, "seller_id", "quantity", "dim_sellers",
                                        "d.city, d.state"),
    "high_performers": f"""
SELECT kind, id, revenue, quantity, CAST(rank AS INTEGER) AS rank, revenue / {_TOTAL} AS revenue_share
FROM (SELECT 'product' AS kind, product_id AS id, revenue, quantity,
             row_number() OVER (ORDER BY revenue DESC NULLS LAST, product_id ASC NULLS LAST) AS rank
      FROM {_PRODUCT_SALES}
      UNION ALL
      SELECT 'seller', seller_id, revenue, quantity,
             row_number() OVER (ORDER BY revenue DESC NULLS LAST, seller_id ASC NULLS LAST)
      FROM {_SELLER_SALES})
WHERE rank <= 10""",
    "product_contribution": f"""
SELECT product_id, revenue, quantity, revenue / {_TOTAL} AS revenue_share FROM {_PRODUCT_SALES}""",
    "product_pareto": f"""
SELECT product_id, CAST(revenue AS DOUBLE) AS revenue, quantity,
       CAST(revenue AS DOUBLE) / CAST(total AS DOUBLE) AS revenue_share,
       CAST(sum(revenue) OVER (ORDER BY revenue DESC NULLS LAST, product_id ASC NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
         / CAST(total AS DOUBLE) AS cumulative_share
FROM (SELECT product_id, sum({_REV}) AS revenue, CAST(sum(quantity) AS BIGINT) AS quantity
      FROM fact_order_items GROUP BY product_id),
     (SELECT sum({_REV}) AS total FROM fact_order_items)""",
    "sales_by_quantity": f"""
SELECT quantity, count(*) AS lines, count(DISTINCT order_id) AS orders,
       CAST(sum({_REV}) AS DOUBLE) AS revenue
FROM fact_order_items GROUP BY quantity""",
    "customer_cohorts": """
SELECT CAST(floor(f.first_m / 12) * 100 + f.first_m % 12 + 1 AS INTEGER) AS cohort_month,
       CAST(cm.m - f.first_m AS INTEGER) AS months_since, count(*) AS customers
FROM (SELECT DISTINCT o.customer_id, d.year * 12 + d.month - 1 AS m
      FROM fact_orders o JOIN dim_date d ON o.purchase_date_id = d.date_id
      WHERE o.customer_id IS NOT NULL) cm
JOIN (SELECT customer_id, min(year * 12 + month - 1) AS first_m
      FROM fact_orders o JOIN dim_date d ON o.purchase_date_id = d.date_id
      WHERE o.customer_id IS NOT NULL GROUP BY customer_id) f
  ON cm.customer_id = f.customer_id
GROUP BY 1, 2""",
}


def _q(name: str, table: str, column: str, where: str) -> str:
    n = f"(SELECT count(*) FROM {table} WHERE {where})"
    return (f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST({n} AS BIGINT) AS failures, CASE WHEN {n} = 0 THEN 'pass' ELSE 'fail' END AS status")


_LOST = ("((SELECT count(DISTINCT order_id) FROM stg_orders) - "
         "(SELECT count(DISTINCT order_id) FROM fact_orders))")

QUALITY_SQL = "\nUNION ALL\n".join([
    f"SELECT 'row_count_drift_fact_orders' AS check_name, 'fact_orders' AS table_name, "
    f"'order_id' AS column_name, CAST({_LOST} AS BIGINT) AS failures, "
    f"CASE WHEN {_LOST} / (SELECT count(DISTINCT order_id) FROM stg_orders) > 0.05 "
    f"THEN 'fail' ELSE 'pass' END AS status",
    _q("accepted_values_fact_orders_status", "fact_orders", "status",
       "status IS NOT NULL AND status NOT IN ('approved', 'canceled', 'created', 'delivered', "
       "'invoiced', 'processing', 'shipped', 'unavailable')"),
    _q("non_negative_fact_orders_total_order_amount", "fact_orders", "total_order_amount",
       "total_order_amount < 0"),
    _q("non_negative_fact_order_items_total_price", "fact_order_items", "total_price", "total_price < 0"),
    _q("non_negative_fact_order_items_total_freight", "fact_order_items", "total_freight",
       "total_freight < 0"),
    _q("positive_fact_order_items_quantity", "fact_order_items", "quantity", "quantity < 1"),
])
