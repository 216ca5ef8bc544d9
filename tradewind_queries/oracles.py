"""The queries as DuckDB SQL: the test-table bindings, the clean layer and the commerce table as
shared CTEs, and one SELECT per query."""

from __future__ import annotations

BINDINGS = """
b_ship AS (
  SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
    CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR END AS order_approved_at,
    CAST(first_ship AS TIMESTAMP) AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'P' THEN NULL
         ELSE CAST(last_ship AS TIMESTAMP) + INTERVAL 12 HOUR END AS order_delivered_customer_date,
    CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1000 DAY AS order_estimated_delivery_date
  FROM orders LEFT JOIN b_ship ON o_orderkey = l_orderkey),
b_order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    l_suppkey AS seller_id, CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date,
    l_extendedprice AS price, l_quantity - 5 AS freight_value
  FROM lineitem),
b_order_payments AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'boleto' WHEN '2-HIGH' THEN 'credit_card'
      WHEN '3-MEDIUM' THEN 'voucher' WHEN '4-NOT SPECIFIED' THEN 'not_defined'
      ELSE 'debit_card' END AS payment_type,
    CAST(1 + o_orderkey % 12 AS INT) AS payment_installments, o_totalprice AS payment_value
  FROM orders
  UNION ALL
  SELECT o_orderkey, 2, CASE WHEN o_orderkey % 2 = 0 THEN 'voucher' END, 1, 10.5
  FROM orders WHERE o_orderkey % 5 = 0),
b_order_reviews AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN event_id % 10 = 1 THEN event_id - 1 ELSE event_id END AS review_id,
    event_id AS order_id, CAST(1 + event_id % 5 AS INT) AS review_score,
    event_type AS review_comment_title, props AS review_comment_message,
    CAST(ts AS TIMESTAMP) AS review_creation_date,
    CAST(ts AS TIMESTAMP) + INTERVAL 2 DAY AS review_answer_timestamp
  FROM events),
b_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
    c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city,
    n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
b_sellers AS (
  SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix,
    CASE s_suppkey % 5 WHEN 0 THEN ' São Paulo - SP ' WHEN 1 THEN 'SAO MIGUEL'
      WHEN 2 THEN 'Florianópolis' ELSE s_name END AS seller_city,
    n_name AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
b_products AS (
  SELECT p_partkey AS product_id,
    CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS product_category_name,
    CAST(LENGTH(p_name) AS INT) AS product_name_lenght,
    CAST(LENGTH(p_brand) AS INT) AS product_description_lenght,
    CAST(p_partkey % 5 AS INT) AS product_photos_qty,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS product_weight_g,
    p_retailprice - 900 AS product_length_cm,
    CAST(p_size % 7 AS DOUBLE) AS product_height_cm,
    CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(1 + p_size % 3 AS DOUBLE) END AS product_width_cm
  FROM part),
b_geolocation AS (
  SELECT s_nationkey AS geolocation_zip_code_prefix, s_acctbal / 100 AS geolocation_lat,
    s_acctbal / 40 AS geolocation_lng,
    CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_name END AS geolocation_city,
    r_name AS geolocation_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  WHERE s_nationkey <> 7),
b_translation AS (
  SELECT DISTINCT p_type AS product_category_name, LOWER(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'),
b_wide AS (
  SELECT o.*, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price, i.freight_value,
    p.payment_sequential, p.payment_type, p.payment_installments, p.payment_value,
    r.review_id, r.review_score, r.review_comment_title, r.review_comment_message,
    r.review_creation_date, r.review_answer_timestamp,
    c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
    s.seller_zip_code_prefix, s.seller_city, s.seller_state,
    d.product_category_name, d.product_name_lenght, d.product_description_lenght,
    d.product_photos_qty, d.product_weight_g, d.product_length_cm, d.product_height_cm, d.product_width_cm,
    t.product_category_name_english
  FROM b_orders o
  LEFT JOIN b_order_items i ON o.order_id = i.order_id
  LEFT JOIN b_order_payments p ON o.order_id = p.order_id
  LEFT JOIN b_order_reviews r ON o.order_id = r.order_id
  LEFT JOIN b_products d ON i.product_id = d.product_id
  LEFT JOIN b_translation t ON d.product_category_name = t.product_category_name
  LEFT JOIN b_sellers s ON i.seller_id = s.seller_id
  JOIN b_customers c ON o.customer_id = c.customer_id)
"""

# The clean layer. Row numbers put NULL first, as Spark does.
CLEAN = """
c_orders AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST, order_status NULLS FIRST,
      order_purchase_timestamp NULLS FIRST, order_approved_at NULLS FIRST, order_delivered_carrier_date NULLS FIRST,
      order_delivered_customer_date NULLS FIRST, order_estimated_delivery_date NULLS FIRST) AS rn
    FROM b_orders
    WHERE NOT COALESCE(order_approved_at < order_purchase_timestamp
      OR order_delivered_carrier_date < order_approved_at
      OR order_delivered_customer_date < order_delivered_carrier_date
      OR order_estimated_delivery_date < order_purchase_timestamp, FALSE))
  WHERE rn = 1),
c_items AS (
  SELECT * RENAME (shipping_limit_date AS shipping_deadline) FROM b_order_items
  WHERE price > 0 AND freight_value >= 0),
c_payments AS (
  SELECT * REPLACE (CASE WHEN payment_type = 'boleto' THEN 'bank_slip' ELSE payment_type END AS payment_type)
  FROM b_order_payments WHERE payment_type <> 'not_defined'),
c_reviews AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY order_id NULLS FIRST, review_score NULLS FIRST,
      review_comment_title NULLS FIRST, review_comment_message NULLS FIRST, review_creation_date NULLS FIRST,
      review_answer_timestamp NULLS FIRST) AS rn
    FROM b_order_reviews WHERE review_id IS NOT NULL)
  WHERE rn = 1),
p0 AS (
  SELECT product_id, product_category_name, CAST(product_name_lenght AS DOUBLE) AS product_name_length,
    CAST(product_description_lenght AS DOUBLE) AS product_description_length, product_photos_qty,
    product_weight_g, product_length_cm, product_height_cm, product_width_cm
  FROM b_products WHERE product_category_name IS NOT NULL),
p1 AS (
  SELECT * REPLACE (COALESCE(product_weight_g, (SELECT quantile_disc(product_weight_g, 0.5) FROM p0)) AS product_weight_g)
  FROM p0),
p2 AS (
  SELECT * REPLACE (COALESCE(product_length_cm, (SELECT quantile_disc(product_length_cm, 0.5) FROM p1 WHERE product_weight_g > 0)) AS product_length_cm)
  FROM p1 WHERE product_weight_g > 0),
p3 AS (
  SELECT * REPLACE (COALESCE(product_height_cm, (SELECT quantile_disc(product_height_cm, 0.5) FROM p2 WHERE product_length_cm > 0)) AS product_height_cm)
  FROM p2 WHERE product_length_cm > 0),
p4 AS (
  SELECT * REPLACE (COALESCE(product_width_cm, (SELECT quantile_disc(product_width_cm, 0.5) FROM p3 WHERE product_height_cm > 0)) AS product_width_cm)
  FROM p3 WHERE product_height_cm > 0),
c_products AS (SELECT * FROM p4 WHERE product_width_cm > 0),
c_translation AS (
  SELECT product_category_name, MIN(product_category_name_english) AS product_category_name_english
  FROM b_translation GROUP BY 1
  UNION ALL
  SELECT * FROM (VALUES
    ('portateis_cozinha_e_preparadores_de_alimentos', 'portable_kitchen_and_food_preparers'),
    ('pc_gamer', 'pc_gamer')) AS extra(k, v)
  WHERE k NOT IN (SELECT product_category_name FROM b_translation WHERE product_category_name IS NOT NULL)),
s0 AS (
  SELECT * EXCLUDE (rn) REPLACE (strip_accents(lower(trim(seller_city))) AS seller_city) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix NULLS FIRST,
      seller_city NULLS FIRST, seller_state NULLS FIRST) AS rn
    FROM b_sellers WHERE seller_id IS NOT NULL)
  WHERE rn = 1),
s1 AS (
  SELECT * REPLACE (CASE WHEN contains(seller_city, 'sao miguel') THEN 'sao miguel d''oeste' ELSE seller_city END AS seller_city)
  FROM s0),
c_sellers AS (
  SELECT * REPLACE (CASE WHEN contains(seller_city, 'sao pau') THEN 'sao paulo' ELSE seller_city END AS seller_city)
  FROM s1),
c_customers AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
      customer_zip_code_prefix NULLS FIRST, customer_city NULLS FIRST, customer_state NULLS FIRST) AS rn
    FROM b_customers WHERE customer_id IS NOT NULL)
  WHERE rn = 1),
c_geo AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY geolocation_zip_code_prefix, geolocation_lat, geolocation_lng
      ORDER BY geolocation_city NULLS FIRST, geolocation_state NULLS FIRST) AS rn
    FROM b_geolocation)
  WHERE rn = 1 AND geolocation_lat BETWEEN -90 AND 90 AND geolocation_lng BETWEEN -180 AND 180)
"""

_ZIP_ORDER = (
    "PARTITION BY geolocation_zip_code_prefix ORDER BY geolocation_lat NULLS FIRST, geolocation_lng NULLS FIRST, "
    "geolocation_city NULLS FIRST, geolocation_state NULLS FIRST "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
)

WRANGLE = f"""
geo_zip AS (
  SELECT DISTINCT geolocation_zip_code_prefix,
    FIRST_VALUE(geolocation_lat IGNORE NULLS) OVER w AS geolocation_lat,
    FIRST_VALUE(geolocation_lng IGNORE NULLS) OVER w AS geolocation_lng,
    FIRST_VALUE(geolocation_city IGNORE NULLS) OVER w AS geolocation_city,
    FIRST_VALUE(geolocation_state IGNORE NULLS) OVER w AS geolocation_state
  FROM c_geo WINDOW w AS ({_ZIP_ORDER})),
cust_geo AS (
  SELECT * FROM c_customers LEFT JOIN geo_zip ON customer_zip_code_prefix = geolocation_zip_code_prefix),
cust_geo_raw AS (
  SELECT * FROM c_customers LEFT JOIN c_geo ON customer_zip_code_prefix = geolocation_zip_code_prefix),
orders_all AS (
  SELECT * FROM c_orders
  LEFT JOIN c_items USING (order_id)
  LEFT JOIN c_payments USING (order_id)
  LEFT JOIN c_reviews USING (order_id)
  LEFT JOIN c_products USING (product_id)
  LEFT JOIN c_translation USING (product_category_name)
  LEFT JOIN c_sellers USING (seller_id)),
commerce AS (
  SELECT * EXCLUDE (customer_id, customer_unique_id, order_id, order_item_id, product_id, review_id, product_category_name)
  FROM (SELECT DISTINCT * FROM cust_geo JOIN orders_all USING (customer_id)))
"""

REPORTS = """
order_status_distribution AS (
  SELECT order_status, COUNT(*) AS total_orders FROM commerce GROUP BY 1),
monthly_orders_revenue AS (
  SELECT CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS month,
    COUNT(DISTINCT order_status) AS total_orders,
    CAST(SUM(CAST(price AS DECIMAL(28,6))) AS DOUBLE) AS total_revenue
  FROM commerce WHERE price IS NOT NULL GROUP BY 1),
top_states_by_order_count AS (
  SELECT customer_state, COUNT(DISTINCT order_status) AS total_orders
  FROM commerce WHERE customer_state IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10),
payment_type_distribution AS (
  SELECT payment_type, COUNT(*) AS transactions,
    CAST(SUM(CAST(payment_value AS DECIMAL(28,6))) AS DOUBLE) AS total_value
  FROM commerce GROUP BY 1),
installments_distribution AS (
  SELECT payment_installments, COUNT(*) AS num_orders FROM commerce GROUP BY 1),
orders_per_customer AS (
  SELECT customer_zip_code_prefix AS customer_area, COUNT(DISTINCT order_status) AS num_orders
  FROM commerce GROUP BY 1),
customers_by_state AS (
  SELECT customer_state, COUNT(DISTINCT customer_zip_code_prefix) AS num_customers
  FROM commerce WHERE customer_state IS NOT NULL GROUP BY 1),
top_categories_by_sales AS (
  SELECT product_category_name_english AS category,
    CAST(SUM(CAST(price AS DECIMAL(28,6))) AS DOUBLE) AS total_sales,
    COUNT(DISTINCT order_status) AS num_orders
  FROM commerce WHERE product_category_name_english IS NOT NULL AND price IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15),
product_price_distribution AS (
  SELECT quantile_disc(price, 0.25) AS p25, quantile_disc(price, 0.5) AS median, quantile_disc(price, 0.75) AS p75,
    CAST(SUM(CAST(price AS DECIMAL(28,6))) AS DOUBLE) / COUNT(price) AS avg_price
  FROM commerce),
review_score_distribution AS (
  SELECT review_score, COUNT(*) AS num_reviews FROM commerce WHERE review_score IS NOT NULL GROUP BY 1),
delivery_delay_distribution AS (
  SELECT date_sub('day', order_estimated_delivery_date, order_delivered_customer_date) AS delay_days, COUNT(*) AS num_orders
  FROM commerce WHERE order_delivered_customer_date IS NOT NULL GROUP BY 1),
shipping_time_distribution AS (
  SELECT date_sub('day', order_purchase_timestamp, order_delivered_customer_date) AS shipping_days, COUNT(*) AS num_orders
  FROM commerce WHERE order_delivered_customer_date IS NOT NULL GROUP BY 1),
carrier_time_distribution AS (
  SELECT date_sub('day', order_purchase_timestamp, order_delivered_carrier_date) AS carrier_days, COUNT(*) AS num_orders
  FROM commerce WHERE order_delivered_carrier_date IS NOT NULL GROUP BY 1)
"""

FEATURES = """
extract AS (
  SELECT customer_state, seller_state, price, freight_value, product_weight_g, product_category_name_english,
    order_delivered_customer_date, order_estimated_delivery_date
  FROM commerce WHERE order_delivered_customer_date IS NOT NULL),
late AS (
  SELECT *, CAST(FLOOR((epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date))
      / 86400000000.0) AS BIGINT) AS d
  FROM extract),
base AS (
  SELECT price, freight_value, product_weight_g, customer_state, seller_state, product_category_name_english,
    CAST(COALESCE(d > 0, FALSE) AS INTEGER) AS is_late
  FROM late
  WHERE price IS NOT NULL AND freight_value IS NOT NULL AND product_weight_g IS NOT NULL
    AND customer_state IS NOT NULL AND seller_state IS NOT NULL AND product_category_name_english IS NOT NULL),
enhanced AS (
  SELECT price, freight_value, product_weight_g, customer_state, seller_state, product_category_name_english,
    CAST(COALESCE(d, 0) > 0 AS INTEGER) AS is_late, COALESCE(d, 0) AS delay_days
  FROM late
  WHERE price IS NOT NULL AND freight_value IS NOT NULL AND product_weight_g IS NOT NULL
    AND customer_state IS NOT NULL AND seller_state IS NOT NULL AND product_category_name_english IS NOT NULL),
coded AS (
  SELECT * REPLACE (
    CAST(DENSE_RANK() OVER (ORDER BY customer_state) - 1 AS INTEGER) AS customer_state,
    CAST(DENSE_RANK() OVER (ORDER BY seller_state) - 1 AS INTEGER) AS seller_state,
    CAST(DENSE_RANK() OVER (ORDER BY product_category_name_english) - 1 AS INTEGER) AS product_category_name_english)
  FROM base),
coded_enhanced AS (
  SELECT * REPLACE (
    CAST(DENSE_RANK() OVER (ORDER BY customer_state) - 1 AS INTEGER) AS customer_state,
    CAST(DENSE_RANK() OVER (ORDER BY seller_state) - 1 AS INTEGER) AS seller_state,
    CAST(DENSE_RANK() OVER (ORDER BY product_category_name_english) - 1 AS INTEGER) AS product_category_name_english)
  FROM enhanced)
"""

SCORED = """
scored AS (
  SELECT quality AS label, n_chars AS score, CAST(n_chars > 1000 AS INTEGER) AS pred
  FROM labels JOIN documents USING (doc_id)),
cells AS (
  SELECT COUNT(*) FILTER (label = 1 AND pred = 1) AS tp, COUNT(*) FILTER (label <> 1 AND pred = 1) AS fp,
    COUNT(*) FILTER (label = 1 AND pred <> 1) AS fn, COUNT(*) FILTER (label <> 1 AND pred <> 1) AS tn
  FROM scored),
per_score AS (
  SELECT CAST(score AS DOUBLE) AS s, COUNT(*) FILTER (label = 1) AS p, COUNT(*) FILTER (label <> 1) AS n
  FROM scored GROUP BY 1)
"""


def _domain(select: str) -> str:
    return f"WITH {BINDINGS.strip()} {select}"


def _clean(select: str) -> str:
    return f"WITH {BINDINGS.strip()}, {CLEAN.strip()} {select}"


def _wrangled(select: str) -> str:
    return f"WITH {BINDINGS.strip()}, {CLEAN.strip()}, {WRANGLE.strip()} {select}"


def _reported(select: str) -> str:
    return f"WITH {BINDINGS.strip()}, {CLEAN.strip()}, {WRANGLE.strip()}, {REPORTS.strip()} {select}"


def _featured(select: str) -> str:
    return f"WITH {BINDINGS.strip()}, {CLEAN.strip()}, {WRANGLE.strip()}, {FEATURES.strip()} {select}"


def _train_rows(select: str) -> str:
    return _featured(
        f", train AS (SELECT CAST(SUM(t) AS BIGINT) AS train_rows, CAST(SUM(c - t) AS BIGINT) AS test_rows "
        f"FROM (SELECT COUNT(*) AS c, CAST(ROUND(0.8 * COUNT(*)) AS BIGINT) AS t FROM enhanced GROUP BY is_late)) {select}"
    )


def _scored(select: str) -> str:
    return f"WITH {SCORED.strip()} {select}"


# Domain table → (view over the test tables, columns with their Spark types).
DOMAIN = {
    "orders": ("b_orders", "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp, order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"),
    "order_items": ("b_order_items", "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, shipping_limit_date timestamp, price double, freight_value double"),
    "order_payments": ("b_order_payments", "order_id bigint, payment_sequential int, payment_type string, payment_installments int, payment_value double"),
    "order_reviews": ("b_order_reviews", "review_id bigint, order_id bigint, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"),
    "customers": ("b_customers", "customer_id bigint, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string"),
    "sellers": ("b_sellers", "seller_id bigint, seller_zip_code_prefix int, seller_city string, seller_state string"),
    "products": ("b_products", "product_id bigint, product_category_name string, product_name_lenght int, product_description_lenght int, product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double"),
    "geolocation": ("b_geolocation", "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string"),
    "product_category_name_translation": ("b_translation", "product_category_name string, product_category_name_english string"),
}


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in DOMAIN[table][1].split(", ")]


def _names(table: str) -> str:
    return ", ".join(c for c, _ in _columns(table))


def _profile_row_counts() -> str:
    parts = [f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {v}" for t, (v, _) in DOMAIN.items()]
    return _domain(" UNION ALL ".join(parts))


def _profile_schema() -> str:
    parts = []
    for table, (view, _) in DOMAIN.items():
        rows = ", ".join(f"({i + 1}, '{c}', '{t}')" for i, (c, t) in enumerate(_columns(table)))
        parts.append(
            f"SELECT '{table}' AS table_name, position, column_name, column_type, "
            f"(SELECT COUNT(*) FROM {view}) AS row_count FROM (VALUES {rows}) AS v(position, column_name, column_type)"
        )
    return _domain(" UNION ALL ".join(parts))


def _profile_tables() -> str:
    known = {
        "orders": "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string",
        "lineitem": "l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double,l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz",
        "customer": "c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string",
        "region": "r_regionkey:int,r_name:string",
        "nation": "n_nationkey:int,n_name:string,n_regionkey:int",
        "supplier": "s_suppkey:bigint,s_name:string,s_nationkey:int,s_acctbal:double",
        "part": "p_partkey:bigint,p_name:string,p_brand:string,p_type:string,p_size:int,p_retailprice:double",
        "events": "event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string",
        "documents": "doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint",
        "labels": "doc_id:bigint,quality:int,toxic:int",
        "embeddings": "vec_id:bigint,embedding:array<float>,label:int",
        "pages": "page_id:bigint,url:string,html:string",
        "benchmark": "item_id:bigint,text:string",
        "conversations": "conv_id:bigint,turn:bigint,role:string,text:string",
    }
    parts = [
        f"SELECT '{t}.parquet' AS table_name, 'ok' AS status, COUNT(*) AS row_count, "
        f"CAST({len(c.split(','))} AS INTEGER) AS column_count, 'struct<{c}>' AS columns FROM {t}"
        for t, c in known.items()
    ]
    parts.append("SELECT 'absent.parquet', 'missing', NULL, NULL, NULL")
    return " UNION ALL ".join(parts)


_TIMES = ("order_purchase_timestamp", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date")
_IMPOSSIBLE = (
    "order_approved_at < order_purchase_timestamp OR order_delivered_carrier_date < order_approved_at "
    "OR order_delivered_customer_date < order_delivered_carrier_date OR order_estimated_delivery_date < order_purchase_timestamp"
)
_GEO = ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state")


def _forward_fill() -> str:
    filled = ", ".join(f"LAST_VALUE({c} IGNORE NULLS) OVER w AS {c}" for c in _GEO)
    return _wrangled(
        f"SELECT * EXCLUDE ({', '.join(_GEO)}), {filled} FROM cust_geo_raw WINDOW w AS (PARTITION BY customer_zip_code_prefix "
        "ORDER BY customer_id NULLS FIRST, geolocation_lat NULLS FIRST, geolocation_lng NULLS FIRST "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


def _chart_series() -> str:
    spec = [
        ("order_status_distribution", "order_status", {"orders": "total_orders"}),
        ("monthly_orders_revenue", "strftime(month, '%Y-%m-%d')", {"orders": "total_orders", "revenue": "total_revenue"}),
        ("payment_type_distribution", "payment_type", {"value": "total_value"}),
        ("installments_distribution", "COALESCE(payment_installments, 0)", {"orders": "num_orders"}),
        ("customers_by_state", "customer_state", {"customers": "num_customers"}),
        ("top_categories_by_sales", "category", {"sales": "total_sales"}),
        ("review_score_distribution", "COALESCE(review_score, 0)", {"reviews": "num_reviews"}),
        ("delivery_delay_distribution", "COALESCE(delay_days, 0)", {"orders": "num_orders"}),
        ("shipping_time_distribution", "COALESCE(shipping_days, 0)", {"orders": "num_orders"}),
    ]
    return _reported(
        " UNION ALL ".join(
            f"SELECT '{name}' AS chart, CAST({x} AS VARCHAR) AS x, '{series}' AS series, "
            f"COALESCE(CAST({y} AS DOUBLE), 0) AS y FROM {name}"
            for name, x, values in spec
            for series, y in values.items()
        )
    )


_NUMBERS = ("price", "freight_value", "product_weight_g")
_CODED = _NUMBERS + ("customer_state", "seller_state", "product_category_name_english")


def _standardize() -> str:
    scaled = ", ".join(
        f"ROUND(COALESCE(({c} - AVG({c}) OVER ()) / NULLIF(STDDEV_POP({c}) OVER (), 0), 0), 4) + 0.0 AS {c}" for c in _CODED
    )
    return _featured(f"SELECT {scaled}, is_late FROM coded")


def _correlation_pairs() -> str:
    columns = sorted(_CODED + ("is_late", "delay_days"))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    return _featured(
        " UNION ALL ".join(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND(CORR({a}, {b}), 6) + 0.0 AS correlation FROM coded_enhanced"
            for a, b in pairs
        )
    )


def _clean_row_counts() -> str:
    cleaned = {
        "orders": "c_orders", "order_items": "c_items", "order_payments": "c_payments", "order_reviews": "c_reviews", "customers": "c_customers",
        "sellers": "c_sellers", "products": "c_products", "geolocation": "c_geo", "product_category_name_translation": "c_translation",
    }
    count = "(SELECT COUNT(*) FROM {})".format
    rows = [f"SELECT '{t}' AS table_name, {count(DOMAIN[t][0])} AS rows_in, {count(c)} AS rows_out" for t, c in cleaned.items()]
    return _clean(f"SELECT table_name, rows_in, rows_in - rows_out AS rows_removed, rows_out FROM ({' UNION ALL '.join(rows)})")


def _normalized(view: str, columns: str) -> str:
    return _domain(f"SELECT DISTINCT {columns} FROM {view}")


_REPORT_NAMES = (
    "order_status_distribution",
    "monthly_orders_revenue",
    "top_states_by_order_count",
    "payment_type_distribution",
    "installments_distribution",
    "orders_per_customer",
    "customers_by_state",
    "top_categories_by_sales",
    "product_price_distribution",
    "review_score_distribution",
    "delivery_delay_distribution",
    "shipping_time_distribution",
    "carrier_time_distribution",
)

ORACLES: dict[str, str] = {
    "profile_row_counts": _profile_row_counts(),
    "profile_schema": _profile_schema(),
    "profile_sample": _domain("SELECT * FROM b_orders ORDER BY order_id LIMIT 10"),
    "profile_tables": _profile_tables(),
    "dedupe_removed_count": _domain(
        "SELECT COUNT(*) AS rows_before, COUNT(DISTINCT review_id) AS rows_after, "
        "COUNT(*) - COUNT(DISTINCT review_id) AS rows_removed FROM b_order_reviews WHERE review_id IS NOT NULL"
    ),
    "normalize_orders": _normalized("b_wide", _names("orders")),
    "normalize_items": _normalized("b_wide", _names("order_items")),
    "normalize_payments": _normalized("b_wide", _names("order_payments")),
    "normalize_reviews": _normalized("b_wide", _names("order_reviews")),
    "normalize_customers": _normalized("b_wide", _names("customers")),
    "normalize_sellers": _normalized("b_wide", _names("sellers")),
    "normalize_products": _normalized("b_wide", _names("products")),
    "normalize_translation": _normalized("b_wide", _names("product_category_name_translation")),
    "normalize_geolocation": _domain(
        f"SELECT DISTINCT {_names('geolocation')} FROM b_customers "
        "LEFT JOIN b_geolocation ON customer_zip_code_prefix = geolocation_zip_code_prefix"
    ),
    "normalize_parse_timestamps": _domain(
        "SELECT DISTINCT order_id, customer_id, order_status, "
        + ", ".join(f"CAST(date_trunc('minute', {c}) AS TIMESTAMP) AS {c}" for c in _TIMES)
        + ", strftime(order_approved_at, '%-m/%-d/%Y %-H:%M') AS order_approved_at FROM b_orders"
    ),
    "clean_orders": _clean("SELECT * FROM c_orders"),
    "clean_items": _clean("SELECT * FROM c_items"),
    "clean_payments": _clean("SELECT * FROM c_payments"),
    "clean_reviews": _clean("SELECT * FROM c_reviews"),
    "clean_products": _clean("SELECT * FROM c_products"),
    "translation_backfill": _clean("SELECT * FROM c_translation"),
    "clean_sellers": _clean("SELECT * FROM c_sellers"),
    "clean_customers": _clean("SELECT * FROM c_customers"),
    "clean_geolocation": _clean("SELECT * FROM c_geo"),
    "invalid_timeline_rows": _domain(f"SELECT * FROM b_orders WHERE {_IMPOSSIBLE}"),
    "distinct_rows": _domain("SELECT DISTINCT * FROM b_order_items"),
    "dedupe_by_key": _domain(
        "SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id "
        "ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_date NULLS FIRST, "
        "price NULLS FIRST, freight_value NULLS FIRST) AS rn FROM b_order_items) WHERE rn = 1"
    ),
    "except_invalid": _domain(f"SELECT * FROM b_orders EXCEPT SELECT * FROM b_orders WHERE {_IMPOSSIBLE}"),
    "customers_geo_raw": _wrangled("SELECT * FROM cust_geo_raw"),
    "customers_geo": _wrangled("SELECT * FROM cust_geo"),
    "forward_fill_geo": _forward_fill(),
    "orders_items": _clean("SELECT * FROM c_orders LEFT JOIN c_items USING (order_id)"),
    "orders_payments_reviews": _clean(
        "SELECT * FROM c_orders LEFT JOIN c_payments USING (order_id) LEFT JOIN c_reviews USING (order_id)"
    ),
    "orders_all": _wrangled("SELECT * FROM orders_all"),
    "commerce": _wrangled("SELECT * FROM commerce"),
    **{name: _reported(f"SELECT * FROM {name}") for name in _REPORT_NAMES},
    "median_impute": _domain(
        ", q0 AS (SELECT product_id, product_weight_g AS a, product_length_cm AS b, product_height_cm AS c, product_width_cm AS d FROM b_products), "
        "q1 AS (SELECT * REPLACE (COALESCE(a, (SELECT quantile_disc(a, 0.5) FROM q0)) AS a) FROM q0), "
        "q2 AS (SELECT * REPLACE (COALESCE(b, (SELECT quantile_disc(b, 0.5) FROM q1 WHERE a > 0)) AS b) FROM q1 WHERE a > 0), "
        "q3 AS (SELECT * REPLACE (COALESCE(c, (SELECT quantile_disc(c, 0.5) FROM q2 WHERE b > 0)) AS c) FROM q2 WHERE b > 0), "
        "q4 AS (SELECT * REPLACE (COALESCE(d, (SELECT quantile_disc(d, 0.5) FROM q3 WHERE c > 0)) AS d) FROM q3 WHERE c > 0) "
        "SELECT product_id, a AS product_weight_g, b AS product_length_cm, c AS product_height_cm, d AS product_width_cm FROM q4 WHERE d > 0"
    ),
    "eda_kpis": _reported(
        "SELECT (SELECT CAST(SUM(total_orders) AS BIGINT) FROM order_status_distribution) AS total_orders, "
        "(SELECT CAST(SUM(CAST(total_revenue AS DECIMAL(28,6))) AS DOUBLE) FROM monthly_orders_revenue) AS total_revenue, "
        "(SELECT ROUND(CAST(SUM(review_score * num_reviews) AS DOUBLE) / GREATEST(1, SUM(num_reviews)), 6) FROM review_score_distribution) AS avg_review_score, "
        "(SELECT ROUND(CAST(SUM(COALESCE(delay_days, 0) * num_orders) AS DOUBLE) / SUM(num_orders), 6) FROM delivery_delay_distribution) AS avg_delivery_delay_days"
    ),
    "eda_chart_series": _chart_series(),
    "catalog_sql_smoke": _reported("SELECT * FROM order_status_distribution"),
    "epoch_ms_to_ts": "SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts FROM events",
    "delay_days_floor": _domain(
        "SELECT order_id, CAST(FLOOR((epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date)) "
        "/ 86400000000.0) AS BIGINT) AS delay_days FROM b_orders"
    ),
    "is_late_flag": _domain(
        "SELECT order_id, CAST(COALESCE(FLOOR((epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date)) "
        "/ 86400000000.0) > 0, FALSE) AS INTEGER) AS is_late FROM b_orders"
    ),
    "missing_columns": _domain(
        "SELECT product_id, CAST(NULL AS DOUBLE) AS product_weight_g, product_length_cm, CAST(NULL AS INTEGER) AS shelf FROM b_products"
    ),
    "safe_numeric": (
        "WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN CAST(event_id AS VARCHAR) "
        "WHEN 2 THEN CAST(event_id AS VARCHAR) || '.75' ELSE '' END AS raw FROM events) "
        "SELECT event_id, raw, COALESCE(TRY_CAST(raw AS DOUBLE), 0) AS as_float, "
        "CAST(trunc(COALESCE(TRY_CAST(raw AS DOUBLE), 0)) AS BIGINT) AS as_int FROM t"
    ),
    "strip_accents": "SELECT doc_id, strip_accents(lower(text)) AS plain_text FROM documents",
    "ml_extract": _featured("SELECT * FROM extract"),
    "ml_features": _featured("SELECT * FROM base"),
    "ml_features_enhanced": _featured("SELECT * FROM enhanced"),
    "label_encode": _featured("SELECT * FROM coded"),
    "standardize": _standardize(),
    "stratified_split_counts": _featured(
        "SELECT is_late, split, CASE split WHEN 'train' THEN CAST(ROUND(0.8 * c) AS BIGINT) ELSE c - CAST(ROUND(0.8 * c) AS BIGINT) END AS n "
        "FROM (SELECT is_late, COUNT(*) AS c FROM base GROUP BY 1), (VALUES ('train'), ('test')) AS v(split)"
    ),
    "class_balance": _featured(
        "SELECT v.class, v.label, COUNT(is_late) AS n FROM (VALUES (0, 'On Time (0)'), (1, 'Late (1)')) AS v(class, label) "
        "LEFT JOIN enhanced ON is_late = v.class GROUP BY 1, 2"
    ),
    "correlation_pairs": _correlation_pairs(),
    "ml_kpis": _featured(
        "SELECT COUNT(*) AS samples, ROUND(CAST(SUM(is_late) AS DOUBLE) / COUNT(*) * 100, 6) AS late_pct, "
        "ROUND(CAST(SUM(delay_days) AS DOUBLE) / COUNT(*), 6) AS avg_delay_days FROM enhanced"
    ),
    # Facts that hold for any right fit; the fitted numbers themselves are beyond SQL.
    "ml_model_facts": _featured(
        "SELECT model, is_late AS actual, c - CAST(ROUND(0.8 * c) AS BIGINT) AS rows, 0.0::DOUBLE AS auc_gap "
        "FROM (SELECT is_late, COUNT(*) AS c FROM enhanced GROUP BY 1), "
        "(VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting')) AS v(model)"
    ),
    "ml_importance_facts": (
        "SELECT model, 6::BIGINT AS features, 1.0::DOUBLE AS total, 0::BIGINT AS negative "
        "FROM (VALUES ('Random Forest'), ('Gradient Boosting')) AS v(model)"
    ),
    "ml_logreg_calibration": _featured(
        "SELECT CAST(SUM(t) AS BIGINT) AS train_rows, ROUND(CAST(SUM(t) FILTER (is_late = 1) AS DOUBLE) / SUM(t), 4) AS mean_score "
        "FROM (SELECT is_late, CAST(ROUND(0.8 * COUNT(*)) AS BIGINT) AS t FROM enhanced GROUP BY 1)"
    ),
    "ml_best_model_facts": "SELECT 3::BIGINT AS models, 0::BIGINT AS beaten_by",
    "ml_logreg_gradient": _train_rows(
        "SELECT feature, train_rows, 0.0::DOUBLE AS gradient FROM train, (VALUES ('price'), ('freight_value'), ('product_weight_g'), "
        "('customer_state'), ('seller_state'), ('product_category_name_english'), ('intercept')) AS v(feature)"
    ),
    "ml_tree_facts": _train_rows(
        "SELECT model, train_rows, TRUE AS beats_features FROM train, (VALUES ('Random Forest'), ('Gradient Boosting')) AS v(model)"
    ),
    "ml_boosting_loss": "SELECT 100::BIGINT AS rounds, 0::BIGINT AS rising, TRUE AS below_constant",
    "ml_comparison_facts": _train_rows(
        "SELECT model, test_rows, 0.0::DOUBLE AS acc_gap, 0.0::DOUBLE AS precision_gap, 0.0::DOUBLE AS recall_gap, 0.0::DOUBLE AS f1_gap, "
        "0.0::DOUBLE AS auc_gap FROM train, (VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting')) AS v(model)"
    ),
    "ml_kpi_row": _featured(
        "SELECT COUNT(*) AS samples, ROUND(CAST(SUM(is_late) AS DOUBLE) / COUNT(*) * 100, 6) AS late_pct, "
        "ROUND(CAST(SUM(delay_days) AS DOUBLE) / COUNT(*), 6) AS avg_delay_days, 0.0::DOUBLE AS auc_gap, 0.0::DOUBLE AS accuracy_gap FROM enhanced"
    ),
    "ml_saved_scores": _featured(
        "SELECT model, is_late AS actual, rows, 0::BIGINT AS different FROM (SELECT is_late, COUNT(*) AS rows FROM enhanced GROUP BY 1), "
        "(VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting')) AS v(model)"
    ),
    "catalog_table": _reported("SELECT * FROM order_status_distribution"),
    "wide_csv_split": "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents",
    "wide_columns": "SELECT 'commerce' AS table_name, CAST(COUNT(*) AS INTEGER) AS column_count FROM (DESCRIBE "
    + _wrangled("SELECT * FROM commerce")
    + ")",
    "clean_row_counts": _clean_row_counts(),
    "text_and_fallback_times": (
        "SELECT event_id, date_trunc('minute', CAST(ts AS TIMESTAMP)) AS as_text, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS as_date, "
        "date_trunc('second', CAST(ts AS TIMESTAMP)) AS as_seconds, CAST(NULL AS TIMESTAMP) AS no_time FROM events"
    ),
    "ml_extract_stored": _featured("SELECT * FROM extract"),
    "price_quantiles_sketched": _wrangled(
        "SELECT share, COUNT(price) AS n, TRUE AS within FROM commerce, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) AS v(share) GROUP BY 1"
    ),
    "medians_sketched": _domain(
        "SELECT measure, COUNT(v) AS n, TRUE AS within FROM (SELECT unnest(['product_weight_g', 'product_length_cm', 'product_height_cm', "
        "'product_width_cm']) AS measure, unnest([product_weight_g, product_length_cm, product_height_cm, product_width_cm]) AS v FROM b_products) GROUP BY 1"
    ),
    "binary_metrics": _scored(
        "SELECT ROUND((tp + tn) / (tp + fp + fn + tn), 9) AS acc, ROUND(COALESCE(tp / NULLIF(tp + fp, 0), 0), 9) AS precision, "
        "ROUND(COALESCE(tp / NULLIF(tp + fn, 0), 0), 9) AS recall, ROUND(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 9) AS f1 FROM cells"
    ),
    "roc_auc": _scored(
        ", y AS (SELECT *, SUM(n) OVER (ORDER BY s) - n AS below FROM per_score) "
        "SELECT ROUND(SUM(p * (below + n / 2.0)) / (SUM(p) * SUM(n)), 9) AS auc FROM y"
    ),
    "roc_curve": _scored(
        "SELECT s AS threshold, ROUND(SUM(n) OVER (ORDER BY s DESC) / CAST((SELECT SUM(n) FROM per_score) AS DOUBLE), 9) AS fpr, "
        "ROUND(SUM(p) OVER (ORDER BY s DESC) / CAST((SELECT SUM(p) FROM per_score) AS DOUBLE), 9) AS tpr FROM per_score "
        "UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0"
    ),
    "confusion_matrix": _scored(
        "SELECT a AS actual, p AS predicted, (SELECT COUNT(*) FROM scored WHERE label = a AND pred = p) AS n "
        "FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS v(a, p)"
    ),
}

# The same rows by the paths for tables larger than one task.
ORACLES |= {
    "orders_all_hot": ORACLES["orders_all"],
    "commerce_hot": ORACLES["commerce"],
    "forward_fill_carried": ORACLES["forward_fill_geo"],
    "median_impute_ranged": ORACLES["median_impute"],
    "price_quartiles_ranged": ORACLES["product_price_distribution"],
    "roc_auc_ranged": ORACLES["roc_auc"],
    "roc_curve_ranged": ORACLES["roc_curve"],
    "stratified_split_few_buckets": ORACLES["stratified_split_counts"],
    "stratified_split_radix": ORACLES["stratified_split_counts"],
    "label_encode_joined": ORACLES["label_encode"],
}
