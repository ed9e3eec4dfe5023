"""The derived tables as SQL: market adapter, trusted and clean layers, star schema."""

from __future__ import annotations

from bazaarlens.functions import fixed
from bazaarlens.oracle import sqlkit as q
from bazaarlens.sources.market import CITIES, MARKET_STATES, SHIFT_DAYS

lib = q.Library()

# --- market adapter --------------------------------------------------------------
lib.add("m_orders", f"""
SELECT order_id, customer_id, order_status, p AS order_purchase_timestamp,
  CASE WHEN k % 90 <> 0 THEN p + to_days(CAST(k % 3 AS INTEGER)) END AS order_approved_at,
  CASE WHEN order_status IN ('delivered', 'shipped') THEN p + to_days(CAST(k % 5 + 2 AS INTEGER)) END AS order_delivered_carrier_date,
  CASE WHEN order_status = 'delivered' THEN p + to_days(CAST(k % 30 + 4 AS INTEGER)) + to_hours(k % 7) END AS order_delivered_customer_date,
  CAST(date_trunc('day', p) AS TIMESTAMP) + INTERVAL 25 DAY AS order_estimated_delivery_date
FROM (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
    ELSE {q.pick(["canceled", "created", "processing", "unavailable"], "o_orderkey % 4")} END AS order_status,
  o_orderdate + INTERVAL {SHIFT_DAYS} DAY + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) AS p
  FROM orders)
""")
lib.add("m_items", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id, CAST(l_partkey AS VARCHAR) AS product_id,
  CAST(l_suppkey AS VARCHAR) AS seller_id, l_shipdate + INTERVAL {SHIFT_DAYS} DAY AS shipping_limit_date,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
  CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS freight_value
FROM lineitem
""")
lib.add("m_payments", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, seq AS payment_sequential,
  {q.pick(["credit_card", "boleto", "voucher", "debit_card", "not_defined"], "(o_orderkey + seq) % 5")} AS payment_type,
  CAST(o_orderkey % 12 + 1 AS INTEGER) AS payment_installments,
  CAST(CAST(CASE WHEN o_orderkey % 2 = 0 THEN cents ELSE cents // 2 END AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS payment_value
FROM (SELECT o_orderkey, CAST(unnest(range(1, o_orderkey % 2 + 2)) AS INTEGER) AS seq,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents FROM orders)
""")
lib.add("m_reviews", f"""
SELECT (CASE WHEN c = 2 THEN 'x' ELSE 'r' END) || CAST(k AS VARCHAR) AS review_id, CAST(k AS VARCHAR) AS order_id,
  CAST(CASE WHEN k % 111 = 0 THEN 6 ELSE k * 7 % 5 + 1 END AS INTEGER) AS review_score,
  CASE WHEN k % 5 >= 3 THEN ' Titulo ' || CAST(k % 100 AS VARCHAR) END AS review_comment_title,
  CASE WHEN k % 5 >= 2 THEN text END AS review_comment_message,
  d AS review_creation_date,
  d + to_hours(CASE WHEN k % 97 = 0 THEN -3 ELSE k % 72 END + c * 5) AS review_answer_timestamp
FROM (SELECT o_orderkey AS k, o_orderdate + INTERVAL {SHIFT_DAYS + 35} DAY AS d, c,
    o_orderkey % (SELECT max(conv_id) + 1 FROM conversations) AS talk, o_orderkey // (SELECT max(conv_id) + 1 FROM conversations) AS nth_use
  FROM orders, (VALUES (0), (1), (2)) v(c)
  WHERE o_orderkey % 10 < 8 AND (c = 0 OR (c = 1 AND o_orderkey % 40 = 0) OR (c = 2 AND o_orderkey % 60 = 0)))
LEFT JOIN (SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY 1) n ON talk = n.conv_id
LEFT JOIN (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY 1, 2) t ON talk = t.conv_id AND nth_use % n_turns = t.turn
""")
lib.add("m_customers", f"""
SELECT CAST(k AS VARCHAR) AS customer_id, CAST(k - CASE WHEN k % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR) AS customer_unique_id,
  CAST(k * 37 % 20000 AS VARCHAR) AS customer_zip_code_prefix, {q.pick(CITIES, "k % 5")} AS customer_city,
  CASE WHEN k % 101 = 0 THEN 'ZZ' WHEN k % 20 = 3 THEN lower(uf) || ' ' ELSE uf END AS customer_state
FROM (SELECT c_custkey AS k, {q.pick(MARKET_STATES, "c_nationkey")} AS uf FROM customer)
""")
lib.add("m_products", """
SELECT CAST(k AS VARCHAR) AS product_id, CASE WHEN k % 50 <> 0 THEN lower(p_type) || '_' || lower(replace(p_brand, '#', '_')) END AS product_category_name,
  CAST(length(p_name) AS INTEGER) AS product_name_lenght, CAST(k % 400 + 100 AS INTEGER) AS product_description_lenght,
  CAST(CASE WHEN k % 50 <> 0 THEN k % 6 + 1 END AS INTEGER) AS product_photos_qty,
  CAST(CASE WHEN k % 61 <> 0 THEN p_size * 250 END AS DOUBLE) AS product_weight_g,
  CAST(CASE WHEN k % 61 <> 0 THEN k % 10 + 10 END AS DOUBLE) AS product_length_cm,
  CAST(k % 4 + 5 AS DOUBLE) AS product_height_cm, CAST(k % 6 + 8 AS DOUBLE) AS product_width_cm
FROM (SELECT p_partkey AS k, * FROM part)
""")
lib.add("m_translation", """
SELECT DISTINCT lower(p_type) || '_' || lower(replace(p_brand, '#', '_')) || CASE WHEN CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 5 = 0 THEN ' ' ELSE '' END AS product_category_name,
  lower(p_type) || '_' || lower(replace(p_brand, 'Brand#', 'line_')) AS product_category_name_english
FROM part WHERE p_type <> 'ECONOMY'
""")
lib.add("m_sellers", f"""
SELECT CAST(k AS VARCHAR) AS seller_id, CAST(k * 53 % 20000 AS VARCHAR) AS seller_zip_code_prefix, {q.pick(CITIES, "k % 5")} AS seller_city,
  CASE WHEN k % 20 = 3 THEN lower(uf) || ' ' ELSE uf END AS seller_state
FROM (SELECT s_suppkey AS k, {q.pick(MARKET_STATES, "s_nationkey")} AS uf FROM supplier)
""")
lib.add("m_geo", f"""
SELECT CAST(k * 37 % 20000 AS VARCHAR) AS geolocation_zip_code_prefix,
  CASE WHEN k % 300 <> 5 OR i > 0 THEN ((k * 13 + i * 7) % 3900 - 3000) / 100.0::DOUBLE END AS geolocation_lat,
  ((k * 17 + i * 3) % 4400 - 7400) / 100.0::DOUBLE AS geolocation_lng,
  {q.pick(CITIES, "(CASE WHEN i = 2 THEN k + 1 ELSE k + i END) % 5")} AS geolocation_city, uf AS geolocation_state
FROM (SELECT c_custkey AS k, {q.pick(MARKET_STATES, "c_nationkey")} AS uf FROM customer), (VALUES (0), (1), (2)) v(i)
""")

# --- raw text form -------------------------------------------------------------------
lib.add("l_orders", """
SELECT order_id, CASE WHEN k % 333 <> 1 THEN customer_id END AS customer_id,
  CASE WHEN k % 501 = 2 THEN 'lost' ELSE order_status END AS order_status,
  CAST(order_purchase_timestamp AS VARCHAR) AS order_purchase_timestamp,
  CASE WHEN k % 70 = 3 THEN '2018-13-01 00:00:00' ELSE CAST(order_approved_at AS VARCHAR) END AS order_approved_at,
  CAST(order_delivered_carrier_date AS VARCHAR) AS order_delivered_carrier_date,
  CAST(order_delivered_customer_date AS VARCHAR) AS order_delivered_customer_date,
  CAST(order_estimated_delivery_date AS VARCHAR) AS order_estimated_delivery_date
FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM m_orders
  UNION ALL
  SELECT * REPLACE (' ' || order_status || ' ' AS order_status, order_purchase_timestamp + INTERVAL 1 HOUR AS order_purchase_timestamp), CAST(order_id AS BIGINT)
  FROM m_orders WHERE CAST(order_id AS BIGINT) % 200 = 7)
""")
lib.add("l_items", """
SELECT order_id, CAST(order_item_id AS VARCHAR) AS order_item_id,
  CASE WHEN length(order_id) > 1 OR order_item_id <> 1 THEN product_id END AS product_id, seller_id,
  CAST(shipping_limit_date AS VARCHAR) AS shipping_limit_date,
  CASE WHEN k % 97 = 0 THEN 'abc' WHEN k % 89 = 0 THEN '0' WHEN k % 83 = 0 THEN '-1' WHEN k % 79 = 0 THEN '12.345' ELSE CAST(price AS VARCHAR) END AS price,
  CAST(freight_value AS VARCHAR) AS freight_value
FROM (SELECT *, CAST(order_id AS BIGINT) + order_item_id AS k FROM m_items)
""")
lib.add("l_payments", """
SELECT order_id, CAST(payment_sequential AS VARCHAR) AS payment_sequential,
  CASE WHEN k % 30 = 4 THEN ' ' || upper(payment_type) ELSE payment_type END AS payment_type,
  CASE WHEN k % 77 <> 0 THEN CAST(payment_installments AS VARCHAR) END AS payment_installments,
  CASE WHEN k % 101 = 0 THEN '0' ELSE CAST(payment_value AS VARCHAR) END AS payment_value
FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM m_payments)
""")
lib.add("l_reviews", """
SELECT review_id, order_id, CAST(review_score AS VARCHAR) || CASE WHEN CAST(order_id AS BIGINT) % 9 = 0 THEN '.0' ELSE '' END AS review_score,
  review_comment_title, review_comment_message, CAST(review_creation_date AS VARCHAR) AS review_creation_date,
  CAST(review_answer_timestamp AS VARCHAR) AS review_answer_timestamp
FROM m_reviews
""")
lib.add("l_products", """
SELECT product_id, product_category_name, CAST(product_name_lenght AS VARCHAR) AS product_name_lenght,
  CAST(product_description_lenght AS VARCHAR) AS product_description_lenght, CAST(product_photos_qty AS VARCHAR) AS product_photos_qty,
  CASE WHEN CAST(product_id AS BIGINT) % 45 = 0 THEN 'heavy' ELSE CAST(product_weight_g AS VARCHAR) END AS product_weight_g,
  CASE WHEN CAST(product_id AS BIGINT) % 47 = 0 THEN '10.5' ELSE CAST(product_length_cm AS VARCHAR) END AS product_length_cm, CAST(product_height_cm AS VARCHAR) AS product_height_cm,
  CAST(product_width_cm AS VARCHAR) AS product_width_cm
FROM m_products
""")

# --- trusted layer ---------------------------------------------------------------------
TIMES = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]
_times = ", ".join(f"TRY_CAST({c} AS TIMESTAMP) AS {c}" for c in TIMES)
lib.add("t_orders", f"""
SELECT *, {q.days("order_purchase_timestamp", "order_delivered_customer_date")} AS delivery_days,
  {q.days("order_estimated_delivery_date", "order_delivered_customer_date")} AS delivery_delay_days,
  CASE WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 'ON_TIME'
       WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 'LATE' ELSE 'PENDING' END AS delivery_status
FROM (SELECT order_id, customer_id, upper(trim(order_status)) AS order_status, {_times} FROM l_orders
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_purchase_timestamp DESC) = 1)
""")
lib.add("t_items", """
SELECT order_id, CAST(order_item_id AS INTEGER) AS order_item_id, product_id, seller_id, TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
  TRY_CAST(price AS DECIMAL(12,2)) AS price, TRY_CAST(freight_value AS DECIMAL(12,2)) AS freight_value,
  CAST(TRY_CAST(price AS DECIMAL(12,2)) + TRY_CAST(freight_value AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS total_item_value
FROM l_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND TRY_CAST(price AS DECIMAL(12,2)) > 0
""")
lib.add("t_payments", f"""
SELECT order_id, CAST(payment_sequential AS INTEGER) AS payment_sequential, upper(trim(payment_type)) AS payment_type,
  {q.safe_int("payment_installments")} AS payment_installments, TRY_CAST(payment_value AS DECIMAL(12,2)) AS payment_value
FROM l_payments WHERE order_id IS NOT NULL AND TRY_CAST(payment_value AS DECIMAL(12,2)) > 0
""")
lib.add("t_reviews", f"""
SELECT *, {q.hours("review_creation_date", "review_answer_timestamp")} AS response_time_hours,
  CASE WHEN review_score >= 4 THEN 'POSITIVE' WHEN review_score = 3 THEN 'NEUTRAL' ELSE 'NEGATIVE' END AS sentiment_category
FROM (SELECT review_id, order_id, {q.safe_int("review_score")} AS review_score, trim(coalesce(review_comment_title, '')) AS review_comment_title,
  trim(coalesce(review_comment_message, '')) AS review_comment_message, TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
  TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp FROM l_reviews WHERE review_id IS NOT NULL AND order_id IS NOT NULL)
WHERE review_score BETWEEN 1 AND 5
""")
lib.add("t_customers", f"""
SELECT *, {q.region("customer_state", "Desconhecido")} AS customer_region
FROM (SELECT customer_id, customer_unique_id, lpad(customer_zip_code_prefix, 5, '0') AS customer_zip_code_prefix,
  {q.initcap("trim(customer_city)")} AS customer_city, upper(trim(customer_state)) AS customer_state FROM m_customers
  QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id) = 1)
""")
_dims = ", ".join(f"coalesce(TRY_CAST({c} AS DOUBLE), 0) AS {c}" for c in ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"])
lib.add("t_products", f"""
SELECT *, round(product_length_cm * product_height_cm * product_width_cm, 2) AS product_volume_cm3
FROM (SELECT p.product_id, coalesce(trim(p.product_category_name), 'sem_categoria') AS product_category_name,
  coalesce(trim(t.product_category_name_english), 'uncategorized') AS product_category_english,
  coalesce({q.safe_int("product_name_lenght")}, 0) AS product_name_length, coalesce({q.safe_int("product_description_lenght")}, 0) AS product_description_length,
  coalesce({q.safe_int("product_photos_qty")}, 0) AS product_photos_qty, {_dims}
  FROM l_products p LEFT JOIN m_translation t ON trim(p.product_category_name) = trim(t.product_category_name))
""")
lib.add("t_sellers", f"""
SELECT seller_id, lpad(seller_zip_code_prefix, 5, '0') AS seller_zip_code_prefix, {q.initcap("trim(seller_city)")} AS seller_city, upper(trim(seller_state)) AS seller_state FROM m_sellers
""")
lib.add("geo_points", f"""
SELECT lpad(geolocation_zip_code_prefix, 5, '0') AS zip, geolocation_lat AS lat, geolocation_lng AS lng,
  {q.initcap("trim(geolocation_city)")} AS city, upper(trim(geolocation_state)) AS state
FROM m_geo WHERE geolocation_lat BETWEEN -35.0 AND 6.0 AND geolocation_lng BETWEEN -74.0 AND -34.0
""")
lib.add("t_geo", """
SELECT a.zip AS geolocation_zip_code_prefix, a.lat AS geolocation_lat, a.lng AS geolocation_lng, c.city AS geolocation_city, s.state AS geolocation_state, a.n AS registro_count
FROM (SELECT zip, round(avg(lat), 6) AS lat, round(avg(lng), 6) AS lng, count(*) AS n FROM geo_points GROUP BY zip) a
JOIN (SELECT zip, city FROM (SELECT zip, city, count(*) AS n FROM geo_points GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY zip ORDER BY n DESC, city) = 1) c ON a.zip = c.zip
JOIN (SELECT zip, state FROM (SELECT zip, state, count(*) AS n FROM geo_points GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY zip ORDER BY n DESC, state) = 1) s ON a.zip = s.zip
""")

# --- clean layer -------------------------------------------------------------------------
_ord = lambda *cols: ", ".join(cols)
L_ORDERS = ["order_id", "customer_id", "order_status", *TIMES]
lib.add("c_orders", f"""
SELECT order_id, customer_id, order_status, {_times}
FROM (SELECT * FROM l_orders QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {_ord(*[c + " NULLS LAST" for c in L_ORDERS])}) = 1)
WHERE order_status IN {q.in_list(fixed.ORDER_STATUSES)}
""")
ITEM_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
lib.add("c_items", f"""
SELECT * FROM (SELECT * FROM m_items QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY {_ord(*[c + " NULLS LAST" for c in ITEM_COLS])}) = 1)
WHERE price >= 0 AND freight_value >= 0
""")
lib.add("c_payments", """
SELECT order_id, CAST(payment_sequential AS INTEGER) AS payment_sequential, payment_type, coalesce(TRY_CAST(payment_installments AS INTEGER), 1) AS payment_installments,
  TRY_CAST(payment_value AS DECIMAL(12,2)) AS payment_value
FROM (SELECT * FROM l_payments QUALIFY row_number() OVER (PARTITION BY order_id, payment_sequential ORDER BY payment_type NULLS LAST, payment_installments NULLS LAST, payment_value NULLS LAST) = 1)
WHERE TRY_CAST(payment_value AS DECIMAL(12,2)) >= 0
""")
REVIEW_COLS = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message", "review_creation_date", "review_answer_timestamp"]
lib.add("c_reviews", f"""
SELECT review_id, order_id, review_score, regexp_replace(coalesce(review_comment_title, ''), '^\\s+|\\s+$', '', 'g') AS review_comment_title,
  regexp_replace(coalesce(review_comment_message, ''), '^\\s+|\\s+$', '', 'g') AS review_comment_message, review_creation_date, review_answer_timestamp
FROM (SELECT * FROM m_reviews QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY {_ord(*[c + " NULLS LAST" for c in REVIEW_COLS])}) = 1)
WHERE review_score BETWEEN 1 AND 5
""")
_strip = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
lib.add("c_customers", f"""
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, {_strip("lower(customer_city)")} AS customer_city, {_strip("upper(customer_state)")} AS customer_state FROM m_customers
""")
lib.add("c_sellers", f"""
SELECT seller_id, seller_zip_code_prefix, {_strip("lower(seller_city)")} AS seller_city, {_strip("upper(seller_state)")} AS seller_state FROM m_sellers
""")
_whole = ", ".join(f"coalesce(TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER), 0) AS {c}" for c in [
    "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"])
lib.add("c_products", f"""
SELECT p.*, coalesce(t.product_category_name_english, p.product_category_name) AS product_category_name_english
FROM (SELECT *, TRY_CAST(product_length_cm::HUGEINT * product_height_cm * product_width_cm AS BIGINT) AS product_volume_cm3
  FROM (SELECT product_id, lower({_strip("coalesce(product_category_name, 'sem_categoria')")}) AS product_category_name, {_whole} FROM l_products)) p
LEFT JOIN m_translation t ON p.product_category_name = t.product_category_name
""")

# --- star schema ------------------------------------------------------------------------------
lib.add("spine", """
SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS full_date
FROM (SELECT date_trunc('year', min(order_purchase_timestamp)) AS lo, date_trunc('year', max(order_purchase_timestamp)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS hi FROM (
  SELECT order_purchase_timestamp FROM m_orders UNION ALL SELECT review_creation_date FROM m_reviews UNION ALL SELECT review_answer_timestamp FROM m_reviews))
""")


def date_dim(source: str) -> str:
    return f"""
SELECT {q.date_key("full_date")} AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(month(full_date) AS INTEGER) AS month, {q.pick(fixed.MONTH_NAMES_PT, "month(full_date) - 1")} AS month_name,
  CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, CAST(dayofweek(full_date) AS INTEGER) AS day_of_week,
  {q.pick(fixed.DAY_NAMES_PT, "dayofweek(full_date)")} AS day_of_week_name, dayofweek(full_date) IN (0, 6) AS is_weekend,
  strftime(full_date, '%Y-%m') AS year_month, strftime(full_date, '%Y') || '-Q' || CAST(quarter(full_date) AS VARCHAR) AS year_quarter
FROM {source}"""


lib.add("d_date", date_dim("spine"))
lib.add("d_date_all", date_dim("spine"))
lib.add("d_customer", """
SELECT row_number() OVER (ORDER BY customer_unique_id) AS customer_key, c.*, g.geolocation_lat AS customer_lat, g.geolocation_lng AS customer_lng
FROM t_customers c LEFT JOIN t_geo g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix
""")
lib.add("d_product", f"SELECT row_number() OVER (ORDER BY product_id) AS product_key, *, {q.weight_band('product_weight_g')} AS weight_category FROM t_products")
lib.add("d_seller", """
SELECT row_number() OVER (ORDER BY seller_id) AS seller_key, s.*, g.geolocation_lat AS seller_lat, g.geolocation_lng AS seller_lng
FROM t_sellers s LEFT JOIN t_geo g ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix
""")
lib.add("d_geography", f"""
SELECT row_number() OVER (ORDER BY geolocation_zip_code_prefix) AS geography_key, geolocation_zip_code_prefix AS zip_code, geolocation_city AS city,
  geolocation_state AS state, geolocation_lat AS latitude, geolocation_lng AS longitude, {q.region("geolocation_state", "Norte")} AS region FROM t_geo
""")
lib.add("top_pay", "SELECT * FROM t_payments QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC, payment_sequential) = 1")
lib.add("lead_item", """
SELECT order_id, product_id FROM t_items QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value) = 1
""")
FACT_TAIL = f"""
  {q.date_key("o.order_purchase_timestamp")} AS purchase_date_key, {q.date_key("o.order_approved_at")} AS approved_date_key,
  {q.date_key("o.order_delivered_customer_date")} AS delivery_date_key, o.order_status, o.delivery_status, pay.payment_type, pay.payment_installments,
  oi.price, oi.freight_value, oi.total_item_value, pay.payment_value, o.delivery_days, o.delivery_delay_days, {", ".join("o." + c for c in TIMES)}
"""
lib.add("f_orders", f"""
SELECT oi.order_id || '-' || CAST(oi.order_item_id AS VARCHAR) AS order_item_key, o.order_id, oi.order_item_id, dc.customer_key, dp.product_key, ds.seller_key, {FACT_TAIL}
FROM t_orders o JOIN t_items oi ON o.order_id = oi.order_id JOIN d_customer dc ON o.customer_id = dc.customer_id
JOIN d_product dp ON oi.product_id = dp.product_id JOIN d_seller ds ON oi.seller_id = ds.seller_id LEFT JOIN top_pay pay ON o.order_id = pay.order_id
""")


def reviews_fact(date_column: str) -> str:
    return f"""
SELECT r.review_id, dc.customer_key, dp.product_key, {q.date_key(date_column)} AS review_date_key, r.order_id, r.review_score, r.sentiment_category, r.response_time_hours,
  length(r.review_comment_message) > 0 AS has_comment, CAST(length(r.review_comment_message) AS INTEGER) AS comment_length,
  r.review_comment_title, r.review_comment_message, r.review_creation_date, r.review_answer_timestamp
FROM t_reviews r JOIN t_orders o ON r.order_id = o.order_id JOIN d_customer dc ON o.customer_id = dc.customer_id
LEFT JOIN lead_item oi ON r.order_id = oi.order_id LEFT JOIN d_product dp ON oi.product_id = dp.product_id"""


lib.add("f_reviews", reviews_fact("r.review_creation_date"))
lib.add("vw_sales", """
SELECT fo.order_id, dd.full_date AS purchase_date, dd.year_month, dd.month_name, dd.year, dc.customer_city, dc.customer_state, dc.customer_region,
  dp.product_category_name, dp.product_category_english, dp.weight_category, ds.seller_city, ds.seller_state, fo.order_status, fo.delivery_status,
  fo.payment_type, fo.payment_installments, fo.price, fo.freight_value, fo.total_item_value, fo.delivery_days, fo.delivery_delay_days
FROM f_orders fo JOIN d_date dd ON fo.purchase_date_key = dd.date_key JOIN d_customer dc ON fo.customer_key = dc.customer_key
JOIN d_product dp ON fo.product_key = dp.product_key JOIN d_seller ds ON fo.seller_key = ds.seller_key
""")
lib.add("vw_satisfaction", """
SELECT fr.review_id, fr.order_id, dd.full_date AS review_date, dd.year_month, dd.month_name, dd.year, dc.customer_city, dc.customer_state, dc.customer_region,
  dp.product_category_name, dp.product_category_english, fr.review_score, fr.sentiment_category, fr.has_comment, fr.comment_length, fr.response_time_hours,
  fr.review_comment_title, fr.review_comment_message
FROM f_reviews fr JOIN d_date dd ON fr.review_date_key = dd.date_key JOIN d_customer dc ON fr.customer_key = dc.customer_key LEFT JOIN d_product dp ON fr.product_key = dp.product_key
""")
# notebook star: keys over clean tables
lib.add("s_customer", "SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, * FROM c_customers")
lib.add("s_product", "SELECT row_number() OVER (ORDER BY product_id) AS product_sk, * FROM c_products")
lib.add("s_seller", "SELECT row_number() OVER (ORDER BY seller_id) AS seller_sk, * FROM c_sellers")
lib.add("pay_summary", """
SELECT order_id, CAST(sum(payment_value) AS DECIMAL(18,2)) AS total_payment, max(payment_installments) AS installments_max,
  string_agg(DISTINCT payment_type, '|' ORDER BY payment_type) AS payment_types FROM c_payments GROUP BY order_id
""")
lib.add("s_fact_orders", f"""
SELECT i.order_id, i.order_item_id, o.order_status, c.customer_sk, p.product_sk, s.seller_sk, {q.date_key("o.order_purchase_timestamp")} AS date_key,
  i.price, i.freight_value, pa.total_payment, pa.installments_max, pa.payment_types,
  {q.elapsed("o.order_purchase_timestamp", "o.order_delivered_customer_date")} AS delivery_days,
  {q.elapsed("o.order_purchase_timestamp", "o.order_estimated_delivery_date")} AS estimated_days,
  coalesce(o.order_delivered_customer_date > o.order_estimated_delivery_date, FALSE) AS is_late, o.order_purchase_timestamp
FROM c_items i LEFT JOIN c_orders o ON i.order_id = o.order_id LEFT JOIN pay_summary pa ON i.order_id = pa.order_id
LEFT JOIN s_customer c ON o.customer_id = c.customer_id LEFT JOIN s_product p ON i.product_id = p.product_id LEFT JOIN s_seller s ON i.seller_id = s.seller_id
""")

# --- text, answers, vectors, assets -------------------------------------------------------------
lib.add("m_texts", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name || ' ' || p_brand || ' ' || lower(p_type) AS title, text AS description, CAST(p_retailprice AS DECIMAL(12,2)) AS price
FROM part LEFT JOIN documents ON p_partkey % (SELECT max(doc_id) + 1 FROM documents) = doc_id
""")
_q = lambda cond, value: f"CASE WHEN {cond} THEN '\"' || {value} || '\"' ELSE 'null' END"
lib.add("m_answers", f"""
SELECT CAST(k AS VARCHAR) AS product_id, p_name || ' ' || p_brand || ' ' || lower(p_type) AS title,
  CASE WHEN k % 37 = 0 THEN NULL WHEN k % 17 = 0 THEN 'oops ' || p_name ELSE
  '{{"category": "' || CASE WHEN k % 29 = 0 THEN 'Unknown Stuff' ELSE {q.pick(fixed.PRODUCT_CATEGORIES, "k % 16")} END || '", "subcategory": "' || p_name || '", '
  || CASE WHEN k % 13 <> 0 THEN '"brand": ' || {_q("k % 7 <> 0", "p_brand")} || ', ' ELSE '' END
  || '"material": ' || {_q("k % 4 <> 0", q.pick(["Leather", "Steel", "None", ""], "(k // 4) % 4"))}
  || ', "target_device": ' || {_q("k % 3 = 0", "'Phone'")} || ', "color": ' || {_q("k % 5 <> 0", q.pick(["Black", "Red", "Blue"], "k % 3"))}
  || ', "features": ' || CASE WHEN k % 19 = 0 THEN '[1, 2]' ELSE '{{' || array_to_string(list_concat(
      list_transform(range(0, k % 9), lambda i: '"has_f' || CAST(i AS VARCHAR) || '": ' || CASE WHEN (k + i) % 3 = 0 THEN 'false' ELSE 'true' END),
      CASE WHEN k % 31 = 0 THEN ['"size": "big"'] ELSE [] END), ', ') || '}}' END
  || ', "target_audience": ' || {_q("k % 6 = 0", "'Unisex'")}
  || ', "keywords": ' || CASE WHEN k % 23 = 0 THEN '"one text"' ELSE '[' || array_to_string(list_transform(range(0, k % 12), lambda i: '"kw' || CAST(i AS VARCHAR) || '"'), ', ') || ']' END
  || '}}' END AS answer, k % 200 + 500 AS input_tokens, k % 100 + 150 AS output_tokens
FROM (SELECT p_partkey AS k, * FROM part)
""")
lib.add("m_vectors", """
SELECT CAST(vec_id AS VARCHAR) AS product_id, embedding, CASE WHEN vec_id % 10 <> 0 THEN 'class_' || CAST(label AS VARCHAR) END AS extracted_category,
  (vec_id % 50 + 50) / 100.0::DOUBLE AS confidence_score FROM embeddings
""")
lib.add("m_assets", f"""
SELECT doc_id AS id, 'Asset ' || source || ' ' || CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id % 4 = 0 THEN kind END AS type,
  CASE WHEN doc_id % 4 = 1 THEN kind END AS asset_type, CASE WHEN doc_id % 4 = 2 THEN kind END AS "assetType", text AS description, [lang, source] AS tags
FROM (SELECT *, {q.pick(["Table", "dashboard", "PIPELINE"], "doc_id % 3")} AS kind FROM documents)
""")
