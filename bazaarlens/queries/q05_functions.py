"""Scalar functions over whole columns, streaming refresh, and the functions that replace UDFs."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.functions import json_text as JT
from bazaarlens.functions import scalars as S
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.operators import cleaning as C
from bazaarlens.streaming import refresh

query(
    "fn_trim_case",
    f"SELECT customer_id, upper(trim(customer_state)) AS up, lower(trim(customer_city)) AS low, {q.initcap('trim(customer_city)')} AS cap FROM m_customers",
)(lambda m: m.customers.select("customer_id", F.upper(F.trim("customer_state")).alias("up"), F.lower(F.trim("customer_city")).alias("low"), S.initcap_words(F.trim("customer_city")).alias("cap")))
query("fn_lpad", "SELECT customer_id, lpad(customer_zip_code_prefix, 5, '0') AS zip FROM m_customers")(
    lambda m: m.customers.select("customer_id", S.zero_pad("customer_zip_code_prefix").alias("zip"))
)
query(
    "fn_concat",
    "SELECT order_id || '-' || CAST(order_item_id AS VARCHAR) AS item_key, concat_ws(' ', seller_id, product_id) AS words FROM m_items",
)(lambda m: m.order_items.select(F.concat("order_id", F.lit("-"), F.col("order_item_id").cast("string")).alias("item_key"), F.concat_ws(" ", "seller_id", "product_id").alias("words")))
query(
    "fn_length",
    "SELECT review_id, order_id, review_answer_timestamp, CAST(length(review_comment_message) AS INTEGER) AS n_chars, coalesce(length(review_comment_message) > 0, FALSE) AS has_comment FROM m_reviews",
)(
    lambda m: m.order_reviews.select(
        "review_id", "order_id", "review_answer_timestamp", F.length("review_comment_message").alias("n_chars"),
        F.coalesce(F.length("review_comment_message") > 0, F.lit(False)).alias("has_comment"),
    )
)
query("fn_replace", "SELECT product_id, replace(product_category_name, '_', ' ') AS words FROM m_products")(
    lambda m: m.products.select("product_id", F.replace("product_category_name", F.lit("_"), F.lit(" ")).alias("words"))
)
query("fn_regex_match", "SELECT customer_id, regexp_matches(customer_zip_code_prefix, '^\\d{5}$') AS is_zip FROM m_customers")(
    lambda m: m.customers.select("customer_id", F.rlike("customer_zip_code_prefix", F.lit(r"^\d{5}$")).alias("is_zip"))
)
query(
    "fn_accents_spaces",
    "SELECT id, strip_accents(regexp_replace(trim(name), '\\s+', ' ', 'g')) AS plain FROM (SELECT customer_id AS id, customer_city AS name FROM m_customers UNION ALL SELECT seller_id, seller_city FROM m_sellers)",
)(
    lambda m: m.customers.select(F.col("customer_id").alias("id"), F.col("customer_city").alias("name"))
    .unionByName(m.sellers.select(F.col("seller_id").alias("id"), F.col("seller_city").alias("name")))
    .select("id", S.strip_accents(F.regexp_replace(S.strip("name"), r"\s+", " ")).alias("plain"))
)
query(
    "fn_substring_search",
    "SELECT id FROM m_assets WHERE contains(lower(name), 'src1') OR contains(lower(description), 'the') OR len(list_filter(tags, lambda t: contains(lower(t), 'src1'))) > 0",
)(
    lambda m: m.assets.where(
        S.contains_text("name", "SRC1") | S.contains_text("description", "The") | F.exists("tags", lambda t: F.contains(F.lower(t), F.lit("src1")))
    ).select("id")
)
query(
    "fn_slug",
    "SELECT product_id, substr(regexp_replace(replace(replace(replace(lower(title), ' ', '_'), '/', '_'), '\\', '_'), '[^\\p{L}\\p{N}_]', '', 'g'), 1, 50) AS slug FROM m_texts",
)(lambda m: m.product_texts.select("product_id", S.slug("title").alias("slug")))
query("fn_truncate_label", "SELECT id, CASE WHEN length(label) > 65 THEN substr(label, 1, 65) || '...' ELSE label END AS label FROM (SELECT id, name || ' - ' || description AS label FROM m_assets)")(
    lambda m: m.assets.select("id", F.concat("name", F.lit(" - "), F.col("description")).alias("label")).select("id", S.short_label("label").alias("label"))
)
query(
    "fn_coalesce_nullif",
    "SELECT product_id, coalesce(product_category_name, 'sem_categoria') AS category, nullif(product_photos_qty, 1) AS photos, coalesce(product_weight_g, 0) AS weight FROM m_products",
)(
    lambda m: m.products.select(
        "product_id", F.coalesce("product_category_name", F.lit("sem_categoria")).alias("category"), F.nullif("product_photos_qty", F.lit(1)).alias("photos"),
        F.col("product_weight_g").alias("weight"),
    ).fillna({"weight": 0.0})
)
query(
    "fn_safe_cast",
    f"SELECT order_id, order_item_id, product_id, TRY_CAST(price AS DECIMAL(12,2)) AS price, {q.safe_int('price')} AS whole, TRY_CAST(price AS DOUBLE) AS real, TRY_CAST(shipping_limit_date AS TIMESTAMP) AS at FROM l_items",
)(
    lambda m: m.landing_order_items.select(
        "order_id", "order_item_id", "product_id", S.safe_decimal("price").alias("price"), S.safe_int("price").alias("whole"), S.safe_double("price").alias("real"),
        S.safe_timestamp("shipping_limit_date").alias("at"),
    )
)
query("fn_round", "SELECT order_id, order_item_id, product_id, CAST(round(price, 1) AS DECIMAL(18,2)) AS one, CAST(round(price, 0) AS DECIMAL(18,2)) AS zero FROM m_items")(
    lambda m: m.order_items.select("order_id", "order_item_id", "product_id", S.money(F.round("price", 1)).alias("one"), S.money(F.round("price", 0)).alias("zero"))
)
query("fn_date_trunc", "SELECT order_id, date_trunc('month', order_purchase_timestamp)::DATE AS month, date_trunc('day', order_purchase_timestamp)::TIMESTAMP AS day FROM m_orders")(
    lambda m: m.orders.select("order_id", S.month_start("order_purchase_timestamp").alias("month"), F.date_trunc("day", "order_purchase_timestamp").cast("timestamp_ntz").alias("day"))
)
query(
    "fn_date_format",
    f"SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m') AS year_month, {q.date_key('order_purchase_timestamp')} AS date_key, strftime(order_purchase_timestamp, '%Y') || '-Q' || CAST(quarter(order_purchase_timestamp) AS VARCHAR) AS quarter FROM m_orders",
)(
    lambda m: m.orders.select(
        "order_id", F.date_format("order_purchase_timestamp", "yyyy-MM").alias("year_month"), S.date_key("order_purchase_timestamp").alias("date_key"),
        F.date_format("order_purchase_timestamp", "yyyy-'Q'Q").alias("quarter"),
    )
)
_ts = "order_purchase_timestamp"
query(
    "fn_date_parts",
    f"SELECT order_id, CAST(year({_ts}) AS INTEGER) AS y, CAST(quarter({_ts}) AS INTEGER) AS qt, CAST(month({_ts}) AS INTEGER) AS mo, CAST(weekofyear({_ts}) AS INTEGER) AS wk, CAST(dayofweek({_ts}) AS INTEGER) AS dow FROM m_orders",
)(lambda m: m.orders.select("order_id", F.year(_ts).alias("y"), F.quarter(_ts).alias("qt"), F.month(_ts).alias("mo"), F.weekofyear(_ts).alias("wk"), (F.dayofweek(_ts) - 1).alias("dow")))
query("fn_date_add", f"SELECT order_id, CAST({_ts} AS DATE) + CAST(CAST(order_id AS BIGINT) % 40 AS INTEGER) AS due FROM m_orders")(
    lambda m: m.orders.select("order_id", F.date_add(F.to_date(_ts), (F.col("order_id").cast("bigint") % 40).cast("int")).alias("due"))
)
query("fn_datediff_day", f"SELECT order_id, {q.days(_ts, 'order_delivered_customer_date')} AS days FROM m_orders")(
    lambda m: m.orders.select("order_id", S.days_between(_ts, "order_delivered_customer_date").alias("days"))
)
query("fn_datediff_hour", f"SELECT order_id, {q.hours(_ts, 'order_delivered_customer_date')} AS hours FROM m_orders")(
    lambda m: m.orders.select("order_id", S.hours_between(_ts, "order_delivered_customer_date").alias("hours"))
)
query(
    "fn_elapsed_days",
    f"SELECT order_id, {q.elapsed(_ts, 'order_delivered_customer_date')} AS days, {q.floor_days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS whole FROM m_orders",
)(
    lambda m: m.orders.select(
        "order_id", S.elapsed_days(_ts, "order_delivered_customer_date").alias("days"), S.floor_days("order_estimated_delivery_date", "order_delivered_customer_date").alias("whole")
    )
)
query("fn_normalize_midnight", f"SELECT order_id, CAST({_ts} AS DATE) AS purchase_date FROM m_orders")(lambda m: m.orders.select("order_id", F.to_date(_ts).alias("purchase_date")))
query(
    "fn_hours_since",
    "SELECT order_status, max(order_purchase_timestamp) AS last_seen, CAST(floor((epoch(TIMESTAMP '2021-08-02 06:30:00') - epoch(max(order_purchase_timestamp))) / 3600) AS BIGINT) AS hours, CASE WHEN floor((epoch(TIMESTAMP '2021-08-02 06:30:00') - epoch(max(order_purchase_timestamp))) / 3600) > 24 THEN 'ATRASADO' ELSE 'OK' END AS label FROM m_orders GROUP BY 1",
)(
    lambda m: m.orders.groupBy("order_status")
    .agg(F.max(_ts).alias("last_seen"))
    .withColumn("hours", S.hours_since("last_seen", F.lit("2021-08-02 06:30:00").cast("timestamp_ntz")))
    .withColumn("label", F.when(F.col("hours") > 24, "ATRASADO").otherwise("OK"))
)
query(
    "fn_math",
    "SELECT product_id, product_length_cm * product_height_cm * product_width_cm AS volume, product_weight_g / nullif(product_length_cm, 0) AS density, CASE WHEN product_weight_g IS NOT NULL THEN least(greatest(product_weight_g, 1000), 9000) END AS clipped, abs(product_weight_g - 5000) AS off FROM m_products",
)(
    lambda m: m.products.select(
        "product_id", F.expr("product_length_cm * product_height_cm * product_width_cm").alias("volume"), F.try_divide("product_weight_g", "product_length_cm").alias("density"),
        S.clip("product_weight_g", 1000.0, 9000.0).alias("clipped"), F.abs(F.col("product_weight_g") - 5000).alias("off"),
    )
)
_ok = "CASE WHEN json_valid(answer) THEN answer END"
query("fn_json_parse", f"SELECT product_id, json_extract_string({_ok}, '$.category') AS category, json_extract_string({_ok}, '$.color') AS color FROM m_answers")(
    lambda m: m.answers.select("product_id", JT.parse_members("answer").alias("a")).select("product_id", F.col("a")["category"].alias("category"), F.col("a")["color"].alias("color"))
)
query("fn_json_encode", """SELECT seller_id, '{"city":"' || seller_city || '","state":"' || seller_state || '"}' AS body FROM m_sellers""")(
    lambda m: m.sellers.select("seller_id", F.to_json(F.struct(F.col("seller_city").alias("city"), F.col("seller_state").alias("state"))).alias("body"))
)
_feat = f"CASE WHEN json_type({_ok}, '$.features') = 'OBJECT' THEN json_extract({_ok}, '$.features') END"
query(
    "fn_map_ops",
    f"SELECT product_id, CAST(coalesce(len(json_keys({_feat})), 0) AS INTEGER) AS n_flags, CAST(len(list_filter(coalesce(json_keys({_feat}), []), lambda k: json_extract_string({_feat}, '$.' || k) NOT IN ('true', 'false'))) AS INTEGER) AS n_odd FROM m_answers",
)(
    lambda m: m.answers.select("product_id", JT.flag_map(JT.member(JT.parse_members("answer"), "features")).alias("f")).select(
        "product_id", F.size(F.map_keys("f")).alias("n_flags"), F.size(F.map_filter("f", lambda _, v: ~v.isin("true", "false"))).alias("n_odd")
    )
)
query(
    "fn_array_ops",
    "SELECT id, array_to_string(list_sort(list_distinct(tags)), '/') AS joined, CAST(len(tags) AS INTEGER) AS n FROM m_assets",
)(lambda m: m.assets.select("id", F.array_join(F.array_sort(F.array_distinct("tags")), "/").alias("joined"), F.size("tags").alias("n")))

# --- what the reference does with row functions -----------------------------------------
query("udf_row_apply", "SELECT seller_id, regexp_replace(trim(lower(strip_accents(seller_city))), '\\s+', ' ', 'g') AS city FROM m_sellers")(
    lambda m: m.sellers.select("seller_id", S.normalize_city("seller_city").alias("city"))
)
query("udaf_lambda", "SELECT seller_id, string_agg(DISTINCT CAST(order_item_id AS VARCHAR), '|' ORDER BY CAST(order_item_id AS VARCHAR)) AS numbers FROM m_items GROUP BY 1")(
    lambda m: m.order_items.groupBy("seller_id").agg(F.array_join(F.array_sort(F.collect_set(F.col("order_item_id").cast("string"))), "|").alias("numbers"))
)


# --- streaming refresh ---------------------------------------------------------------------
@query("stream_refresh_5min", "SELECT * FROM t_orders")
def _(m):
    return refresh.refresh_orders(m)
