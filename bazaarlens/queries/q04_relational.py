"""Projections, filters, joins, aggregates, windows, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bazaarlens.functions import fixed
from bazaarlens.functions import scalars as S
from bazaarlens.operators import aggregates as A
from bazaarlens.operators import baskets as B
from bazaarlens.operators import cleaning as C
from bazaarlens.operators import joins as J
from bazaarlens.operators import ranges as R
from bazaarlens.operators import star
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.queries.q03_star import Warehouse

# --- projections and filters -----------------------------------------------------
query("prj_computed", f"SELECT order_id, order_item_id, product_id, {q.money('price + freight_value')} AS total_value FROM m_items")(
    lambda m: m.order_items.select("order_id", "order_item_id", "product_id", S.money(F.col("price") + F.col("freight_value")).alias("total_value"))
)


def select_available(df, columns):
    return df.select([c for c in columns if c in df.columns])


query("prj_select_available", "SELECT product_id, product_category_name, product_weight_g FROM m_products")(
    lambda m: select_available(m.products, ["product_id", "product_category_name", "product_colour", "product_weight_g"])
)
query("prj_rename_labels", 'SELECT seller_id AS "ID do Vendedor", seller_state AS "Estado (UF)", seller_zip_code_prefix AS "CEP" FROM m_sellers')(
    lambda m: m.sellers.select(F.col("seller_id").alias("ID do Vendedor"), F.col("seller_state").alias("Estado (UF)"), F.col("seller_zip_code_prefix").alias("CEP"))
)
query("flt_in", f"SELECT order_id, order_status FROM l_orders WHERE order_status IN {q.in_list(fixed.ORDER_STATUSES)}")(
    lambda m: m.landing_orders.where(F.col("order_status").isin(fixed.ORDER_STATUSES)).select("order_id", "order_status")
)
query("flt_not_in", "SELECT order_id, customer_id, order_status FROM l_orders WHERE order_status NOT IN ('canceled', 'unavailable')")(
    lambda m: m.landing_orders.where(~F.col("order_status").isin("canceled", "unavailable")).select("order_id", "customer_id", "order_status")
)
query("flt_between", "SELECT review_id, review_score FROM m_reviews WHERE review_score BETWEEN 1 AND 5")(
    lambda m: m.order_reviews.where(F.col("review_score").between(1, 5)).select("review_id", "review_score")
)
query("flt_null", "SELECT order_id FROM m_orders WHERE order_delivered_customer_date IS NOT NULL AND order_approved_at IS NOT NULL")(
    lambda m: m.orders.dropna(subset=["order_delivered_customer_date", "order_approved_at"]).select("order_id")
)
query("flt_compare", "SELECT order_id, order_item_id, price FROM m_items WHERE price > 50000 AND freight_value >= 1000 AND order_item_id <= 4 AND seller_id <> '1'")(
    lambda m: m.order_items.where("price > 50000 and freight_value >= 1000 and order_item_id <= 4 and seller_id <> '1'").select("order_id", "order_item_id", "price")
)
query(
    "flt_range_open",
    f"SELECT order_id, {q.elapsed('order_purchase_timestamp', 'order_delivered_customer_date')} AS delivery_days FROM m_orders WHERE {q.elapsed('order_purchase_timestamp', 'order_delivered_customer_date')} > 0 AND {q.elapsed('order_purchase_timestamp', 'order_delivered_customer_date')} <= 120",
)(
    lambda m: m.orders.select("order_id", S.elapsed_days("order_purchase_timestamp", "order_delivered_customer_date").alias("delivery_days")).where(
        "delivery_days > 0 and delivery_days <= 120"
    )
)
query(
    "flt_window_result",
    "SELECT order_id, payment_sequential, payment_value FROM m_payments QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC, payment_sequential) <= 1",
)(lambda m: C.first_per_key(m.order_payments, ["order_id"], [F.col("payment_value").desc(), F.col("payment_sequential")]).select("order_id", "payment_sequential", "payment_value"))
query(
    "case_simple",
    "SELECT order_id, CASE order_status " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.FUNNEL) + " ELSE order_status END AS status_pt FROM m_orders",
)(lambda m: m.orders.select("order_id", S.lookup("order_status", dict(fixed.FUNNEL), F.col("order_status")).alias("status_pt")))
query(
    "case_searched",
    "SELECT order_id, CASE WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 'ON_TIME' WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 'LATE' ELSE 'PENDING' END AS delivery_status FROM m_orders",
)(lambda m: m.orders.select("order_id", S.delivery_status("order_delivered_customer_date", "order_estimated_delivery_date").alias("delivery_status")))
query("state_to_region", f"SELECT customer_id, {q.region('upper(trim(customer_state))', 'Desconhecido')} AS region, {q.region('upper(trim(customer_state))', 'Norte')} AS region_or_norte FROM m_customers")(
    lambda m: m.customers.select(
        "customer_id",
        S.state_to_region(F.upper(F.trim("customer_state")), "Desconhecido").alias("region"),
        S.state_to_region(F.upper(F.trim("customer_state")), "Norte").alias("region_or_norte"),
    )
)
query("weight_band", f"SELECT product_id, {q.weight_band('product_weight_g')} AS weight_category FROM m_products")(
    lambda m: m.products.select("product_id", S.weight_band("product_weight_g").alias("weight_category"))
)
query("sentiment_band", "SELECT review_id, order_id, CASE WHEN review_score >= 4 THEN 'POSITIVE' WHEN review_score = 3 THEN 'NEUTRAL' ELSE 'NEGATIVE' END AS sentiment FROM m_reviews")(
    lambda m: m.order_reviews.select("review_id", "order_id", S.sentiment_band("review_score").alias("sentiment"))
)
query("price_tier", f"SELECT order_id, order_item_id, {q.price_tier('freight_value')} AS tier FROM m_items")(
    lambda m: m.order_items.select("order_id", "order_item_id", S.price_tier("freight_value").alias("tier"))
)

# --- joins -------------------------------------------------------------------------
query(
    "join_inner_equi",
    "SELECT i.order_id, i.order_item_id, o.order_status, p.product_category_name, i.price FROM m_items i JOIN m_orders o ON i.order_id = o.order_id JOIN m_products p ON i.product_id = p.product_id",
)(
    lambda m: m.order_items.join(m.orders, "order_id").join(m.products, "product_id").select("order_id", "order_item_id", "order_status", "product_category_name", "price")
)
query(
    "join_left_equi",
    "SELECT p.product_id, p.product_category_name, t.product_category_name_english FROM m_products p LEFT JOIN m_translation t ON p.product_category_name = t.product_category_name",
)(lambda m: m.products.join(m.translation, "product_category_name", "left").select("product_id", "product_category_name", "product_category_name_english"))
query(
    "join_expr_key",
    "SELECT p.product_id, t.product_category_name_english FROM m_products p LEFT JOIN m_translation t ON trim(p.product_category_name) = trim(t.product_category_name)",
)(
    lambda m: m.products.alias("p").join(m.translation.alias("t"), F.trim("p.product_category_name") == F.trim("t.product_category_name"), "left").select("product_id", "product_category_name_english")
)
query(
    "join_left_compound",
    "SELECT o.order_id, p.payment_type, p.payment_value FROM t_orders o LEFT JOIN top_pay p ON o.order_id = p.order_id",
)(lambda m: Warehouse(m).orders.join(star.top_payment(Warehouse(m).payments), "order_id", "left").select("order_id", "payment_type", "payment_value"))


@query(
    "join_star",
    """SELECT fo.order_item_key, dd.year_month, dc.customer_region, dp.weight_category, ds.seller_city, fo.price FROM f_orders fo JOIN d_date dd ON fo.purchase_date_key = dd.date_key
    JOIN d_customer dc ON fo.customer_key = dc.customer_key JOIN d_product dp ON fo.product_key = dp.product_key JOIN d_seller ds ON fo.seller_key = ds.seller_key""",
)
def _(m):
    w = Warehouse(m)
    dims = [
        (w.dates.withColumnRenamed("date_key", "purchase_date_key"), "purchase_date_key", "inner"),
        (w.dim_customer.select("customer_key", "customer_region"), "customer_key", "inner"),
        (w.dim_product.select("product_key", "weight_category"), "product_key", "inner"),
        (w.dim_seller.select("seller_key", "seller_city"), "seller_key", "inner"),
    ]
    return J.star_join(w.fact_lines, dims).select("order_item_key", "year_month", "customer_region", "weight_category", "seller_city", "price")


@query(
    "join_cross_scalar",
    f"WITH p AS (SELECT payment_type, count(DISTINCT order_id) AS n FROM m_payments GROUP BY 1) SELECT payment_type, n, CAST(total AS BIGINT) AS total, {q.pct('n', 'total')} AS share FROM p, (SELECT sum(n) AS total FROM p)",
)
def _(m):
    p = m.order_payments.groupBy("payment_type").agg(F.count_distinct("order_id").alias("n"))
    return J.with_total(p, p.agg(F.sum("n").alias("total"))).withColumn("share", S.percent("n", "total"))


query(
    "join_cross_fact",
    f"SELECT s.seller_state, count(*) AS n_rows, {q.avg('fr.review_score', 4)} AS avg_score FROM f_reviews fr JOIN f_orders fo ON fr.order_id = fo.order_id JOIN d_seller s ON fo.seller_key = s.seller_key GROUP BY 1",
)(
    lambda m: (
        lambda w: J.attach(w.fact_reviews.select("order_id", "review_score").join(w.fact_lines.select("order_id", "seller_key"), "order_id"), w.dim_seller, "seller_key", "inner")
        .groupBy("seller_state")
        .agg(F.count("*").alias("n_rows"), S.mean("review_score", 4).alias("avg_score"))
    )(Warehouse(m))
)
query(
    "join_left_anti",
    "SELECT 'product' AS kind, i.orphan FROM (SELECT DISTINCT product_id AS orphan FROM m_items) i LEFT JOIN (SELECT product_id FROM m_products WHERE product_category_name IS NOT NULL) p ON orphan = product_id WHERE product_id IS NULL "
    "UNION ALL SELECT 'customer', orphan FROM (SELECT DISTINCT customer_id AS orphan FROM m_orders) LEFT JOIN t_customers ON orphan = customer_id WHERE customer_id IS NULL",
)(
    lambda m: J.orphans(m.order_items, "product_id", m.products.where("product_category_name is not null"), "product_id")
    .select(F.lit("product").alias("kind"), "orphan")
    .unionByName(J.orphans(m.orders, "customer_id", Warehouse(m).customers, "customer_id").select(F.lit("customer").alias("kind"), "orphan"))
)
query(
    "join_self_copurchase",
    "SELECT a.product_id, count(DISTINCT b.product_id) AS n_partners FROM m_items a JOIN m_items b ON a.order_id = b.order_id AND a.product_id <> b.product_id GROUP BY 1",
)(lambda m: B.partner_counts(m.order_items))
query(
    "join_copurchase_pairs",
    "SELECT a.product_id, b.product_id AS partner_id, count(DISTINCT a.order_id) AS n_orders FROM m_items a JOIN m_items b ON a.order_id = b.order_id AND a.product_id <> b.product_id WHERE CAST(a.product_id AS BIGINT) % 100 = 0 GROUP BY 1, 2",
)(lambda m: B.PairTable(m.order_items).partners_of(m.products.where(F.col("product_id").cast("bigint") % 100 == 0)))
query(
    "join_agg_then_join",
    "SELECT i.order_id, i.order_item_id, i.product_id, i.price, p.total_payment FROM m_items i LEFT JOIN (SELECT order_id, CAST(sum(payment_value) AS DECIMAL(18,2)) AS total_payment FROM m_payments GROUP BY 1) p ON i.order_id = p.order_id",
)(
    lambda m: m.order_items.join(m.order_payments.groupBy("order_id").agg(S.money(F.sum("payment_value")).alias("total_payment")), "order_id", "left").select(
        "order_id", "order_item_id", "product_id", "price", "total_payment"
    )
)

# --- aggregates ------------------------------------------------------------------------
query("agg_count", "SELECT order_status, count(*) AS n_rows, count(order_delivered_customer_date) AS n_delivered FROM m_orders GROUP BY 1")(
    lambda m: m.orders.groupBy("order_status").agg(F.count("*").alias("n_rows"), F.count("order_delivered_customer_date").alias("n_delivered"))
)
query("agg_count_distinct", "SELECT seller_id, count(DISTINCT order_id) AS n_orders, count(DISTINCT product_id) AS n_products FROM m_items GROUP BY 1")(
    lambda m: m.order_items.groupBy("seller_id").agg(F.count_distinct("order_id").alias("n_orders"), F.count_distinct("product_id").alias("n_products"))
)
query("agg_sum_avg", f"SELECT product_id, {q.money('round(sum(price), 2)')} AS revenue, {q.avg('price')} AS avg_price, {q.avg('freight_value', 1)} AS avg_freight FROM m_items GROUP BY 1")(
    lambda m: m.order_items.groupBy("product_id").agg(S.money(F.round(F.sum("price"), 2)).alias("revenue"), S.mean("price").alias("avg_price"), S.mean("freight_value", 1).alias("avg_freight"))
)
query("agg_min_max", "SELECT seller_id, min(price) AS min_price, max(price) AS max_price, min(shipping_limit_date) AS first_limit, max(shipping_limit_date) AS last_limit FROM m_items GROUP BY 1")(
    lambda m: m.order_items.groupBy("seller_id").agg(
        F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.min("shipping_limit_date").alias("first_limit"), F.max("shipping_limit_date").alias("last_limit")
    )
)
query("agg_median", "SELECT round(quantile_cont(CAST(price AS DOUBLE), 0.5), 4) AS median_price FROM m_items")(
    lambda m: R.exact_quantiles(m.order_items, "price", {"m": 0.5}).select(F.round("m", 4).alias("median_price"))
)
query("agg_percentile", "SELECT round(quantile_cont(CAST(price AS DOUBLE), 0.5), 4) AS p50, round(quantile_cont(CAST(price AS DOUBLE), 0.99), 4) AS p99 FROM m_items")(
    lambda m: R.exact_quantiles(m.order_items, "price", {"p50": 0.5, "p99": 0.99}).select(F.round("p50", 4).alias("p50"), F.round("p99", 4).alias("p99"))
)
query("agg_stddev", "SELECT seller_id, round(stddev_samp(CAST(price AS DOUBLE)), 4) AS sd_price FROM m_items GROUP BY 1")(
    lambda m: m.order_items.groupBy("seller_id").agg(F.round(F.stddev_samp(F.col("price").cast("double")), 4).alias("sd_price"))
)
query(
    "agg_mode",
    "SELECT geolocation_zip_code_prefix, geolocation_city FROM (SELECT geolocation_zip_code_prefix, geolocation_city, count(*) AS n FROM m_geo GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY n DESC, geolocation_city) = 1",
)(lambda m: C.modal_values(m.geolocation, "geolocation_zip_code_prefix", ["geolocation_city"]))
query("agg_first", "SELECT order_id, arg_min(payment_type, payment_sequential) AS payment_type FROM m_payments GROUP BY 1")(
    lambda m: m.order_payments.groupBy("order_id").agg(F.min_by("payment_type", "payment_sequential").alias("payment_type"))
)
query("agg_collect_list", "SELECT order_id, part, string_agg(product_id, ',' ORDER BY product_id) AS products FROM (SELECT order_id, product_id, (row_number() OVER (PARTITION BY order_id ORDER BY product_id, order_item_id) - 1) // 1000 AS part FROM m_items) GROUP BY 1, 2")(
    lambda m: B.basket_lists(m.order_items).withColumn("products", F.array_join("products", ","))
)
query("agg_string_set", "SELECT order_id, string_agg(DISTINCT payment_type, '|' ORDER BY payment_type) AS payment_types FROM m_payments GROUP BY 1")(
    lambda m: m.order_payments.groupBy("order_id").agg(F.array_join(F.array_sort(F.collect_set("payment_type")), "|").alias("payment_types"))
)
query(
    "agg_conditional",
    "SELECT customer_id, CAST(sum(CASE WHEN order_status = 'delivered' THEN 1 ELSE 0 END) AS BIGINT) AS n_delivered, count(*) FILTER (WHERE order_approved_at IS NULL) AS n_unapproved, max(CASE WHEN order_status = 'canceled' THEN order_purchase_timestamp END) AS last_cancel FROM m_orders GROUP BY 1",
)(
    lambda m: m.orders.groupBy("customer_id").agg(
        F.sum(F.when(F.col("order_status") == "delivered", 1).otherwise(0)).alias("n_delivered"),
        F.count_if(F.col("order_approved_at").isNull()).alias("n_unapproved"),
        F.max(F.when(F.col("order_status") == "canceled", F.col("order_purchase_timestamp"))).alias("last_cancel"),
    )
)
query("agg_having", "SELECT product_id, count(DISTINCT order_id) AS n_orders FROM m_items GROUP BY 1 HAVING count(DISTINCT order_id) >= 30")(
    lambda m: m.order_items.groupBy("product_id").agg(F.count_distinct("order_id").alias("n_orders")).where("n_orders >= 30")
)
query("agg_group_expr", "SELECT coalesce(product_category_name, 'Sem Categoria') AS category, product_photos_qty > 3 AS rich, count(*) AS n FROM m_products GROUP BY 1, 2")(
    lambda m: m.products.groupBy(F.coalesce("product_category_name", F.lit("Sem Categoria")).alias("category"), (F.col("product_photos_qty") > 3).alias("rich")).agg(F.count("*").alias("n"))
)
query("agg_value_counts", "SELECT product_category_name, count(*) AS n FROM m_products WHERE product_category_name IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1")(
    lambda m: A.value_counts(m.products, "product_category_name").orderBy(F.desc("n"), "product_category_name")
)
query(
    "agg_boolean_rate",
    f"SELECT order_status, avg(CASE WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 1.0 ELSE 0.0 END::DOUBLE) AS on_time_rate FROM m_orders GROUP BY 1",
)(lambda m: m.orders.groupBy("order_status").agg(S.share(F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")).alias("on_time_rate")))
query(
    "agg_clip_histogram",
    "SELECT least(CAST(floor(CAST(freight_value AS DOUBLE) / 20) AS INTEGER), 49) AS bin, count(*) AS n, least(CAST(floor(CAST(freight_value AS DOUBLE) / 20) AS INTEGER), 49) * 20.0::DOUBLE AS bin_start FROM m_items WHERE freight_value BETWEEN 0 AND 1000 GROUP BY 1, 3",
)(lambda m: A.histogram(m.order_items, "freight_value", 0, 1000, 50))
_box = "SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM (SELECT CAST(freight_value AS DOUBLE) AS x FROM m_items)"
query(
    "agg_box_stats",
    f"SELECT min(x) AS whisker_low, max(x) AS whisker_high, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3 FROM (SELECT CAST(freight_value AS DOUBLE) AS x FROM m_items), ({_box}) WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)",
)(lambda m: A.box_stats(m.order_items, "freight_value"))
query("agg_distinct", "SELECT count(*) AS n_rows, count(DISTINCT (order_id, order_item_id)) AS n_distinct, count(*) - count(DISTINCT (order_id, order_item_id)) AS n_duplicates FROM m_items")(
    lambda m: A.duplicate_count(m.order_items, ["order_id", "order_item_id"])
)

# --- windows -----------------------------------------------------------------------------
query("win_row_number_dedup", "SELECT customer_unique_id, min(customer_id) AS customer_id FROM m_customers GROUP BY 1")(
    lambda m: C.first_per_key(m.customers, ["customer_unique_id"], [F.col("customer_id")]).select("customer_unique_id", "customer_id")
)
query("win_top1_payment", "SELECT order_id, payment_type, payment_installments, payment_value FROM m_payments QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC, payment_sequential) = 1")(
    lambda m: star.top_payment(m.order_payments)
)
_cat = "SELECT coalesce(product_category_name, 'none') AS category, CAST(sum(price) AS DECIMAL(18,2)) AS revenue FROM m_items JOIN m_products USING (product_id) GROUP BY 1"


def category_revenue(m):
    return (
        m.order_items.join(m.products, "product_id")
        .groupBy(F.coalesce("product_category_name", F.lit("none")).alias("category"))
        .agg(S.money(F.sum("price")).alias("revenue"))
    )


query("win_row_number_global", f"SELECT *, row_number() OVER (ORDER BY revenue DESC, category) AS place FROM ({_cat})")(
    lambda m: R.surrogate_key(category_revenue(m).withColumn("neg", -F.col("revenue")), "place", ["neg", "category"]).select("category", "revenue", "place")
)
_seller = "SELECT seller_id, CAST(sum(price) AS DECIMAL(18,2)) AS revenue, count(*) AS n FROM m_items GROUP BY 1"
query("win_percent_rank", f"SELECT seller_id, percent_rank() OVER (ORDER BY revenue) AS pr_revenue, percent_rank() OVER (ORDER BY n DESC) AS pr_few FROM ({_seller})")(
    lambda m: R.percent_ranks(
        m.order_items.groupBy("seller_id").agg(S.money(F.sum("price")).alias("revenue"), F.count("*").alias("n")),
        {"pr_revenue": ("revenue", False), "pr_few": ("n", True)},
    ).select("seller_id", "pr_revenue", "pr_few")
)
_month = "SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, count(*) AS n FROM m_orders GROUP BY 1"
query("win_lag_growth", f"SELECT month, n, lag(n) OVER (ORDER BY month) AS n_before, {q.pct('n - lag(n) OVER (ORDER BY month)', 'nullif(lag(n) OVER (ORDER BY month), 0)')} AS growth FROM ({_month})")(
    lambda m: m.orders.groupBy(S.month_start("order_purchase_timestamp").alias("month"))
    .agg(F.count("*").alias("n"))
    .withColumn("n_before", F.lag("n").over(W.orderBy("month")))
    .withColumn("growth", S.percent(F.col("n") - F.col("n_before"), "n_before"))
)
query("win_sum_total", f"SELECT category, revenue, {q.pct('revenue', 'sum(revenue) OVER ()')} AS share FROM ({_cat})")(
    lambda m: A.share_of_total(category_revenue(m), "revenue", "share")
)
_status = "SELECT order_status, count(*) AS n FROM m_orders GROUP BY 1"
query("win_max_case_total", f"SELECT order_status, n, {q.pct('n', 'max(CASE WHEN order_status = ' + chr(39) + 'created' + chr(39) + ' THEN n END) OVER ()')} AS of_created FROM ({_status})")(
    lambda m: m.orders.groupBy("order_status")
    .agg(F.count("*").alias("n"))
    .withColumn("of_created", S.percent("n", F.max(F.when(F.col("order_status") == "created", F.col("n"))).over(W.partitionBy())))
)
query("win_sum_of_count", f"SELECT order_status, count(*) AS n, {q.pct('count(*)', 'sum(count(*)) OVER ()')} AS share FROM m_orders GROUP BY 1")(
    lambda m: A.share_of_total(m.orders.groupBy("order_status").agg(F.count("*").alias("n")), "n", "share")
)

# --- sort, limit, top-k ---------------------------------------------------------------------
query("sort_multi", "SELECT customer_state, customer_city, count(*) AS n FROM m_customers GROUP BY 1, 2 ORDER BY n DESC, customer_state, customer_city")(
    lambda m: m.customers.groupBy("customer_state", "customer_city").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "customer_state", "customer_city")
)
query("topk_limit", "SELECT product_id, CAST(sum(price) AS DECIMAL(18,2)) AS revenue FROM m_items GROUP BY 1 ORDER BY revenue DESC, product_id LIMIT 20")(
    lambda m: m.order_items.groupBy("product_id").agg(S.money(F.sum("price")).alias("revenue")).orderBy(F.desc("revenue"), "product_id").limit(20)
)
query("topk_rank_filter", f"SELECT category, revenue, rk AS ranking FROM (SELECT *, CAST(row_number() OVER (ORDER BY revenue DESC, category) AS INTEGER) AS rk FROM ({_cat})) WHERE rk <= 15")(
    lambda m: category_revenue(m).withColumn("ranking", F.row_number().over(W.orderBy(F.desc("revenue"), "category"))).where("ranking <= 15")
)
query(
    "topk_per_key",
    "SELECT seller_id, product_id, n, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY n DESC, product_id) AS rn FROM (SELECT seller_id, product_id, count(*) AS n FROM m_items GROUP BY 1, 2)) WHERE rn <= 10",
)(
    lambda m: m.order_items.groupBy("seller_id", "product_id")
    .agg(F.count("*").alias("n"))
    .withColumn("rn", F.row_number().over(W.partitionBy("seller_id").orderBy(F.desc("n"), "product_id")))
    .where("rn <= 10")
)
query("sample_n", "SELECT product_id FROM m_products ORDER BY md5(product_id), product_id LIMIT 500")(lambda m: A.sample_rows(m.products.select("product_id"), 500, "product_id"))

# --- set operations ------------------------------------------------------------------------------
query("set_difference", "SELECT product_id FROM m_products EXCEPT SELECT product_id FROM m_items WHERE order_item_id = 1")(
    lambda m: m.products.select("product_id").subtract(m.order_items.where("order_item_id = 1").select("product_id"))
)
query(
    "set_intersection_hits",
    "SELECT a.seller_id, count(*) AS hits FROM (SELECT DISTINCT seller_id, product_id FROM m_items WHERE order_item_id = 1) a JOIN (SELECT DISTINCT seller_id, product_id FROM m_items WHERE order_item_id = 2) b ON a.seller_id = b.seller_id AND a.product_id = b.product_id GROUP BY 1",
)(
    lambda m: (lambda pairs: pairs(1).join(pairs(2), ["seller_id", "product_id"]).groupBy("seller_id").agg(F.count("*").alias("hits")))(
        lambda i: m.order_items.where(F.col("order_item_id") == i).select("seller_id", "product_id").distinct()
    )
)
query("set_union_rows", "SELECT customer_id AS id, 'customer' AS kind FROM m_customers UNION ALL SELECT seller_id, 'seller' FROM m_sellers")(
    lambda m: m.customers.select(F.col("customer_id").alias("id"), F.lit("customer").alias("kind")).unionByName(m.sellers.select(F.col("seller_id").alias("id"), F.lit("seller").alias("kind")))
)
query("set_union_tags", "SELECT id, array_to_string(list_sort(list_distinct(list_concat(tags, ['reviewed', 'en']))), ',') AS tags FROM m_assets")(
    lambda m: m.assets.select("id", F.array_join(F.array_sort(F.array_union("tags", F.array(F.lit("reviewed"), F.lit("en")))), ",").alias("tags"))
)
