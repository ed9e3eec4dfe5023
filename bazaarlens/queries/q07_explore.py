"""Exploratory analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators import aggregates as A
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.plans import explore as P

# column types as Spark names them, by logical table
TS, D, S_, I, DBL = "timestamp_ntz", "decimal(12,2)", "string", "int", "double"
COLUMNS = {
    "orders": ("m_orders", {"order_id": S_, "customer_id": S_, "order_status": S_, "order_purchase_timestamp": TS, "order_approved_at": TS,
                            "order_delivered_carrier_date": TS, "order_delivered_customer_date": TS, "order_estimated_delivery_date": TS}),
    "order_items": ("m_items", {"order_id": S_, "order_item_id": I, "product_id": S_, "seller_id": S_, "shipping_limit_date": TS, "price": D, "freight_value": D}),
    "order_payments": ("m_payments", {"order_id": S_, "payment_sequential": I, "payment_type": S_, "payment_installments": I, "payment_value": D}),
    "order_reviews": ("m_reviews", {"review_id": S_, "order_id": S_, "review_score": I, "review_comment_title": S_, "review_comment_message": S_,
                                    "review_creation_date": TS, "review_answer_timestamp": TS}),
    "customers": ("m_customers", {"customer_id": S_, "customer_unique_id": S_, "customer_zip_code_prefix": S_, "customer_city": S_, "customer_state": S_}),
    "products": ("m_products", {"product_id": S_, "product_category_name": S_, "product_name_lenght": I, "product_description_lenght": I, "product_photos_qty": I,
                                "product_weight_g": DBL, "product_length_cm": DBL, "product_height_cm": DBL, "product_width_cm": DBL}),
    "sellers": ("m_sellers", {"seller_id": S_, "seller_zip_code_prefix": S_, "seller_city": S_, "seller_state": S_}),
    "geolocation": ("m_geo", {"geolocation_zip_code_prefix": S_, "geolocation_lat": DBL, "geolocation_lng": DBL, "geolocation_city": S_, "geolocation_state": S_}),
    "translation": ("m_translation", {"product_category_name": S_, "product_category_name_english": S_}),
}
PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS column_type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, {q.pct(f'count(*) - count({c})', 'count(*)')} AS pct_nulls FROM {src}"
    for t, (src, cols) in COLUMNS.items()
    for c, k in cols.items()
)
query("eda_table_profile", PROFILE_SQL)(lambda m: P.profiles({t: getattr(m, t) for t in COLUMNS}))
_quality = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({len(cols)} AS INTEGER) AS n_columns, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS n_duplicates, "
    f"{q.pct(f'count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src}))', 'count(*)')} AS pct_duplicates, CAST({' + '.join(f'CAST(count({c}) < count(*) AS INTEGER)' for c in cols)} AS INTEGER) AS n_columns_with_nulls FROM {src}"
    for t, (src, cols) in COLUMNS.items()
)
query("eda_quality_profile", _quality)(lambda m: reduce(DataFrame.unionByName, [P.quality_profile(t, getattr(m, t)) for t in COLUMNS]))
query("eda_status_distribution", f"SELECT order_status, count(*) AS n, {q.pct('count(*)', 'sum(count(*)) OVER ()')} AS pct FROM m_orders GROUP BY 1")(lambda m: P.status_distribution(m.orders))
query("eda_monthly_orders", "SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, count(*) AS pedidos FROM m_orders GROUP BY 1")(lambda m: P.monthly_orders(m.orders))
VALUES = """SELECT order_id, CAST(sum(price) AS DECIMAL(18,2)) AS total_price, CAST(sum(freight_value) AS DECIMAL(18,2)) AS total_freight, count(order_item_id) AS items_count, CAST(sum(price + freight_value) AS DECIMAL(18,2)) AS total_order FROM m_items GROUP BY 1"""
SUMMARY = f"""SELECT CAST(sum(total_price) AS DECIMAL(18,2)) AS receita_produtos, CAST(sum(total_freight) AS DECIMAL(18,2)) AS frete_total, CAST(sum(total_order) AS DECIMAL(18,2)) AS receita_total,
  {q.avg('total_order')} AS ticket_medio, {q.avg('items_count')} AS itens_por_pedido, round(quantile_cont(CAST(total_order AS DOUBLE), 0.5), 4) AS ticket_mediano FROM ({VALUES})"""
query("eda_order_values", SUMMARY)(lambda m: P.order_value_summary(m.order_items))
_hist = f"""SELECT 'bin' AS kind, least(CAST(floor(CAST(total_freight AS DOUBLE) / 20) AS INTEGER), 49) AS position, CAST(count(*) AS DOUBLE) AS amount FROM ({VALUES}) WHERE total_freight BETWEEN 0 AND 1000 GROUP BY 2"""
_box = f"""SELECT name, val FROM (SELECT unnest(['q1', 'median', 'q3', 'whisker_low', 'whisker_high']) AS name, unnest([any_value(q1), any_value(med), any_value(q3), min(x), max(x)]) AS val
  FROM (SELECT CAST(total_order AS DOUBLE) AS x FROM ({VALUES})), (SELECT quantile_cont(CAST(total_order AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(total_order AS DOUBLE), 0.5) AS med, quantile_cont(CAST(total_order AS DOUBLE), 0.75) AS q3 FROM ({VALUES}))
  WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))"""


@query("eda_order_value_hist", f"{_hist} UNION ALL SELECT name, NULL, round(val, 6) FROM ({_box})")
def _(m):
    values = P.order_values(m.order_items)
    bins = A.histogram(values, "total_freight", 0, 1000, 50).select(F.lit("bin").alias("kind"), F.col("bin").alias("position"), F.col("n").cast("double").alias("amount"))
    box = A.box_stats(values, "total_order").unpivot([], ["q1", "median", "q3", "whisker_low", "whisker_high"], "kind", "amount")
    return bins.unionByName(box.select("kind", F.lit(None).cast("int").alias("position"), F.round("amount", 6).alias("amount")))


TOP = f"""SELECT product_category_name_english, CAST(sum(price) AS DECIMAL(18,2)) AS receita, count(DISTINCT order_id) AS pedidos, count(order_item_id) AS items, {q.avg('price')} AS ticket_medio
FROM m_items i JOIN m_products p ON i.product_id = p.product_id JOIN m_translation t ON p.product_category_name = t.product_category_name GROUP BY 1 ORDER BY receita DESC, 1"""
query("eda_top_categories", TOP + " LIMIT 15")(lambda m: P.top_categories(m.order_items, m.products, m.translation))
STATES = "SELECT customer_state, count(*) AS pedidos, CAST(row_number() OVER (ORDER BY count(*) DESC, customer_state) AS INTEGER) AS posicao FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id GROUP BY 1"
query(
    "eda_orders_by_state",
    f"SELECT *, {q.pct('pedidos', '(SELECT count(*) FROM m_orders)')} AS pct, {q.pct('sum(CASE WHEN posicao <= 5 THEN pedidos END) OVER ()', '(SELECT count(*) FROM m_orders)')} AS top5_pct FROM ({STATES})",
)(lambda m: P.orders_by_state(m.orders, m.customers))
query(
    "eda_payment_methods",
    f"SELECT payment_type, count(*) AS transacoes, CAST(sum(payment_value) AS DECIMAL(18,2)) AS valor_total, {q.avg('payment_value')} AS valor_medio, {q.avg('payment_installments')} AS parcelas_media, {q.pct('count(*)', 'sum(count(*)) OVER ()')} AS pct FROM m_payments GROUP BY 1",
)(lambda m: P.payment_methods(m.order_payments))
query("eda_installment_hist", "SELECT least(payment_installments, 23) AS parcelas, count(*) AS n FROM m_payments WHERE payment_type = 'credit_card' AND payment_installments BETWEEN 1 AND 24 GROUP BY 1")(
    lambda m: P.installment_hist(m.order_payments)
)
query(
    "eda_review_scores",
    f"SELECT review_score, count(*) AS n, {q.pct('count(*)', 'sum(count(*)) OVER ()')} AS pct, (SELECT {q.avg('review_score')} FROM m_reviews) AS nota_media, (SELECT quantile_cont(CAST(review_score AS DOUBLE), 0.5) FROM m_reviews) AS nota_mediana FROM m_reviews GROUP BY 1",
)(lambda m: P.review_scores(m.order_reviews))
NPS = f"""SELECT count(*) FILTER (WHERE review_score >= 4) AS promotores, count(*) FILTER (WHERE review_score = 3) AS neutros, count(*) FILTER (WHERE review_score <= 2) AS detratores,
  {q.pct('count(*) FILTER (WHERE review_score >= 4) - count(*) FILTER (WHERE review_score <= 2)', 'count(*)')} AS nps FROM m_reviews"""
query("eda_nps", NPS)(lambda m: P.nps(m.order_reviews))
DELIVERED = f"SELECT {q.floor_days('order_purchase_timestamp', 'order_delivered_customer_date')} AS days, {q.floor_days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS delay FROM m_orders WHERE order_status = 'delivered'"
METRICS = f"""SELECT {q.avg('days', 1)} AS tempo_medio, count(*) FILTER (WHERE delay <= 0) AS no_prazo, {q.pct('count(*) FILTER (WHERE delay <= 0)', 'count(*)', 1)} AS pct_no_prazo, count(*) FILTER (WHERE delay > 0) AS atrasadas,
  {q.pct('count(*) FILTER (WHERE delay > 0)', 'count(*)', 1)} AS pct_atrasadas, {q.avg('CASE WHEN delay > 0 THEN delay END', 1)} AS atraso_medio, quantile_cont(CAST(days AS DOUBLE), 0.5) AS tempo_mediano FROM ({DELIVERED})"""
query("eda_delivery_metrics", METRICS)(lambda m: P.delivery_metrics(m.orders))
query("eda_delivery_hist", f"SELECT least(CAST(floor(d / 2.0) AS INTEGER), 29) AS bin, count(*) AS n, least(floor(d / 2.0), 29) * 2.0::DOUBLE AS bin_start FROM (SELECT CASE WHEN days IS NOT NULL THEN least(greatest(days, 0), 60) END::DOUBLE AS d FROM ({DELIVERED})) WHERE d IS NOT NULL GROUP BY 1, 3")(
    lambda m: P.delivery_hist(m.orders)
)
query(
    "eda_executive_summary",
    f"""SELECT (SELECT count(*) FROM m_orders) AS pedidos, (SELECT count(*) FROM m_items) AS itens, (SELECT count(*) FROM m_customers) AS clientes, (SELECT count(*) FROM m_products) AS produtos, (SELECT count(*) FROM m_sellers) AS vendedores,
    v.receita_total, v.ticket_medio, v.ticket_mediano, (SELECT {q.avg('review_score')} FROM m_reviews) AS nota_media, n.nps, (SELECT {q.pct('count(*) FILTER (WHERE review_score >= 4)', 'count(*)', 1)} FROM m_reviews) AS pct_promotores,
    d.tempo_medio, d.pct_no_prazo, (SELECT count(*) FROM ({STATES})) AS estados, s.customer_state AS top_estado, s.pedidos AS top_estado_pedidos,
    (SELECT count(DISTINCT product_category_name) FROM m_products) AS categorias, t.product_category_name_english AS top_categoria
    FROM ({SUMMARY}) v, ({NPS}) n, ({METRICS}) d, (SELECT * FROM ({STATES}) WHERE posicao = 1) s, ({TOP} LIMIT 1) t""",
)(P.executive_summary)
