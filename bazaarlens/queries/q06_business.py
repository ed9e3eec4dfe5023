"""Dashboards, reference star queries, KPIs."""

from __future__ import annotations

from bazaarlens.functions import fixed
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.plans import business as P
from bazaarlens.queries.q03_star import Warehouse

_total = "price + freight_value"
query(
    "dash_category_revenue",
    f"""WITH r AS (SELECT coalesce(t.product_category_name_english, p.product_category_name, 'Sem Categoria') AS categoria, count(DISTINCT oi.order_id) AS n,
      CAST(sum({_total}) AS DECIMAL(18,2)) AS receita, {q.avg('price')} AS ticket
      FROM m_items oi JOIN m_products p ON oi.product_id = p.product_id LEFT JOIN m_translation t ON p.product_category_name = t.product_category_name GROUP BY 1)
    SELECT CAST(row_number() OVER (ORDER BY receita DESC, categoria) AS INTEGER) AS "Ranking", categoria AS "Categoria", n AS "Total de Pedidos", receita AS "Receita Total (R$)", ticket AS "Ticket Médio (R$)",
      {q.pct('receita', 'sum(receita) OVER ()')} AS "% da Receita Total" FROM r QUALIFY "Ranking" <= 15""",
)(lambda m: P.category_revenue(m.order_items, m.products, m.translation))
MONTHLY_SQL = f"""WITH r AS (SELECT date_trunc('month', order_purchase_timestamp) AS mes, count(DISTINCT o.order_id) AS n, count(DISTINCT o.customer_id) AS c, CAST(sum({_total}) AS DECIMAL(18,2)) AS receita, {q.avg(_total)} AS ticket
      FROM m_orders o JOIN m_items oi ON o.order_id = oi.order_id WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY 1), s AS (SELECT *, lag(receita) OVER (ORDER BY mes) AS antes FROM r)
    SELECT strftime(mes, '%Y-%m') AS "Ano-Mês", n AS "Total de Pedidos", c AS "Clientes Únicos", receita AS "Receita Total (R$)", ticket AS "Ticket Médio (R$)", {q.pct('receita - antes', 'antes')} AS "Crescimento MoM (%)" FROM s"""
query("dash_monthly_sales", MONTHLY_SQL)(lambda m: P.monthly_sales(m.orders, m.order_items))
_labels = "CASE payment_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.PAYMENT_LABELS.items()) + " ELSE 'Outros' END"
query(
    "dash_payment_mix",
    f"""WITH r AS (SELECT payment_type, count(DISTINCT order_id) AS n, CAST(sum(payment_value) AS DECIMAL(18,2)) AS valor, {q.avg('payment_installments', 1)} AS parcelas FROM m_payments GROUP BY 1)
    SELECT {_labels} AS "Método de Pagamento", n AS "Total de Pedidos", {q.pct('n', 'sum(n) OVER ()')} AS "Participação (%)", valor AS "Valor Total Pago (R$)", parcelas AS "Média de Parcelas" FROM r""",
)(lambda m: P.payment_mix(m.order_payments))
query(
    "dash_state_orders",
    f"""WITH r AS (SELECT customer_state AS uf, count(DISTINCT o.order_id) AS n, count(DISTINCT o.customer_id) AS c, CAST(sum({_total}) AS DECIMAL(18,2)) AS receita, {q.avg('freight_value')} AS frete,
      {q.avg("date_diff('day', order_purchase_timestamp, order_delivered_customer_date)", 1)} AS prazo
      FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id JOIN m_items oi ON o.order_id = oi.order_id WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL GROUP BY 1)
    SELECT uf AS "Estado (UF)", n AS "Total de Pedidos", c AS "Clientes Únicos", receita AS "Receita Total (R$)", {q.pct('n', 'sum(n) OVER ()')} AS "% do Total Nacional", frete AS "Frete Médio (R$)", prazo AS "Prazo Médio de Entrega (dias)" FROM r""",
)(lambda m: P.state_orders(m.orders, m.customers, m.order_items))
query(
    "dash_seller_ranking",
    f"""WITH r AS (SELECT s.seller_id, seller_city, seller_state, count(DISTINCT oi.order_id) AS n, count(DISTINCT product_id) AS skus, CAST(sum({_total}) AS DECIMAL(18,2)) AS receita, {q.avg('price')} AS preco,
      {q.avg('review_score')} AS nota, count(review_id) AS av, {q.avg("date_diff('day', order_purchase_timestamp, order_delivered_carrier_date)", 1)} AS dias
      FROM m_sellers s JOIN m_items oi ON s.seller_id = oi.seller_id JOIN m_orders o ON oi.order_id = o.order_id LEFT JOIN m_reviews r ON o.order_id = r.order_id WHERE order_status = 'delivered' GROUP BY 1, 2, 3),
    sc AS (SELECT *, round(percent_rank() OVER (ORDER BY receita NULLS LAST) * 0.50 + percent_rank() OVER (ORDER BY nota NULLS LAST) * 0.35 + percent_rank() OVER (ORDER BY dias DESC NULLS FIRST) * 0.15, 4) AS score FROM r WHERE n >= 10)
    SELECT CAST(row_number() OVER (ORDER BY score DESC, seller_id) AS INTEGER) AS "Ranking", seller_id AS "ID do Vendedor", seller_city AS "Cidade", seller_state AS "Estado", n AS "Total de Pedidos", skus AS "SKUs Distintos", receita AS "Receita Total (R$)",
      preco AS "Preço Médio (R$)", nota AS "Nota Média", av AS "Total de Avaliações", dias AS "Dias Médios p/ Despacho", round(score * 100, 2) AS "Score de Performance (%)" FROM sc QUALIFY "Ranking" <= 20""",
)(lambda m: P.seller_ranking(m.sellers, m.order_items, m.orders, m.order_reviews))
query(
    "dash_price_vs_rating",
    f"""SELECT coalesce(t.product_category_name_english, p.product_category_name, 'Sem Categoria') AS "Categoria", {q.avg('price')} AS "Preço Médio (R$)", {q.avg('review_score')} AS "Nota Média (0-5)",
      CAST(sum({_total}) AS DECIMAL(18,2)) AS "Receita Total (R$)", count(DISTINCT oi.order_id) AS "Total de Pedidos", {q.avg('freight_value')} AS "Frete Médio (R$)", count(review_id) AS "Total de Avaliações"
    FROM m_items oi JOIN m_products p ON oi.product_id = p.product_id JOIN m_orders o ON oi.order_id = o.order_id LEFT JOIN m_reviews r ON o.order_id = r.order_id
    LEFT JOIN m_translation t ON p.product_category_name = t.product_category_name WHERE order_status = 'delivered' AND review_score IS NOT NULL GROUP BY 1 HAVING count(DISTINCT oi.order_id) >= 50""",
)(lambda m: P.price_vs_rating(m.order_items, m.products, m.orders, m.order_reviews, m.translation))
_place = "CASE order_status " + " ".join(f"WHEN '{s}' THEN {i + 1}" for i, (s, _) in enumerate(fixed.FUNNEL)) + " ELSE 9 END"
_name = "CASE order_status " + " ".join(f"WHEN '{s}' THEN '{n}'" for s, n in fixed.FUNNEL) + " ELSE order_status END"
query(
    "dash_status_funnel",
    f"""WITH r AS (SELECT CAST({_place} AS INTEGER) AS o, {_name} AS s, count(DISTINCT order_id) AS n FROM m_orders GROUP BY 1, 2)
    SELECT o AS "Ordem", s AS "Status do Pedido", n AS "Total de Pedidos", {q.pct('n', 'sum(n) OVER ()')} AS "% do Total", {q.pct('n', 'max(CASE WHEN o = 1 THEN n END) OVER ()')} AS "% Relativo ao Topo do Funil" FROM r""",
)(lambda m: P.status_funnel(m.orders))

query(
    "star_month_category",
    """SELECT d.year, d.month, d.month_name, p.product_category_english, count(DISTINCT fo.order_id) AS total_orders, count(*) AS total_items, CAST(sum(price) AS DECIMAL(18,2)) AS gross_revenue,
      CAST(sum(freight_value) AS DECIMAL(18,2)) AS total_freight, CAST(sum(price + freight_value) AS DECIMAL(18,2)) AS total_gmv
    FROM f_orders fo JOIN d_date d ON fo.purchase_date_key = d.date_key JOIN d_product p ON fo.product_key = p.product_key WHERE d.year = 2017 AND fo.order_status = 'DELIVERED' GROUP BY 1, 2, 3, 4""",
)(lambda m: (lambda w: P.star_month_category(w.fact_lines, w.dates, w.dim_product))(Warehouse(m)))
query(
    "star_rating_by_seller_state",
    f"""SELECT seller_state, count(*) AS total_reviews, {q.avg('fr.review_score', 4)} AS avg_score, {q.avg('fr.response_time_hours', 4)} AS avg_response_hours
    FROM f_reviews fr JOIN f_orders fo ON fr.order_id = fo.order_id JOIN d_seller s ON fo.seller_key = s.seller_key GROUP BY 1""",
)(lambda m: (lambda w: P.star_rating_by_seller_state(w.fact_reviews, w.dim_customer, w.fact_lines, w.dim_seller))(Warehouse(m)))
query(
    "star_weekend_split",
    f"""SELECT is_weekend, day_of_week_name, count(DISTINCT order_id) AS total_orders, CAST(sum(price) AS DECIMAL(18,2)) AS gross_revenue, {q.avg('price')} AS avg_order_value
    FROM f_orders fo JOIN d_date d ON fo.purchase_date_key = d.date_key WHERE fo.order_status = 'DELIVERED' GROUP BY 1, 2""",
)(lambda m: (lambda w: P.star_weekend_split(w.fact_lines, w.dates))(Warehouse(m)))
query("kpi_average_ticket", f"SELECT {q.rdiv('sum(price + freight_value)', 'count(DISTINCT order_id)')} AS average_ticket FROM m_items")(lambda m: P.average_ticket(m.order_items))
query("kpi_cancel_rate", f"""SELECT {q.rdiv("count(*) FILTER (WHERE order_status = 'canceled')", "count(*)", 4)} AS cancel_rate FROM m_orders""")(lambda m: P.cancel_rate(m.orders))
query(
    "kpi_seller_performance",
    f"""SELECT seller_id, {q.rdiv("count(*) FILTER (WHERE order_delivered_carrier_date <= shipping_limit_date)", "count(*) FILTER (WHERE order_delivered_carrier_date IS NOT NULL)", 4)} AS dispatch_on_time,
      {q.rdiv('sum(stars)', 'sum(ns)', 4)} AS avg_rating, {q.rdiv('sum(price + freight_value)', 'count(DISTINCT i.order_id)')} AS ticket, count(DISTINCT i.order_id) AS n_orders, count(*) AS n_items
    FROM m_items i JOIN m_orders o ON i.order_id = o.order_id LEFT JOIN (SELECT order_id, sum(review_score) AS stars, count(review_score) AS ns FROM m_reviews GROUP BY 1) r ON i.order_id = r.order_id GROUP BY 1""",
)(lambda m: P.seller_performance(m.order_items, m.orders, m.order_reviews))
