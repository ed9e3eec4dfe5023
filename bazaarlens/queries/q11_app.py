"""App-level analytics and catalogue operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.operators import catalog as K
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.oracle.tables import lib
from bazaarlens.queries import q10_text

query(
    "app_home_counts",
    "SELECT (SELECT count(DISTINCT order_id) FROM m_orders) AS n_orders, (SELECT count(DISTINCT product_id) FROM m_products) AS n_products, (SELECT count(DISTINCT customer_unique_id) FROM m_customers) AS n_customers, (SELECT count(DISTINCT seller_id) FROM m_sellers) AS n_sellers",
)(
    lambda m: m.orders.agg(F.count_distinct("order_id").alias("n_orders")).withColumns(
        {
            "n_products": m.products.select(F.count_distinct("product_id")).scalar(),
            "n_customers": m.customers.select(F.count_distinct("customer_unique_id")).scalar(),
            "n_sellers": m.sellers.select(F.count_distinct("seller_id")).scalar(),
        }
    )
)
lib.add(
    "a_base",
    """SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_delivered_customer_date, o.order_estimated_delivery_date, i.order_item_id, i.product_id, i.price, i.freight_value, c.customer_state, p.product_category_name, r.avg_review_score
    FROM m_orders o LEFT JOIN m_items i ON o.order_id = i.order_id LEFT JOIN m_customers c ON o.customer_id = c.customer_id LEFT JOIN m_products p ON i.product_id = p.product_id
    LEFT JOIN (SELECT order_id, avg(review_score) AS avg_review_score FROM m_reviews GROUP BY 1) r ON o.order_id = r.order_id""",
)


def base(m) -> DataFrame:
    """One row per order line with its order, customer state, category and mean review score."""
    rated = m.order_reviews.groupBy("order_id").agg(F.avg("review_score").alias("avg_review_score"))
    per_order = (
        m.orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")
        .join(m.customers.select("customer_id", "customer_state"), "customer_id", "left")
        .join(rated, "order_id", "left")
    )
    lines = m.order_items.select("order_id", "order_item_id", "product_id", "price", "freight_value").join(
        m.products.select("product_id", "product_category_name"), "product_id", "left"
    )
    return per_order.join(lines, "order_id", "left")


query("app_analytics_base", "SELECT * FROM a_base")(base)


def filtered(df: DataFrame, start: str | None = None, end: str | None = None, states: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    if start:
        df = df.where(F.col("order_purchase_timestamp") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        df = df.where(F.col("order_purchase_timestamp") < F.lit(end).cast("timestamp_ntz"))
    if states:
        df = df.where(F.col("customer_state").isin(states))
    return df.where(F.col("product_category_name").isin(categories)) if categories else df


query(
    "app_filtered_kpis",
    f"""SELECT count(DISTINCT order_id) AS pedidos, {q.money('sum(price + freight_value)')} AS receita, {q.rdiv('sum(price + freight_value)', 'count(DISTINCT order_id)')} AS ticket, count(DISTINCT customer_id) AS clientes, round(avg(avg_review_score), 4) AS nota
    FROM a_base WHERE order_purchase_timestamp >= TIMESTAMP '2017-01-01' AND order_purchase_timestamp < TIMESTAMP '2018-01-01' AND customer_state IN ('SP', 'RJ', 'MG')""",
)(
    lambda m: filtered(base(m), "2017-01-01", "2018-01-01", ["SP", "RJ", "MG"]).agg(
        F.count_distinct("order_id").alias("pedidos"),
        S.money(F.sum(F.col("price") + F.col("freight_value"))).alias("receita"),
        S.ratio(F.sum(F.col("price") + F.col("freight_value")), F.count_distinct("order_id")).alias("ticket"),
        F.count_distinct("customer_id").alias("clientes"),
        F.round(F.avg("avg_review_score"), 4).alias("nota"),
    )
)
query("app_revenue_over_time", f"SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, {q.money('sum(price + freight_value)')} AS receita FROM m_orders JOIN m_items USING (order_id) GROUP BY 1")(
    lambda m: m.orders.select("order_id", F.date_format("order_purchase_timestamp", "yyyy-MM").alias("year_month"))
    .join(m.order_items, "order_id")
    .groupBy("year_month")
    .agg(S.money(F.sum(F.col("price") + F.col("freight_value"))).alias("receita"))
    .orderBy("year_month")
)
query("app_orders_by_weekday", "SELECT CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS weekday, count(*) AS pedidos FROM m_orders GROUP BY 1")(
    lambda m: m.orders.groupBy(F.weekday("order_purchase_timestamp").alias("weekday")).agg(F.count("*").alias("pedidos")).orderBy("weekday")
)
query("app_revenue_by_state", f"SELECT customer_state, {q.money('sum(price + freight_value)')} AS receita FROM m_orders JOIN m_items USING (order_id) JOIN m_customers USING (customer_id) GROUP BY 1")(
    lambda m: m.orders.select("order_id", "customer_id")
    .join(m.customers.select("customer_id", "customer_state"), "customer_id")
    .join(m.order_items.select("order_id", "price", "freight_value"), "order_id")
    .groupBy("customer_state")
    .agg(S.money(F.sum(F.col("price") + F.col("freight_value"))).alias("receita"))
    .orderBy(F.desc("receita"), "customer_state")
)
_d = "order_delivered_customer_date"
query(
    "app_late_rate",
    f"SELECT {q.floor_days('order_purchase_timestamp', _d)} AS delivery_days, count(*) AS pedidos, count(*) FILTER (WHERE {_d} > order_estimated_delivery_date) AS atrasados, {q.pct(f'sum(count(*) FILTER (WHERE {_d} > order_estimated_delivery_date)) OVER ()', 'sum(count(*)) OVER ()')} AS late_pct FROM m_orders WHERE {_d} IS NOT NULL GROUP BY 1",
)(lambda m: _late(m))


def _late(m) -> DataFrame:
    from pyspark.sql import Window as W

    done = m.orders.where(F.col(_d).isNotNull())
    by_day = done.groupBy(S.floor_days("order_purchase_timestamp", _d).alias("delivery_days")).agg(
        F.count("*").alias("pedidos"), F.count_if(F.col(_d) > F.col("order_estimated_delivery_date")).alias("atrasados")
    )
    whole = W.partitionBy()
    return by_day.withColumn("late_pct", S.percent(F.sum("atrasados").over(whole), F.sum("pedidos").over(whole))).orderBy("delivery_days")


# --- extracted features in the app: sentiment from reviews, tier from price, tags from keywords ---
lib.add(
    "a_genai",
    f"""SELECT x.product_id, llm_category AS category, v.confidence_score, {q.price_tier('CAST(t.price / 40 AS DECIMAL(12,2))')} AS tier, CASE WHEN score >= 4 THEN 'POSITIVE' WHEN score = 3 THEN 'NEUTRAL' WHEN score IS NOT NULL THEN 'NEGATIVE' END AS sentiment, llm_keywords
    FROM x_flat x JOIN m_texts t ON x.product_id = t.product_id LEFT JOIN m_vectors v ON x.product_id = v.product_id
    LEFT JOIN (SELECT product_id, round(avg(review_score)) AS score FROM m_items JOIN m_reviews USING (order_id) GROUP BY 1) r ON x.product_id = r.product_id WHERE extraction_status = 'SUCCESS'""",
)


def genai(m) -> DataFrame:
    per_order = m.order_reviews.groupBy("order_id").agg(F.sum("review_score").alias("s"), F.count("review_score").alias("n"))
    rated = m.order_items.select("order_id", "product_id").join(per_order, "order_id").groupBy("product_id").agg(F.round(F.sum("s") / F.sum("n")).alias("score"))
    return (
        q10_text.results(m).where("extraction_status = 'SUCCESS'")
        .join(m.product_texts.select("product_id", S.price_tier((F.col("price") / 40).cast("decimal(12,2)")).alias("tier")), "product_id")
        .join(m.embeddings.select("product_id", "confidence_score"), "product_id", "left")
        .join(rated, "product_id", "left")
        .select(
            "product_id", F.col("llm_category").alias("category"), "confidence_score", "tier",
            F.when(F.col("score").isNotNull(), S.sentiment_band("score")).alias("sentiment"), "llm_keywords",
        )
    )


query(
    "app_genai_kpis",
    f"""SELECT count(*) AS products, round(avg(confidence_score), 6) AS mean_confidence, {q.pct("count(*) FILTER (WHERE sentiment = 'POSITIVE')", "count(*)", 1)} AS positive_pct, {q.pct("count(*) FILTER (WHERE tier = 'Premium')", "count(*)", 1)} AS premium_pct, count(DISTINCT category) AS categories FROM a_genai""",
)(
    lambda m: genai(m).agg(
        F.count("*").alias("products"),
        F.round(F.avg("confidence_score"), 6).alias("mean_confidence"),
        S.percent(F.count_if(F.col("sentiment") == "POSITIVE"), F.count("*"), 1).alias("positive_pct"),
        S.percent(F.count_if(F.col("tier") == "Premium"), F.count("*"), 1).alias("premium_pct"),
        F.count_distinct("category").alias("categories"),
    )
)
query(
    "app_tier_by_category",
    """SELECT category, count(*) FILTER (WHERE tier = 'Budget') AS budget, count(*) FILTER (WHERE tier = 'Mid-range') AS mid_range, count(*) FILTER (WHERE tier = 'Premium') AS premium FROM a_genai GROUP BY 1""",
)(
    lambda m: genai(m).groupBy("category").pivot("tier", ["Budget", "Mid-range", "Premium"]).count().fillna(0)
    .select("category", F.col("Budget").alias("budget"), F.col("Mid-range").alias("mid_range"), F.col("Premium").alias("premium"))
)
query("app_use_case_tags", "SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(llm_keywords, ', ')) AS tag FROM a_genai WHERE llm_keywords <> '') GROUP BY 1")(
    lambda m: genai(m).where("llm_keywords <> ''").select(F.explode(F.split("llm_keywords", ", ")).alias("tag")).groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag")
)

# --- catalogue ----------------------------------------------------------------------------------
_tags = "array_to_string(tags, ',') AS tags"
_cols = ["id", "name", "type", "asset_type", "assetType", "description"]
query("cat_list_page", f"SELECT id, name FROM m_assets ORDER BY id LIMIT 100 OFFSET 200")(lambda m: K.page(m.assets.select("id", "name"), 3, 100))
query("cat_list_all", f"SELECT * REPLACE ({_tags}) FROM m_assets")(lambda m: m.assets.withColumn("tags", F.array_join("tags", ",")))
query("cat_filter_type", """SELECT id, name FROM m_assets WHERE lower(type) = 'table' OR lower(asset_type) = 'table' OR lower("assetType") = 'table'""")(
    lambda m: K.filter_type(m.assets, "TABLE").select("id", "name")
)
query("cat_search", "SELECT id, name FROM m_assets WHERE contains(lower(name), 'de') OR contains(lower(description), 'de') OR len(list_filter(tags, lambda t: contains(lower(t), 'de'))) > 0")(
    lambda m: K.search(m.assets, "De").select("id", "name")
)
query("cat_summary", """SELECT coalesce(type, asset_type, "assetType", 'unknown') AS asset_type, count(*) AS n FROM m_assets GROUP BY 1""")(lambda m: K.summary(m.assets))
@query(
    "cat_merge_tags",
    """SELECT id, CASE WHEN id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN array_to_string(list_sort(list_distinct(list_concat(tags, ['good', 'en']))), ',') ELSE array_to_string(tags, ',') END AS tags,
    CASE WHEN id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'good,en' ELSE array_to_string(tags, ',') END AS tags_replaced FROM m_assets""",
)
def _(m):
    good = m.table("labels").where("quality = 1").select(F.col("doc_id").alias("id"))
    added = K.merge_tags(m.assets, good, ["good", "en"]).select("id", F.array_join("tags", ",").alias("tags"))
    replaced = K.merge_tags(m.assets, good, ["good", "en"], append=False).select("id", F.array_join("tags", ",").alias("tags_replaced"))
    return added.join(replaced, "id")
