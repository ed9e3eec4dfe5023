"""Product features, text vectors, recommendations, delivery-time model, embeddings."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.operators import cleaning as C
from bazaarlens.operators import embeddings as E
from bazaarlens.operators import learning as L
from bazaarlens.operators import neighbours as N
from bazaarlens.operators import textvec as V
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.oracle.tables import lib
from bazaarlens.queries.q01_sources import LandingView
from bazaarlens.queries.q03_star import notebook
from bazaarlens.sources import io

TOP = 10
DIM = 64

lib.add(
    "p_features",
    f"""SELECT p.*, coalesce(order_count, 0) AS order_count, coalesce(avg_price, 0) AS avg_price, coalesce(avg_freight, 0) AS avg_freight, coalesce(total_revenue, 0) AS total_revenue,
    CAST(coalesce(avg_review_score, 3) AS DECIMAL(18,4)) AS avg_review_score, coalesce(review_count, 0) AS review_count,
    trim(replace(product_category_name, '_', ' ') || ' ' || replace(product_category_name_english, '_', ' ') || ' peso ' || CAST(product_weight_g AS VARCHAR) || ' volume ' || CAST(product_volume_cm3 AS VARCHAR)) AS text_corpus
    FROM c_products p LEFT JOIN (SELECT product_id, count(DISTINCT order_id) AS order_count, {q.avg('price', 4)} AS avg_price, {q.avg('freight_value', 4)} AS avg_freight, CAST(sum(price) AS DECIMAL(18,2)) AS total_revenue FROM c_items GROUP BY 1) s ON p.product_id = s.product_id
    LEFT JOIN (SELECT product_id, {q.avg('review_score', 4)} AS avg_review_score, count(review_score) AS review_count FROM c_items i JOIN c_reviews r ON i.order_id = r.order_id GROUP BY 1) r ON p.product_id = r.product_id""",
)
lib.add("p_words", "SELECT product_id, regexp_extract_all(lower(text_corpus), '[\\p{L}\\p{N}_]{2,}') AS w FROM p_features")
lib.add(
    "p_terms",
    """SELECT product_id, term, count(*) AS tf FROM (SELECT product_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM p_words) GROUP BY 1, 2""",
)
lib.add("p_vocab", "SELECT term, count(*) AS df, sum(tf) AS cf FROM p_terms GROUP BY 1 HAVING count(*) >= 2 ORDER BY cf DESC, term LIMIT 500")
lib.add(
    "p_weights",
    """SELECT product_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY product_id)) AS weight
    FROM (SELECT product_id, t.term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM p_features))::DOUBLE / (1 + df)) + 1) AS raw FROM p_terms t JOIN p_vocab v ON t.term = v.term)""",
)
lib.add(
    "p_classes",
    """SELECT min(product_id) AS head, count(*) AS n FROM (SELECT product_id, string_agg(term || ':' || CAST(round(weight, 9) AS VARCHAR), '|' ORDER BY term) AS sig FROM p_weights GROUP BY 1) GROUP BY sig""",
)
lib.add(
    "p_recs",
    """SELECT product_id, partner_id, similarity_score, CAST(rn AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY similarity_score DESC, partner_id) AS rn
    FROM (SELECT a.product_id, b.product_id AS partner_id, round(sum(a.weight * b.weight), 6) AS similarity_score FROM p_weights a JOIN p_weights b ON a.term = b.term AND a.product_id <> b.product_id GROUP BY 1, 2)) WHERE rn <= 10""",
)


def trusted(m) -> C.Trusted:
    return C.build_trusted(LandingView(m))


def corpus(m):
    """(product_id, text_corpus); the text needs the product table only."""
    return trusted(m).products.select("product_id", L.corpus_text().alias("text_corpus"))


query("ml_product_features", "SELECT * FROM p_features")(lambda m: L.product_features(trusted(m)))
query("ml_tfidf", "SELECT product_id, term, round(weight, 6) AS weight FROM p_weights")(lambda m: V.product_weights(corpus(m)))
query(
    "ml_product_similarity",
    """SELECT a.head AS product_a, b.head AS product_b, any_value(a.n) AS members_a, any_value(b.n) AS members_b, round(sum(wa.weight * wb.weight), 6) AS similarity
    FROM p_classes a JOIN p_weights wa ON a.head = wa.product_id JOIN p_weights wb ON wa.term = wb.term JOIN p_classes b ON b.head = wb.product_id AND a.head < b.head GROUP BY 1, 2 HAVING round(sum(wa.weight * wb.weight), 6) >= 0.8""",
)(lambda m: V.similar_classes(V.VectorClasses(corpus(m), "similarity"), 0.8))
query("ml_recommend", "SELECT * FROM p_recs")(lambda m: V.recommend(V.VectorClasses(corpus(m), "recommend", TOP)))
query(
    "join_similarity",
    """SELECT w.product_id, c.product_category_name AS category, round(sum(w.weight * m.mean_weight), 6) AS similarity FROM p_weights w JOIN c_products c ON w.product_id = c.product_id
    JOIN (SELECT product_category_name AS category, term, sum(weight) / any_value(n) AS mean_weight FROM p_weights JOIN c_products USING (product_id) JOIN (SELECT product_category_name AS k, count(*) AS n FROM c_products GROUP BY 1) ON k = product_category_name GROUP BY 1, 2) m
    ON c.product_category_name = m.category AND w.term = m.term GROUP BY 1, 2""",
)(lambda m: V.category_fit(corpus(m), trusted(m).products.select("product_id", F.col("product_category_name").alias("category"))))


@query(
    "ml_copurchase_eval",
    """WITH pr AS (SELECT DISTINCT a.product_id, b.product_id AS partner_id FROM c_items a JOIN c_items b ON a.order_id = b.order_id AND a.product_id <> b.product_id), rel AS (SELECT product_id, count(*) AS n FROM pr GROUP BY 1),
    h AS (SELECT r.product_id, count(pr.partner_id) AS hits FROM p_recs r LEFT JOIN pr ON r.product_id = pr.product_id AND r.partner_id = pr.partner_id GROUP BY 1)
    SELECT count(*) AS n_products, round(avg(hits / 10.0::DOUBLE), 6) AS precision_at_k, round(avg(hits::DOUBLE / n), 6) AS recall_at_k FROM rel JOIN h ON rel.product_id = h.product_id""",
)
def _(m):
    recs = io.stage(V.recommend(V.VectorClasses(corpus(m), "copurchase", TOP)), "copurchase_recs")
    return L.copurchase_eval(trusted(m).order_items, recs, TOP)


_chosen = "SELECT product_id, CAST(row_number() OVER (ORDER BY order_count DESC, product_id) AS INTEGER) AS place FROM p_features QUALIFY place <= 6"
query(
    "ml_similarity_matrix",
    "SELECT a.product_id, a.place, "
    + ", ".join(f"coalesce(max(CASE WHEN b.place = {i} THEN s END), 0) AS p{i}" for i in range(1, 7))
    + f" FROM (SELECT x.product_id AS pa, y.product_id AS pb, round(sum(x.weight * y.weight), 6) AS s FROM p_weights x JOIN p_weights y ON x.term = y.term WHERE x.product_id IN (SELECT product_id FROM ({_chosen})) AND y.product_id IN (SELECT product_id FROM ({_chosen})) GROUP BY 1, 2) JOIN ({_chosen}) a ON pa = a.product_id JOIN ({_chosen}) b ON pb = b.product_id GROUP BY 1, 2",
)(lambda m: _matrix(m))


def _matrix(m):
    features = L.product_features(trusted(m)).select("product_id", "text_corpus", "order_count")
    best = features.orderBy(F.desc("order_count"), "product_id").limit(6).select("product_id", "order_count")  # the chosen few
    place = F.row_number().over(_by_count())
    return V.similarity_matrix(features.select("product_id", "text_corpus"), best.select("product_id", place.alias("place")), 6)


def _by_count():
    return W.orderBy(F.desc("order_count"), "product_id")


# --- delivery time ------------------------------------------------------------------
lib.add(
    "p_delivery",
    f"""WITH b AS (SELECT i.order_id, i.order_item_id, s.seller_state, c.customer_state, CAST(p.product_weight_g AS DOUBLE) AS w, CAST(p.product_volume_cm3 AS DOUBLE) AS v, i.freight_value, i.price, CAST(coalesce(s.seller_state = c.customer_state, FALSE) AS INTEGER) AS same_state,
      {q.elapsed('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS delivery_days
      FROM c_items i JOIN c_orders o ON i.order_id = o.order_id LEFT JOIN c_products p ON i.product_id = p.product_id LEFT JOIN c_sellers s ON i.seller_id = s.seller_id LEFT JOIN c_customers c ON o.customer_id = c.customer_id
      WHERE {q.elapsed('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} > 0 AND {q.elapsed('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} <= 120)
    SELECT order_id, order_item_id, seller_state, customer_state, se.code AS seller_state_enc, cu.code AS customer_state_enc, coalesce(w, (SELECT quantile_cont(w, 0.5) FROM b)) AS product_weight_g, coalesce(v, (SELECT quantile_cont(v, 0.5) FROM b)) AS product_volume_cm3,
      freight_value, price, same_state, delivery_days FROM b
    LEFT JOIN (SELECT s, CAST(row_number() OVER (ORDER BY s) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT coalesce(seller_state, 'SP') AS s FROM c_sellers)) se ON coalesce(seller_state, 'SP') = se.s
    LEFT JOIN (SELECT s, CAST(row_number() OVER (ORDER BY s) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT coalesce(customer_state, 'SP') AS s FROM b)) cu ON coalesce(customer_state, 'SP') = cu.s""",
)


def features(m):
    return L.delivery_features(trusted(m))


query("ml_delivery_features", "SELECT * FROM p_delivery")(features)
query(
    "ml_train_test_split",
    "SELECT order_id, order_item_id, delivery_days, CASE WHEN CAST('0x' || substr(md5(order_id || '-' || CAST(order_item_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS part FROM p_delivery",
)(lambda m: L.train_test_split(features(m)).select("order_id", "order_item_id", "delivery_days", "part"))


def version(m) -> tuple:
    """Newest file time per table the features are read from: a changed table gets its own split and forest."""
    newest = lambda name: m.table(name).agg(F.max("_metadata.file_modification_time")).first()[0]
    return tuple((name, newest(name)) for name in ("customer", "lineitem", "orders", "part", "supplier"))


@cache
def _split(spark, root: str, seen: tuple):
    from bazaarlens.sources.market import Market

    return io.stage(L.train_test_split(features(Market(spark, root))), "delivery_split", ["part"])


@cache
def _forest(spark, root: str, seen: tuple):
    return L.fit_forest(_split(spark, root, seen).where("part = 'train'"))


def split_table(m):
    """Split features, written once per state of the tables."""
    return _split(m.spark, m.root, version(m))


def forest(m):
    return _forest(m.spark, m.root, version(m))


def predictions(m):
    return L.predict(forest(m), split_table(m).where("part = 'test'"))


_test_rows = "FROM p_delivery WHERE CAST('0x' || substr(md5(order_id || '-' || CAST(order_item_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 80"


@query("ml_delivery_rf")
def _(m):
    """Prediction of every test row. SQL has no forest; a test recomputes the predictions from the exported trees."""
    return predictions(m).select("order_id", "order_item_id", "delivery_days", F.round("prediction", 4).alias("prediction"))


query(
    "ml_regression_metrics",
    """SELECT count(*) AS n, round(sqrt(avg((delivery_days - estimated_days) * (delivery_days - estimated_days))), 6) AS rmse, round(avg(abs(delivery_days - estimated_days)), 6) AS mae,
    round(1 - avg((delivery_days - estimated_days) * (delivery_days - estimated_days)) / var_pop(delivery_days), 6) AS r2 FROM s_fact_orders WHERE delivery_days IS NOT NULL AND estimated_days IS NOT NULL""",
)(lambda m: L.regression_metrics(notebook(m).fact_orders, "delivery_days", "estimated_days"))


@query("ml_cross_validate")
def _(m):
    return L.cross_validation_summary(L.cross_validate(split_table(m).where("part = 'train'")))


@query("ml_feature_importance")
def _(m):
    """Every feature with its importance, in falling order. A test recomputes them from the exported trees."""
    return L.feature_importance(m.spark, forest(m))


@query("ml_metrics_table")
def _(m):
    scored = L.regression_metrics(predictions(m), "delivery_days", "prediction").withColumn("model", F.lit("delivery_forest"))
    promised = L.regression_metrics(notebook(m).fact_orders, "delivery_days", "estimated_days").withColumn("model", F.lit("promised_date"))
    return scored.unionByName(promised).select("model", "n", "rmse", "mae", "r2")


@query("sink_model", f"SELECT count(*) AS n_rows, count(*) AS n_equal {_test_rows}")
def _(m):
    from pyspark.ml import PipelineModel

    path = io.fresh_path(m.spark, "delivery_model")
    io.save_model(forest(m), path)
    again = PipelineModel.load(path)
    both = predictions(m).select("order_id", "order_item_id", F.col("prediction").alias("before")).join(
        L.predict(again, split_table(m).where("part = 'test'")).select("order_id", "order_item_id", F.col("prediction").alias("after")), ["order_id", "order_item_id"]
    )
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("before") == F.col("after")).alias("n_equal"))


# --- embeddings ------------------------------------------------------------------------
_centres = "SELECT extracted_category AS category, list(m ORDER BY pos) AS centre FROM (SELECT extracted_category, pos, avg(embedding[pos]::DOUBLE) AS m FROM m_vectors, range(1, 65) r(pos) WHERE extracted_category IS NOT NULL GROUP BY 1, 2) GROUP BY 1"
_scores = f"SELECT product_id, extracted_category, category, round(list_cosine_similarity(embedding::DOUBLE[], centre), 6) AS similarity FROM m_vectors, ({_centres})"
query(
    "ml_embedding_topk",
    """SELECT product_id, partner_id, similarity, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY similarity DESC, partner_id) AS place
    FROM (SELECT a.product_id, b.product_id AS partner_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM m_vectors a JOIN m_vectors b ON a.product_id <> b.product_id)) WHERE place <= 10""",
)(lambda m: N.nearest_products(m.embeddings))
query(
    "ml_embedding_centre_topk",
    f"SELECT product_id, category, similarity, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY similarity DESC, product_id) AS place FROM ({_scores})) WHERE place <= 10",
)(lambda m: E.nearest_products(m.embeddings, "extracted_category", DIM, 10))
query(
    "ml_embedding_zero_shot",
    f"SELECT product_id, category AS assigned_category, similarity FROM ({_scores}) WHERE extracted_category IS NULL QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY similarity DESC, category) = 1",
)(lambda m: E.zero_shot(m.embeddings, "extracted_category", DIM))
