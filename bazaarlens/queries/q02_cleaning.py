"""Raw to trusted cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.functions import fixed
from bazaarlens.functions import scalars as S
from bazaarlens.operators import cleaning as C
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query

query("trusted_orders", "SELECT * FROM t_orders")(lambda m: C.trusted_orders(m.landing_orders))
query("trusted_order_items", "SELECT * FROM t_items")(lambda m: C.trusted_order_items(m.landing_order_items))
query("trusted_payments", "SELECT * FROM t_payments")(lambda m: C.trusted_payments(m.landing_order_payments))
query("trusted_reviews", "SELECT * FROM t_reviews")(lambda m: C.trusted_reviews(m.landing_order_reviews))
query("trusted_customers", "SELECT * FROM t_customers")(lambda m: C.trusted_customers(m.customers))
query("trusted_products", "SELECT * FROM t_products")(lambda m: C.trusted_products(m.landing_products, m.translation))
query("trusted_sellers", "SELECT * FROM t_sellers")(lambda m: C.trusted_sellers(m.sellers))
query("trusted_geolocation", "SELECT * FROM t_geo")(lambda m: C.trusted_geolocation(m.landing_geolocation))
query("clean_orders", "SELECT * FROM c_orders")(lambda m: C.clean_orders(m.landing_orders))
query("clean_order_items", "SELECT * FROM c_items")(lambda m: C.clean_order_items(m.order_items))
query("clean_order_payments", "SELECT * REPLACE (CAST(payment_sequential AS VARCHAR) AS payment_sequential) FROM c_payments")(
    lambda m: C.clean_order_payments(m.landing_order_payments)
)
query("clean_order_reviews", "SELECT * FROM c_reviews")(lambda m: C.clean_order_reviews(m.order_reviews))
query("clean_customers", "SELECT * FROM c_customers")(lambda m: C.clean_customers(m.customers))
query("clean_products", "SELECT * FROM c_products")(lambda m: C.clean_products(m.landing_products, m.translation))
query("clean_sellers", "SELECT * FROM c_sellers")(lambda m: C.clean_sellers(m.sellers))

_trusted = {"orders": "c_orders", "order_items": "c_items", "order_payments": "c_payments", "order_reviews": "c_reviews",
            "customers": "c_customers", "products": "c_products", "sellers": "c_sellers"}


@query("build_trusted", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}" for n, t in _trusted.items()))
def _(m):
    from functools import reduce

    from pyspark.sql import DataFrame

    from bazaarlens.queries.q01_sources import LandingView

    t = C.build_trusted(LandingView(m))
    return reduce(DataFrame.unionByName, [getattr(t, n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n in _trusted])


query("fix_column_typos", "SELECT * RENAME (product_name_lenght AS product_name_length, product_description_lenght AS product_description_length) FROM m_products")(
    lambda m: C.fix_column_typos(m.products)
)
query(
    "derive_is_delivered",
    f"SELECT *, order_delivered_customer_date IS NOT NULL AS is_delivered, {q.floor_days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS delivery_delay_days FROM m_orders",
)(lambda m: C.derive_is_delivered(m.orders))
query(
    "derive_processing_days",
    f"SELECT *, {q.days('order_approved_at', 'order_delivered_carrier_date')} AS processing_days FROM m_orders",
)(lambda m: C.derive_processing_days(m.orders))
query(
    "dedup_latest_review",
    "SELECT * FROM m_reviews QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC, review_id, review_score, review_comment_title, review_comment_message, review_creation_date) = 1",
)(lambda m: C.dedup_latest_review(m.order_reviews))
query(
    "normalize_city",
    "SELECT customer_id, regexp_replace(trim(lower(strip_accents(customer_city))), '\\s+', ' ', 'g') AS city FROM m_customers",
)(lambda m: m.customers.select("customer_id", S.normalize_city("customer_city").alias("city")))
query(
    "geo_centroid_max",
    "SELECT geolocation_zip_code_prefix, round(avg(geolocation_lat), 6) AS lat, round(avg(geolocation_lng), 6) AS lng, max(geolocation_city) AS city, max(geolocation_state) AS state FROM m_geo GROUP BY 1",
)(lambda m: C.geo_centroid_max(m.geolocation))

_cdm = " UNION ALL ".join(
    [
        "SELECT 'customer' AS entity, customer_unique_id AS natural_key, customer_zip_code_prefix AS location_zip_code, customer_state AS location_state FROM m_customers",
        "SELECT 'seller', seller_id, seller_zip_code_prefix, seller_state FROM m_sellers",
        "SELECT 'order', order_id, NULL, order_status FROM m_orders",
        "SELECT 'product', product_id, product_category_name, product_category_name_english FROM c_products",
    ]
)


@query("cdm_mapping", _cdm)
def _(m):
    key = {"customer": "customer_unique_id", "seller": "seller_id", "order": "order_id", "product": "product_id"}
    pick = {
        "customer": ("location_zip_code", "location_state"),
        "seller": ("location_zip_code", "location_state"),
        "order": (None, "status"),
        "product": ("category_name_pt", "category_name_en"),
    }
    source = {"customer": m.customers, "seller": m.sellers, "order": m.orders, "product": C.clean_products(m.landing_products, m.translation)}
    out = None
    for entity, df in source.items():
        a, b = pick[entity]
        mapped = C.cdm_mapping(df, entity).select(
            F.lit(entity).alias("entity"),
            F.col(key[entity]).alias("natural_key"),
            (F.col(a) if a else F.lit(None).cast("string")).alias("location_zip_code"),
            F.col(b).alias("location_state"),
        )
        out = mapped if out is None else out.unionByName(mapped)
    return out


_hist = "SELECT customer_id, customer_city, customer_state, TIMESTAMP '2018-01-01' AS f FROM c_customers WHERE CAST(customer_id AS BIGINT) % 5 <> 4"


@query(
    "scd2_merge",
    f"""WITH h AS ({_hist}), n AS (SELECT customer_id, CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN customer_city || ' nova' ELSE customer_city END AS customer_city, customer_state FROM c_customers)
    SELECT h.customer_id, h.customer_city, h.customer_state, h.f AS _dw_valid_from, CASE WHEN n.customer_city <> h.customer_city THEN TIMESTAMP '2018-06-01' END AS _dw_valid_to, n.customer_city = h.customer_city AS _dw_is_current
    FROM h JOIN n ON h.customer_id = n.customer_id
    UNION ALL SELECT n.customer_id, n.customer_city, n.customer_state, TIMESTAMP '2018-06-01', NULL, TRUE FROM n LEFT JOIN h ON h.customer_id = n.customer_id
    WHERE h.customer_id IS NULL OR n.customer_city <> h.customer_city""",
)
def _(m):
    base = C.clean_customers(m.customers).select("customer_id", "customer_city", "customer_state")
    k = F.col("customer_id").cast("bigint")
    history = base.where(k % 5 != 4).withColumns(
        {
            "_dw_valid_from": F.lit("2018-01-01").cast("timestamp_ntz"),
            "_dw_valid_to": F.lit(None).cast("timestamp_ntz"),
            "_dw_is_current": F.lit(True),
        }
    )
    moved = base.withColumn("customer_city", F.when(k % 3 == 0, F.concat("customer_city", F.lit(" nova"))).otherwise(F.col("customer_city")))
    return C.scd2_merge(history, moved, ["customer_id"], ["customer_city", "customer_state"], F.lit("2018-06-01").cast("timestamp_ntz"))


query(
    "audit_columns",
    "SELECT *, TIMESTAMP '2018-09-01' AS _dw_created_at, TIMESTAMP '2018-09-01' AS _dw_updated_at, 'sellers' AS _dw_source_table, 'b7' AS _dw_batch_id FROM m_sellers",
)(lambda m: C.audit_columns(m.sellers, "sellers", "b7", F.lit("2018-09-01").cast("timestamp_ntz")))
