"""Sources and sinks: round trips through files under the shared work folder."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.operators import cleaning as C
from bazaarlens.operators import star
from bazaarlens.sources import contracts, io

BASE_TABLES = ["orders", "order_items", "order_payments", "order_reviews", "customers", "products", "sellers", "geolocation", "translation"]
ORACLE_TABLES = ["m_orders", "m_items", "m_payments", "m_reviews", "m_customers", "m_products", "m_sellers", "m_geo", "m_translation"]
N_COLUMNS = [8, 7, 5, 7, 5, 9, 4, 5, 2]


@query("src_csv_typed", "SELECT * FROM m_orders")
def _(m):
    path = io.fresh_path(m.spark, "csv_orders")
    io.write_csv_report(m.as_text(m.orders), path)
    return io.read_csv_typed(m.spark, path, m.orders.schema, C.ORDER_TIMES)


@query(
    "src_csv_missing_tolerant",
    "SELECT 'sellers' AS \"table\", 'loaded' AS status, CAST(4 AS INTEGER) AS n_columns, count(*) AS n_rows FROM m_sellers "
    "UNION ALL SELECT 'returns', 'missing', NULL, NULL",
)
def _(m):
    path = io.fresh_path(m.spark, "csv_sellers")
    io.write_csv_report(m.sellers, path)
    return io.read_available(m.spark, {"sellers": path, "returns": path + "_none"}, "csv")[1]


@query("src_raw_landing", "SELECT *, 'b1' AS batch FROM (SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM l_orders)")
def _(m):
    path = io.fresh_path(m.spark, "csv_landing")
    columns = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]
    text = m.landing_orders.select(columns)
    text.write.mode("overwrite").options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    landed = io.read_landing(m.spark, path, columns, "b1")
    return landed.where("_source_file is not null and _ingested_at is not null").select(*columns, F.col("_batch_id").alias("batch"))


@query("src_json_array", "SELECT product_id, title, description FROM m_texts")
def _(m):
    path = io.fresh_path(m.spark, "json_products")
    df = m.product_texts.select("product_id", "title", "description")
    # one array per file; the number of files follows the table, so an array stays at some 5,000 products
    group = F.pmod(F.xxhash64("product_id"), F.lit(1 + df.count() // 5000))
    arrays = df.groupBy(group.alias("g")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.select("value", "g").write.mode("overwrite").partitionBy("g").text(path)
    return io.read_json_array(m.spark, path, df.schema).select(*df.columns)


@query("src_inline_rows", "SELECT product_id, title, kind FROM (SELECT m_texts.*, kind FROM m_texts JOIN (VALUES ('old', 'used'), ('small', 'compact')) v(word, kind) ON split_part(title, ' ', 1) = word)")
def _(m):
    kinds = io.inline_rows(m.spark, [("old", "used"), ("small", "compact")], "word string, kind string")
    return m.product_texts.join(kinds, F.split("title", " ")[0] == F.col("word")).select("product_id", "title", "kind")


@query("src_date_spine", "SELECT full_date FROM spine")
def _(m):
    return star.date_spine(star.date_bounds(m.orders, "order_purchase_timestamp"))


_verify = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, CAST({k} AS INTEGER) AS n_columns FROM {t}" for n, t, k in zip(BASE_TABLES, ORACLE_TABLES, N_COLUMNS)
)


@query("src_load_verify", f"SELECT *, CAST(sum(n_rows) OVER () AS BIGINT) AS total_rows, sum(n_rows) OVER () >= 100000 AS meets_minimum FROM ({_verify})")
def _(m):
    return io.load_verify({n: getattr(m, n) for n in BASE_TABLES})


@query("src_table_inventory", f"SELECT table_name, upper(table_name) AS label, n_rows, n_columns, CASE WHEN n_rows > 0 THEN 'ok' ELSE 'empty' END AS status FROM ({_verify})")
def _(m):
    return io.table_inventory({n: (getattr(m, n), n.upper()) for n in BASE_TABLES})


@query("sink_parquet_star", "SELECT coalesce(strftime(order_purchase_timestamp, '%Y-%m'), 'none') AS year_month, count(*) AS n_rows, CAST(sum(price) AS DECIMAL(18,2)) AS revenue FROM s_fact_orders GROUP BY 1")
def _(m):
    root = io.fresh_path(m.spark, "star")
    paths = io.write_star(star.build_refined(C.build_trusted(LandingView(m)), io.stage), root)  # facts are read for both fact tables
    fact = m.spark.read.option("basePath", paths["fact_orders"]).parquet(paths["fact_orders"])
    return fact.groupBy(F.coalesce(F.col("year_month").cast("string"), F.lit("none")).alias("year_month")).agg(
        F.count("*").alias("n_rows"), F.sum("price").cast("decimal(18,2)").alias("revenue")
    )


class LandingView:
    """The raw bundle the cleaners read in these checks: text orders, payments and products."""

    def __init__(self, m):
        self.orders, self.order_items, self.order_payments = m.landing_orders, m.order_items, m.landing_order_payments
        self.order_reviews, self.customers, self.sellers = m.order_reviews, m.customers, m.sellers
        self.products, self.translation = m.landing_products, m.translation


@query("sink_csv_report", "SELECT order_status, count(*) AS n_orders FROM m_orders GROUP BY 1")
def _(m):
    path = io.fresh_path(m.spark, "report_csv")
    io.write_csv_report(m.orders.groupBy("order_status").agg(F.count("*").alias("n_orders")), path)
    return m.spark.read.schema("order_status string, n_orders bigint").option("header", True).csv(path)


@query("sink_json_report", "SELECT customer_state, count(*) AS n, count(DISTINCT customer_city) AS cities FROM c_customers GROUP BY 1")
def _(m):
    path = io.fresh_path(m.spark, "report_json")
    counts = C.clean_customers(m.customers).groupBy("customer_state").agg(F.count("*").alias("n"), F.count_distinct("customer_city").alias("cities"))
    io.write_json_report(counts.select("customer_state", F.struct("n", "cities").alias("metrics")), path)
    return m.spark.read.schema("customer_state string, metrics struct<n: bigint, cities: bigint>").json(path).select("customer_state", "metrics.n", "metrics.cities")


@query("sink_ctas_overwrite", "SELECT * FROM t_sellers")
def _(m):
    return io.replace_table(C.trusted_sellers(m.as_text(m.sellers)), f"trusted_sellers_{zlib.crc32(m.root.encode())}")


@query("sink_view", "SELECT seller_state, count(*) AS n FROM t_sellers GROUP BY 1")
def _(m):
    io.replace_view(C.trusted_sellers(m.as_text(m.sellers)), "vw_sellers")
    return m.spark.sql("select seller_state, count(*) as n from vw_sellers group by seller_state")


@query("sink_insert_rows", "SELECT geography_key, zip_code, city, state FROM d_geography UNION ALL SELECT -1, '00000', 'UNKNOWN', 'XX'")
def _(m):
    dim = star.dim_geography(C.trusted_geolocation(m.landing_geolocation))
    path = io.fresh_path(m.spark, "dim_geography")
    member = m.spark.range(1).select(*[F.lit(v).alias(c) for c, v in star.UNKNOWN_MEMBERS["dim_geography"].items()])
    dim.write.parquet(path)
    io.insert_rows(dim, member.withColumn("geography_key", F.col("geography_key").cast("bigint")), path)
    return m.spark.read.parquet(path).select("geography_key", "zip_code", "city", "state")


@query("sink_quarantine", "SELECT coalesce(CAST(geolocation_lat BETWEEN -33.75 AND 5.27 AND geolocation_lng BETWEEN -73.99 AND -28.85 AS BOOLEAN), FALSE) AS valid, * FROM m_geo")
def _(m):
    from bazaarlens.functions.fixed import DQ_BOX

    good, bad = C.split_quarantine(m.geolocation, C.inside_box("geolocation_lat", "geolocation_lng", DQ_BOX))
    return good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))


@query(
    "ddl_table_contracts",
    "SELECT count(*) AS n_rows, CAST(count(*) - count(DISTINCT seller_id) AS BIGINT) AS key_repeats, count(*) FILTER (WHERE seller_state IS NULL OR seller_city IS NULL) AS null_faults FROM t_sellers",
)
def _(m):
    contract = contracts.contracts()["stg_sellers"]
    table = contracts.apply_contract(C.trusted_sellers(m.as_text(m.sellers)), contract)
    required = [f.name for f in contract.schema.fields if not f.nullable]
    fault = F.greatest(*[F.col(c).isNull() for c in required])
    return table.agg(
        F.count("*").alias("n_rows"),
        (F.count("*") - F.count_distinct(*contract.primary_key)).alias("key_repeats"),
        F.count_if(fault).alias("null_faults"),
    )
