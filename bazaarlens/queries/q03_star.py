"""Dimensions, facts and views."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators import cleaning as C
from bazaarlens.operators import clustering
from bazaarlens.operators import ranges as R
from bazaarlens.operators import star
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle import tables as T
from bazaarlens.oracle.registry import query
from bazaarlens.queries.q01_sources import LandingView
from bazaarlens.sources import io


class Warehouse:
    """The warehouse-rule star over the landing tables; every table is made when it is first asked for."""

    def __init__(self, m):
        self.m = m

    # the dates the calendar must hold: of purchases, review requests and answers
    all_days = cached_property(
        lambda s: s.m.orders.select(F.col("order_purchase_timestamp").alias("day")).unionAll(
            s.m.order_reviews.select(F.explode(F.array("review_creation_date", "review_answer_timestamp")))
        )
    )
    orders = cached_property(lambda s: C.trusted_orders(s.m.landing_orders))
    items = cached_property(lambda s: C.trusted_order_items(s.m.landing_order_items))
    payments = cached_property(lambda s: C.trusted_payments(s.m.landing_order_payments))
    reviews = cached_property(lambda s: C.trusted_reviews(s.m.landing_order_reviews))
    customers = cached_property(lambda s: C.trusted_customers(s.m.customers))
    products = cached_property(lambda s: C.trusted_products(s.m.landing_products, s.m.translation))
    sellers = cached_property(lambda s: C.trusted_sellers(s.m.sellers))
    geo = cached_property(lambda s: io.stage(C.trusted_geolocation(s.m.landing_geolocation), "geolocation"))
    bounds = cached_property(lambda s: star.date_bounds(s.all_days, "day"))
    dates_all = cached_property(lambda s: star.dim_date_sql(star.date_spine(s.bounds)))
    dates = cached_property(lambda s: s.dates_all)  # every date a fact refers to lies in the calendar
    # written once: a key is numbered in several passes, and facts and views read the same dimensions
    dim_customer = cached_property(lambda s: io.stage(star.dim_customer(s.customers, s.geo), "dim_customer"))
    dim_product = cached_property(lambda s: io.stage(star.dim_product(s.products), "dim_product"))
    dim_seller = cached_property(lambda s: io.stage(star.dim_seller(s.sellers, s.geo), "dim_seller"))
    dim_geography = cached_property(lambda s: io.stage(star.dim_geography(s.geo), "dim_geography"))
    # read once: only the columns asked for are made; `fact_orders` is written for those who read it several times
    fact_lines = cached_property(lambda s: star.fact_orders_sql(s.orders, s.items, s.payments, s.dim_customer, s.dim_product, s.dim_seller))
    fact_orders = cached_property(lambda s: io.stage(s.fact_lines, "fact_orders"))
    unpaid_lines = cached_property(lambda s: star.fact_orders_sql(s.orders, s.items, None, s.dim_customer, s.dim_product, s.dim_seller))
    fact_reviews = cached_property(lambda s: star.fact_reviews_sql(s.reviews, s.orders, s.items, s.dim_customer, s.dim_product))


for _name in ["orders", "items", "payments", "reviews", "customers", "products", "sellers", "geo", "bounds", "all_days", "dates_all", "dates",
              "dim_customer", "dim_product", "dim_seller", "dim_geography", "fact_lines", "fact_orders", "unpaid_lines", "fact_reviews"]:
    getattr(Warehouse, _name).__set_name__(Warehouse, _name)

query("dim_date_sql", "SELECT * FROM d_date_all")(lambda m: Warehouse(m).dates_all)
query(
    "dim_date_observed",
    f"""SELECT {q.date_key("full_date")} AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
    strftime(full_date, '%B') AS month_name_en, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week,
    strftime(full_date, '%A') AS day_name_en, isodow(full_date) >= 6 AS is_weekend FROM (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS full_date FROM m_orders)""",
)(lambda m: star.dim_date_observed(m.orders))


T.lib.add(
    "d_date_ddl",
    f"""SELECT {q.date_key("full_date")} AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
    month_name, week_of_year AS week, CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) AS INTEGER) AS day_of_week, day_of_week_name, isodow(full_date) >= 6 AS is_weekend,
    h IS NOT NULL AS is_holiday FROM d_date_all LEFT JOIN (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS h FROM m_orders WHERE strftime(order_purchase_timestamp, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '12-25')) ON full_date = h""",
)


@query("dim_date_ddl", "SELECT * FROM d_date_ddl")
def _(m):
    days = m.orders.select(F.to_date("order_purchase_timestamp").alias("holiday_date"))
    holidays = days.where(F.date_format("holiday_date", "MM-dd").isin("01-01", "04-21", "05-01", "09-07", "12-25"))
    return star.dim_date_ddl(star.date_spine(Warehouse(m).bounds), holidays)


query("dim_customer", "SELECT * FROM d_customer")(lambda m: Warehouse(m).dim_customer)
query("dim_product", "SELECT * FROM d_product")(lambda m: Warehouse(m).dim_product)
query("dim_seller", "SELECT * FROM d_seller")(lambda m: Warehouse(m).dim_seller)
query("dim_geography", "SELECT * FROM d_geography")(lambda m: Warehouse(m).dim_geography)
query("fact_orders_sql", "SELECT * FROM f_orders")(lambda m: Warehouse(m).fact_lines)


@query(
    "sink_clustered_facts",
    """SELECT 'dates' AS asked, order_item_key, purchase_date_key, customer_key, price FROM f_orders WHERE purchase_date_key BETWEEN 20170101 AND 20170630
    UNION ALL SELECT 'customers', order_item_key, purchase_date_key, customer_key, price FROM f_orders WHERE customer_key BETWEEN 100 AND 140""",
)
def _(m):
    """Facts clustered by day and customer; both ranges are read back from the files that can hold them."""
    fact = Warehouse(m).fact_orders
    path = io.fresh_path(m.spark, "clustered_facts")
    clustering.write_clustered(fact, path, ["purchase_date_key", "customer_key"], "order_item_key")
    read = lambda asked, wanted: clustering.read_clustered(m.spark, path, fact.schema, wanted).select(F.lit(asked).alias("asked"), "order_item_key", "purchase_date_key", "customer_key", "price")
    return read("dates", {"purchase_date_key": (20170101, 20170630)}).unionByName(read("customers", {"customer_key": (100, 140)}))


def notebook(m):
    return star.build_refined(C.build_trusted(LandingView(m)))


query("fact_orders_agg", "SELECT * FROM s_fact_orders")(lambda m: notebook(m).fact_orders)


@query(
    "fact_orders_bridge",
    """SELECT oi.order_id, oi.order_item_id, oi.product_id, dc.customer_key, oi.price FROM t_items oi JOIN t_orders o ON oi.order_id = o.order_id
    JOIN m_customers c ON o.customer_id = c.customer_id JOIN d_customer dc ON c.customer_unique_id = dc.customer_unique_id""",
)
def _(m):
    w = Warehouse(m)
    bridge = star.customer_bridge(m.customers, w.dim_customer)
    per_order = w.orders.select("order_id", "customer_id").join(bridge, "customer_id")
    return w.items.join(per_order, "order_id").select("order_id", "order_item_id", "product_id", "customer_key", "price")


query(
    "fact_payment_split",
    f"""SELECT i.order_id, i.order_item_id, i.product_id, i.price, {q.rdiv("CAST(pay AS DECIMAL(14,2)) * price", "total")} AS payment_value FROM t_items i
    JOIN (SELECT order_id, sum(payment_value) AS pay FROM t_payments GROUP BY 1) p ON i.order_id = p.order_id
    JOIN (SELECT order_id, sum(price) AS total FROM t_items GROUP BY 1) s ON i.order_id = s.order_id""",
)(lambda m: star.fact_payment_split(Warehouse(m).items, Warehouse(m).payments))
query(
    "fact_payment_first",
    """SELECT i.order_id, i.order_item_id, i.product_id, i.price, p.payment_type, p.payment_installments, p.payment_value FROM t_items i
    LEFT JOIN (SELECT * FROM t_payments WHERE payment_sequential = 1) p ON i.order_id = p.order_id""",
)(lambda m: star.fact_payment_first(Warehouse(m).items, Warehouse(m).payments))
query("fact_reviews_sql", "SELECT * FROM f_reviews")(lambda m: Warehouse(m).fact_reviews)
query(
    "fact_reviews_by_answer_date", T.reviews_fact("r.review_answer_timestamp")
)(lambda m: (lambda w: star.fact_reviews_sql(w.reviews, w.orders, w.items, w.dim_customer, w.dim_product, "answer"))(Warehouse(m)))
query(
    "fact_reviews_by_purchase_date", T.reviews_fact("o.order_purchase_timestamp")
)(lambda m: (lambda w: star.fact_reviews_sql(w.reviews, w.orders, w.items, w.dim_customer, w.dim_product, "purchase"))(Warehouse(m)))
query(
    "fact_reviews_meta",
    """SELECT r.*, mt.customer_sk, mt.date_key, CAST(length(review_comment_message) > 0 AS INTEGER) AS has_comment
    FROM c_reviews r LEFT JOIN (SELECT order_id, min(customer_sk) AS customer_sk, min(date_key) AS date_key FROM s_fact_orders GROUP BY 1) mt ON r.order_id = mt.order_id""",
)(lambda m: notebook(m).fact_reviews)
query(
    "fact_key_lookup",
    """SELECT i.order_id, i.order_item_id, i.product_id, i.price, coalesce(p.product_key, -1) AS product_key FROM t_items i
    LEFT JOIN (SELECT * FROM d_product WHERE product_category_english <> 'uncategorized') p ON i.product_id = p.product_id""",
)(
    lambda m: (
        lambda w: star.fact_key_lookup(
            w.items.select("order_id", "order_item_id", "product_id", "price"),
            w.dim_product.where("product_category_english <> 'uncategorized'"), "product_id", "product_key",
        )
    )(Warehouse(m))
)


@query(
    "fact_geography_lookup",
    """SELECT o.order_id, coalesce(g.geography_key, -1) AS geography_key FROM t_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id
    LEFT JOIN d_geography g ON lpad(c.customer_zip_code_prefix, 5, '0') = g.zip_code""",
)
def _(m):
    w = Warehouse(m)
    zips = m.customers.select("customer_id", F.lpad("customer_zip_code_prefix", 5, "0").alias("zip_code"))
    placed = w.orders.select("order_id", "customer_id").join(zips, "customer_id", "left")
    return star.fact_key_lookup(placed, w.dim_geography, "zip_code", "geography_key").select("order_id", "geography_key")


_members = {
    "dim_customer": ("d_customer", "customer_key", "customer_unique_id", "UNKNOWN"),
    "dim_product": ("d_product", "product_key", "product_id", "UNKNOWN"),
    "dim_seller": ("d_seller", "seller_key", "seller_id", "UNKNOWN"),
    "dim_geography": ("d_geography", "geography_key", "zip_code", "00000"),
    "dim_date": ("d_date_all", "date_key", "full_date", "1900-01-01"),
}


@query(
    "dim_sentinel",
    " UNION ALL ".join(
        f"SELECT '{n}' AS dimension, CAST({k} AS BIGINT) AS key, CAST({i} AS VARCHAR) AS member FROM {t} UNION ALL SELECT '{n}', -1, '{u}'" for n, (t, k, i, u) in _members.items()
    ),
)
def _(m):
    """Every dimension with its unknown member."""
    w = Warehouse(m)
    dims = {"dim_customer": w.dim_customer, "dim_product": w.dim_product, "dim_seller": w.dim_seller, "dim_geography": w.dim_geography, "dim_date": w.dates_all}
    parts = [
        star.with_sentinel(df, star.UNKNOWN_MEMBERS[n]).select(F.lit(n).alias("dimension"), F.col(_members[n][1]).cast("bigint").alias("key"), F.col(_members[n][2]).cast("string").alias("member"))
        for n, df in dims.items()
    ]
    return reduce(DataFrame.unionAll, parts)

query("surrogate_key", "SELECT row_number() OVER (ORDER BY order_id) AS order_key, order_id FROM m_orders")(
    lambda m: R.surrogate_key(m.orders.select("order_id"), "order_key", ["order_id"])
)
query("vw_sales_analysis", "SELECT * FROM vw_sales")(
    lambda m: (lambda w: star.vw_sales_analysis(w.fact_lines, w.dates, w.dim_customer, w.dim_product, w.dim_seller))(Warehouse(m))
)
query("vw_satisfaction_analysis", "SELECT * FROM vw_satisfaction")(
    lambda m: (lambda w: star.vw_satisfaction_analysis(w.fact_reviews, w.dates, w.dim_customer, w.dim_product))(Warehouse(m))
)
query(
    "enriched_orders",
    f"""SELECT o.*, p.total_payment, p.payment_type, r.avg_review_score, c.customer_state, c.customer_city,
    {q.elapsed("order_purchase_timestamp", "order_delivered_customer_date")} AS delivery_days, CAST(order_purchase_timestamp AS DATE) AS purchase_date
    FROM m_orders o LEFT JOIN (SELECT order_id, CAST(sum(payment_value) AS DECIMAL(18,2)) AS total_payment, arg_min(payment_type, payment_sequential) AS payment_type FROM m_payments GROUP BY 1) p ON o.order_id = p.order_id
    LEFT JOIN (SELECT order_id, avg(review_score) AS avg_review_score FROM m_reviews GROUP BY 1) r ON o.order_id = r.order_id
    LEFT JOIN m_customers c ON o.customer_id = c.customer_id""",
)(lambda m: star.enriched_orders(m.orders, m.order_payments, m.customers, m.order_reviews))


@query(
    "build_refined",
    """SELECT 'fact_orders' AS table_name, count(*) AS n_rows FROM s_fact_orders UNION ALL SELECT 'fact_reviews', count(*) FROM c_reviews
    UNION ALL SELECT 'dim_customer', count(*) FROM c_customers UNION ALL SELECT 'dim_product', count(*) FROM c_products
    UNION ALL SELECT 'dim_seller', count(*) FROM c_sellers UNION ALL SELECT 'dim_date', count(DISTINCT CAST(order_purchase_timestamp AS DATE)) FROM c_orders""",
)
def _(m):
    r = notebook(m)
    names = ["fact_orders", "fact_reviews", "dim_customer", "dim_product", "dim_seller", "dim_date"]
    return reduce(DataFrame.unionByName, [getattr(r, n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n in names])
