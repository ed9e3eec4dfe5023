"""Trusted to refined: dimensions, facts, views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.operators import joins as J
from bazaarlens.operators.cleaning import Trusted, first_per_key, total_order
from bazaarlens.operators.ranges import surrogate_key

UNKNOWN_KEY = -1


# --- date dimension ----------------------------------------------------------
def date_bounds(df: DataFrame, column: str) -> DataFrame:
    """First day of the first year and last day of the last year of a date column (one row)."""
    return df.agg(
        F.to_date(F.trunc(F.min(column), "year")).alias("first_day"),
        F.date_sub(F.add_months(F.to_date(F.trunc(F.max(column), "year")), 12), 1).alias("last_day"),
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day between `first_day` and `last_day` of a one-row table."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date"))


def dim_date_sql(spine: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return spine.select(
        S.date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        S.month_name_pt(d).alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        S.day_name_pt(d).alias("day_of_week_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
    )


def dim_date_observed(orders: DataFrame) -> DataFrame:
    d = F.col("full_date")
    days = orders.where("order_purchase_timestamp is not null").select(F.to_date("order_purchase_timestamp").alias("full_date")).distinct()
    return days.select(
        S.date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name_en"),
        F.weekofyear(d).alias("week_of_year"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name_en"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def dim_date_ddl(spine: DataFrame, holidays: DataFrame) -> DataFrame:
    """`holidays` has one column, `holiday_date`; it is joined on the day."""
    d = F.col("full_date")
    marked = spine.join(holidays.select("holiday_date").distinct(), d == F.col("holiday_date"), "left")
    return marked.select(
        S.date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        S.month_name_pt(d).alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        S.day_name_pt(d).alias("day_of_week_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.col("holiday_date").isNotNull().alias("is_holiday"),
    )


# --- other dimensions --------------------------------------------------------
def _with_place(df: DataFrame, geo: DataFrame, zip_column: str, prefix: str) -> DataFrame:
    place = geo.select(
        F.col("geolocation_zip_code_prefix").alias("_zip"),
        F.col("geolocation_lat").alias(f"{prefix}_lat"),
        F.col("geolocation_lng").alias(f"{prefix}_lng"),
    )
    return df.join(place, F.col(zip_column) == F.col("_zip"), "left").drop("_zip")


def dim_customer(customers: DataFrame, geo: DataFrame) -> DataFrame:
    placed = _with_place(customers, geo, "customer_zip_code_prefix", "customer")
    return surrogate_key(placed, "customer_key", ["customer_unique_id"])


def dim_product(products: DataFrame) -> DataFrame:
    banded = products.withColumn("weight_category", S.weight_band("product_weight_g"))
    return surrogate_key(banded, "product_key", ["product_id"])


def dim_seller(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    placed = _with_place(sellers, geo, "seller_zip_code_prefix", "seller")
    return surrogate_key(placed, "seller_key", ["seller_id"])


def dim_geography(geo: DataFrame) -> DataFrame:
    named = geo.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
        S.state_to_region("geolocation_state", "Norte").alias("region"),
    )
    return surrogate_key(named, "geography_key", ["zip_code"])


# unknown members by dimension; fixed values
UNKNOWN_MEMBERS = {
    "dim_customer": {"customer_key": -1, "customer_unique_id": "UNKNOWN", "customer_city": "UNKNOWN",
                     "customer_state": "XX", "customer_zip_code_prefix": "00000", "customer_region": "UNKNOWN"},
    "dim_product": {"product_key": -1, "product_id": "UNKNOWN", "product_category_name": "UNKNOWN",
                    "product_category_english": "UNKNOWN"},
    "dim_seller": {"seller_key": -1, "seller_id": "UNKNOWN", "seller_city": "UNKNOWN", "seller_state": "XX",
                   "seller_zip_code_prefix": "00000"},
    "dim_geography": {"geography_key": -1, "zip_code": "00000", "city": "UNKNOWN", "state": "XX"},
    "dim_date": {"date_key": -1, "full_date": "1900-01-01", "year": 1900, "quarter": 1, "month": 1,
                 "month_name": "Desconhecido", "week": 0, "day_of_month": 0, "day_of_week": 0,
                 "day_of_week_name": "Desconhecido", "is_weekend": False, "is_holiday": False},
}


def with_sentinel(dim: DataFrame, member: dict) -> DataFrame:
    """Append the unknown member; columns it does not name are NULL."""
    row = dim.sparkSession.range(1).select(
        [F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(row)


# --- facts -------------------------------------------------------------------
def top_payment(payments: DataFrame) -> DataFrame:
    order = total_order(payments, F.col("payment_value").desc_nulls_first(), F.col("payment_sequential").asc_nulls_last())
    return first_per_key(payments, ["order_id"], order).select("order_id", "payment_type", "payment_installments", "payment_value")


def first_item(items: DataFrame) -> DataFrame:
    """Of lines with one number the smallest product counts, so no other column takes part."""
    items = items.select("order_id", "order_item_id", "product_id")
    order = total_order(items, F.col("order_item_id").asc_nulls_last())
    return first_per_key(items, ["order_id"], order).select("order_id", "product_id")


def fact_orders_sql(
    orders: DataFrame, items: DataFrame, payments: DataFrame | None,
    dim_customer: DataFrame, dim_product: DataFrame, dim_seller: DataFrame,
) -> DataFrame:
    """Item grain. Inner joins to the dimensions; the largest payment of the order on every item.

    Order-level work (customer, payment, date keys) is joined to orders first, so the wide item table meets
    `order_id` once. Without `payments` the same rows come without the payment columns, for those who read none of them.
    """
    per_order = orders.join(dim_customer.select("customer_id", "customer_key"), "customer_id")
    if payments is not None:
        per_order = per_order.join(top_payment(payments), "order_id", "left")
    per_order = per_order.withColumns(
        {
            "purchase_date_key": S.date_key("order_purchase_timestamp"),
            "approved_date_key": S.date_key("order_approved_at"),
            "delivery_date_key": S.date_key("order_delivered_customer_date"),
        }
    )
    fact = (
        J.attach(items, dim_product.select("product_id", "product_key"), "product_id", "inner")
    )
    fact = J.attach(fact, dim_seller.select("seller_id", "seller_key"), "seller_id", "inner").join(per_order, "order_id")
    columns = [
        F.concat("order_id", F.lit("-"), F.col("order_item_id").cast("string")).alias("order_item_key"),
        "order_id",
        "order_item_id",
        "customer_key",
        "product_key",
        "seller_key",
        "purchase_date_key",
        "approved_date_key",
        "delivery_date_key",
        "order_status",
        "delivery_status",
        "payment_type",
        "payment_installments",
        "price",
        "freight_value",
        "total_item_value",
        "payment_value",
        "delivery_days",
        "delivery_delay_days",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    paid = {"payment_type", "payment_installments", "payment_value"}
    return fact.select(*(c for c in columns if payments is not None or not isinstance(c, str) or c not in paid))


def payment_summary(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        S.money(F.sum("payment_value")).alias("total_payment"),
        F.max("payment_installments").alias("installments_max"),
        F.array_join(F.array_sort(F.collect_set("payment_type")), "|").alias("payment_types"),
    )


def fact_orders_agg(t: Trusted, dim_customer: DataFrame, dim_product: DataFrame, dim_seller: DataFrame) -> DataFrame:
    per_order = (
        t.orders.join(payment_summary(t.order_payments), "order_id", "full")
        .join(dim_customer.select("customer_id", "customer_sk"), "customer_id", "left")
    )
    fact = J.attach(t.order_items, dim_product.select("product_id", "product_sk"), "product_id", "left")
    fact = J.attach(fact, dim_seller.select("seller_id", "seller_sk"), "seller_id", "left").join(per_order, "order_id", "left")
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return fact.select(
        "order_id",
        "order_item_id",
        "order_status",
        "customer_sk",
        "product_sk",
        "seller_sk",
        S.date_key("order_purchase_timestamp").alias("date_key"),
        "price",
        "freight_value",
        "total_payment",
        "installments_max",
        "payment_types",
        S.elapsed_days("order_purchase_timestamp", "order_delivered_customer_date").alias("delivery_days"),
        S.elapsed_days("order_purchase_timestamp", "order_estimated_delivery_date").alias("estimated_days"),
        F.coalesce(late, F.lit(False)).alias("is_late"),
        "order_purchase_timestamp",
    )


def customer_bridge(raw_customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """customer_id of every order -> key of the person it belongs to."""
    return raw_customers.select("customer_id", "customer_unique_id").join(
        dim_customer.select("customer_unique_id", "customer_key"), "customer_unique_id"
    ).select("customer_id", "customer_key")


def fact_payment_split(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Order payment shared out by price. Totals per order are aggregated, then joined, so a hot
    order never has to fit one window partition."""
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("order_payment"))
    priced = items.groupBy("order_id").agg(F.sum("price").alias("order_price"))
    per_order = paid.join(priced, "order_id")
    return items.join(per_order, "order_id").select(
        "order_id",
        "order_item_id",
        "product_id",
        "price",
        S.ratio(F.col("order_payment") * F.col("price"), "order_price").alias("payment_value"),
    )


def fact_payment_first(items: DataFrame, payments: DataFrame) -> DataFrame:
    first = payments.where("payment_sequential = 1").select("order_id", "payment_type", "payment_installments", "payment_value")
    return items.join(first, "order_id", "left").select(
        "order_id", "order_item_id", "product_id", "price", "payment_type", "payment_installments", "payment_value"
    )


REVIEW_DATE = {
    "creation": "review_creation_date",
    "answer": "review_answer_timestamp",
    "purchase": "order_purchase_timestamp",
}


def fact_reviews_sql(
    reviews: DataFrame, orders: DataFrame, items: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
    date_role: str = "creation",
) -> DataFrame:
    lead_product = first_item(items).join(dim_product.select("product_id", "product_key"), "product_id", "left")
    per_order = (
        orders.select("order_id", "customer_id", "order_purchase_timestamp")
        .join(dim_customer.select("customer_id", "customer_key"), "customer_id")
        .join(lead_product.select("order_id", "product_key"), "order_id", "left")
    )
    return reviews.join(per_order, "order_id").select(
        "review_id",
        "customer_key",
        "product_key",
        S.date_key(REVIEW_DATE[date_role]).alias("review_date_key"),
        "order_id",
        "review_score",
        "sentiment_category",
        "response_time_hours",
        (F.length("review_comment_message") > 0).alias("has_comment"),
        F.length("review_comment_message").alias("comment_length"),
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )


def fact_reviews_meta(reviews: DataFrame, fact_orders: DataFrame) -> DataFrame:
    per_order = fact_orders.select("order_id", "customer_sk", "date_key").groupBy("order_id").agg(
        F.min(F.struct("customer_sk", "date_key")).alias("m")
    )
    meta = per_order.select("order_id", "m.customer_sk", "m.date_key")
    return reviews.join(meta, "order_id", "left").withColumn(
        "has_comment", (F.length("review_comment_message") > 0).cast("int")
    )


def fact_key_lookup(fact: DataFrame, dim: DataFrame, natural: str, key: str) -> DataFrame:
    """Add the surrogate key, or -1 where the dimension has no such member."""
    found = J.attach(fact, dim.select(natural, key), natural, "left")
    return found.withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN_KEY).cast("bigint")))


def simple_dim(df: DataFrame, natural: str, key: str, columns: list[str]) -> DataFrame:
    kept = df.select([c for c in columns if c in df.columns])
    return surrogate_key(kept, key, [natural])


# --- views -------------------------------------------------------------------
def vw_sales_analysis(fact: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    joined = J.star_join(
        fact,
        [
            (dates, F.col("purchase_date_key") == F.col("date_key"), "inner"),
            (customers.drop("customer_id"), "customer_key", "inner"),
            (products, "product_key", "inner"),
            (sellers, "seller_key", "inner"),
        ],
    )
    return joined.select(
        "order_id", F.col("full_date").alias("purchase_date"), "year_month", "month_name", "year",
        "customer_city", "customer_state", "customer_region",
        "product_category_name", "product_category_english", "weight_category",
        "seller_city", "seller_state", "order_status", "delivery_status",
        "payment_type", "payment_installments", "price", "freight_value", "total_item_value",
        "delivery_days", "delivery_delay_days",
    )


def vw_satisfaction_analysis(fact: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    joined = J.star_join(
        fact,
        [
            (dates, F.col("review_date_key") == F.col("date_key"), "inner"),
            (customers.drop("customer_id"), "customer_key", "inner"),
            (products, "product_key", "left"),
        ],
    )
    return joined.select(
        "review_id", "order_id", F.col("full_date").alias("review_date"), "year_month", "month_name", "year",
        "customer_city", "customer_state", "customer_region", "product_category_name", "product_category_english",
        "review_score", "sentiment_category", "has_comment", "comment_length", "response_time_hours",
        "review_comment_title", "review_comment_message",
    )


def enriched_orders(orders: DataFrame, payments: DataFrame, customers: DataFrame, reviews: DataFrame) -> DataFrame:
    paid = payments.groupBy("order_id").agg(
        S.money(F.sum("payment_value")).alias("total_payment"),
        F.min_by("payment_type", "payment_sequential").alias("payment_type"),
    )
    rated = reviews.groupBy("order_id").agg(F.avg("review_score").alias("avg_review_score"))
    return (
        orders.join(paid, "order_id", "left")
        .join(rated, "order_id", "left")
        .join(customers.select("customer_id", "customer_state", "customer_city"), "customer_id", "left")
        .withColumns(
            {
                "delivery_days": S.elapsed_days("order_purchase_timestamp", "order_delivered_customer_date"),
                "purchase_date": F.to_date("order_purchase_timestamp"),
            }
        )
    )


# --- bundles -----------------------------------------------------------------
@dataclass(frozen=True)
class Refined:
    fact_orders: DataFrame
    fact_reviews: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_seller: DataFrame
    dim_date: DataFrame


PRODUCT_DIM = [
    "product_id", "product_category_name", "product_category_name_english", "product_weight_g", "product_length_cm",
    "product_height_cm", "product_width_cm", "product_volume_cm3", "product_photos_qty",
]


def build_refined(t: Trusted, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> Refined:
    """`keep` (table, name) may write the tables that others are made from, for a caller who reads them more than once."""
    customer = simple_dim(
        t.customers, "customer_id", "customer_sk",
        ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    )
    product = simple_dim(t.products, "product_id", "product_sk", PRODUCT_DIM)
    seller = simple_dim(t.sellers, "seller_id", "seller_sk", ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"])
    customer, product, seller = keep(customer, "dim_customer"), keep(product, "dim_product"), keep(seller, "dim_seller")
    fact = keep(fact_orders_agg(t, customer, product, seller), "fact_orders")
    return Refined(
        fact_orders=fact,
        fact_reviews=fact_reviews_meta(t.order_reviews, fact),
        dim_customer=customer,
        dim_product=product,
        dim_seller=seller,
        dim_date=dim_date_observed(t.orders),
    )
