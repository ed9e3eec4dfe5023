"""Raw to trusted: typing, deduplication, value rules. `trusted_*` follow the warehouse rules on
text input, `clean_*` the notebook rules on typed or text input."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bazaarlens.functions import fixed
from bazaarlens.functions import scalars as S


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given total order.

    `rn = 1` lets Spark keep one row per key in every map task before the shuffle
    (WindowGroupLimit), so a hot key costs one row per task.
    """
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def total_order(df: DataFrame, *first: Column) -> list[Column]:
    """The given columns, then every column, so that equal rows are the only ties."""
    return [*first, *[F.col(c).asc_nulls_last() for c in df.columns]]


def with_loaded_at(df: DataFrame, loaded_at: str | None) -> DataFrame:
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp_ntz")
    return df.withColumn("loaded_at", stamp)


# --- warehouse rules ---------------------------------------------------------
ORDER_TIMES = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]


def trusted_orders(raw: DataFrame) -> DataFrame:
    typed = raw.where("order_id is not null and customer_id is not null").select(
        "order_id",
        "customer_id",
        F.upper(F.trim("order_status")).alias("order_status"),
        *[S.safe_timestamp(c).alias(c) for c in ORDER_TIMES],
    )
    latest = first_per_key(typed, ["order_id"], total_order(typed, F.col("order_purchase_timestamp").desc_nulls_first()))
    return latest.withColumns(
        {
            "delivery_days": S.days_between("order_purchase_timestamp", "order_delivered_customer_date"),
            "delivery_delay_days": S.days_between("order_estimated_delivery_date", "order_delivered_customer_date"),
            "delivery_status": S.delivery_status("order_delivered_customer_date", "order_estimated_delivery_date"),
        }
    )


def trusted_order_items(raw: DataFrame) -> DataFrame:
    price, freight = S.safe_decimal("price"), S.safe_decimal("freight_value")
    typed = raw.where("order_id is not null and product_id is not null").select(
        "order_id",
        S.safe_int("order_item_id").alias("order_item_id"),
        "product_id",
        "seller_id",
        S.safe_timestamp("shipping_limit_date").alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
        S.money(price + freight).alias("total_item_value"),
    )
    return typed.where("price > 0")


def trusted_payments(raw: DataFrame) -> DataFrame:
    typed = raw.where("order_id is not null").select(
        "order_id",
        S.safe_int("payment_sequential").alias("payment_sequential"),
        F.upper(F.trim("payment_type")).alias("payment_type"),
        S.safe_int("payment_installments").alias("payment_installments"),
        S.safe_decimal("payment_value").alias("payment_value"),
    )
    return typed.where("payment_value > 0")


def trusted_reviews(raw: DataFrame) -> DataFrame:
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    typed = raw.where("review_id is not null and order_id is not null").select(
        "review_id",
        "order_id",
        S.safe_int("review_score").alias("review_score"),
        blank("review_comment_title").alias("review_comment_title"),
        blank("review_comment_message").alias("review_comment_message"),
        S.safe_timestamp("review_creation_date").alias("review_creation_date"),
        S.safe_timestamp("review_answer_timestamp").alias("review_answer_timestamp"),
    )
    return typed.where(F.col("review_score").between(1, 5)).withColumns(
        {
            "response_time_hours": S.hours_between("review_creation_date", "review_answer_timestamp"),
            "sentiment_category": S.sentiment_band("review_score"),
        }
    )


def trusted_customers(raw: DataFrame) -> DataFrame:
    """One row per person: the smallest customer_id of each customer_unique_id."""
    typed = raw.where("customer_id is not null").select(
        "customer_id",
        "customer_unique_id",
        S.zero_pad(F.col("customer_zip_code_prefix").cast("string")).alias("customer_zip_code_prefix"),
        S.initcap_words(F.trim("customer_city")).alias("customer_city"),
        F.upper(F.trim("customer_state")).alias("customer_state"),
    )
    one = first_per_key(typed, ["customer_unique_id"], total_order(typed, F.col("customer_id").asc_nulls_last()))
    return one.withColumn("customer_region", S.state_to_region("customer_state", "Desconhecido"))


def trusted_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    number = lambda c: F.coalesce(S.safe_double(c), F.lit(0.0))
    count = lambda c: F.coalesce(S.safe_int(c), F.lit(0))
    t = translation.select(F.trim("product_category_name").alias("_key"), F.trim("product_category_name_english").alias("_english"))
    p = raw.where("product_id is not null")
    joined = p.join(t, F.trim("product_category_name") == F.col("_key"), "left")
    return joined.select(
        "product_id",
        F.coalesce(F.trim("product_category_name"), F.lit("sem_categoria")).alias("product_category_name"),
        F.coalesce("_english", F.lit("uncategorized")).alias("product_category_english"),
        count("product_name_lenght").alias("product_name_length"),
        count("product_description_lenght").alias("product_description_length"),
        count("product_photos_qty").alias("product_photos_qty"),
        *[number(c).alias(c) for c in ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]],
    ).withColumn("product_volume_cm3", F.round(F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"), 2))


def trusted_sellers(raw: DataFrame) -> DataFrame:
    return raw.where("seller_id is not null").select(
        "seller_id",
        S.zero_pad(F.col("seller_zip_code_prefix").cast("string")).alias("seller_zip_code_prefix"),
        S.initcap_words(F.trim("seller_city")).alias("seller_city"),
        F.upper(F.trim("seller_state")).alias("seller_state"),
    )


def inside_box(lat: str, lng: str, box: dict) -> Column:
    return F.col(lat).between(*box["lat"]) & F.col(lng).between(*box["lng"])


def modal_values(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Most frequent value per key and column (ties: lowest), counted before it is ranked."""
    out = None
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(key, c).agg(F.count("*").alias("n"))
        top = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(c).alias("v")))["v"].alias(c))
        out = top if out is None else out.join(top, key, "full")
    return out


def trusted_geolocation(raw: DataFrame, box: dict = fixed.ETL_BOX) -> DataFrame:
    points = raw.where("geolocation_zip_code_prefix is not null").select(
        S.zero_pad(F.col("geolocation_zip_code_prefix").cast("string")).alias("geolocation_zip_code_prefix"),
        S.safe_double("geolocation_lat").alias("lat"),
        S.safe_double("geolocation_lng").alias("lng"),
        S.initcap_words(F.trim("geolocation_city")).alias("geolocation_city"),
        F.upper(F.trim("geolocation_state")).alias("geolocation_state"),
    )
    points = points.where(inside_box("lat", "lng", box))
    key = "geolocation_zip_code_prefix"
    centre = points.groupBy(key).agg(
        F.round(F.avg("lat"), 6).alias("geolocation_lat"),
        F.round(F.avg("lng"), 6).alias("geolocation_lng"),
        F.count("*").alias("registro_count"),
    )
    return centre.join(modal_values(points, key, ["geolocation_city", "geolocation_state"]), key, "left")


# --- notebook rules ----------------------------------------------------------
def clean_orders(df: DataFrame) -> DataFrame:
    one = first_per_key(df, ["order_id"], total_order(df))
    kept = one.where(F.col("order_status").isin(fixed.ORDER_STATUSES))
    return kept.withColumns({c: S.safe_timestamp(c) for c in ORDER_TIMES})


def clean_order_items(df: DataFrame) -> DataFrame:
    one = first_per_key(df, ["order_id", "order_item_id"], total_order(df))
    typed = one.withColumns({c: S.safe_decimal(c) for c in ["price", "freight_value"]})
    return typed.where("price >= 0 and freight_value >= 0")


def clean_order_payments(df: DataFrame) -> DataFrame:
    one = first_per_key(df, ["order_id", "payment_sequential"], total_order(df))
    typed = one.withColumns(
        {
            "payment_value": S.safe_decimal("payment_value"),
            "payment_installments": F.coalesce(F.col("payment_installments").try_cast("int"), F.lit(1)),
        }
    )
    return typed.where("payment_value >= 0")


def clean_order_reviews(df: DataFrame) -> DataFrame:
    one = first_per_key(df, ["review_id"], total_order(df))
    typed = one.withColumn("review_score", S.safe_double("review_score").try_cast("int"))
    blank = lambda c: S.strip(F.coalesce(F.col(c), F.lit("")))
    return typed.where(F.col("review_score").between(1, 5)).withColumns(
        {c: blank(c) for c in ["review_comment_title", "review_comment_message"]}
    )


def _state_city(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumns(
        {
            f"{prefix}_state": S.strip(F.upper(f"{prefix}_state")),
            f"{prefix}_city": S.strip(F.lower(f"{prefix}_city")),
        }
    )


def clean_customers(df: DataFrame) -> DataFrame:
    return _state_city(first_per_key(df, ["customer_id"], total_order(df)), "customer")


def clean_sellers(df: DataFrame) -> DataFrame:
    return _state_city(first_per_key(df, ["seller_id"], total_order(df)), "seller")


PRODUCT_NUMBERS = [
    "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
]


def clean_products(df: DataFrame, translation: DataFrame) -> DataFrame:
    one = first_per_key(df, ["product_id"], total_order(df))
    whole = lambda c: F.coalesce(S.safe_double(c).try_cast("int"), F.lit(0))
    typed = one.withColumns({c: whole(c) for c in PRODUCT_NUMBERS if c in df.columns}).withColumns(
        {
            "product_volume_cm3": F.expr("try_multiply(try_multiply(cast(product_length_cm as bigint), product_height_cm), product_width_cm)"),
            "product_category_name": F.lower(S.strip(F.coalesce("product_category_name", F.lit("sem_categoria")))),
        }
    )
    t = translation.select(F.col("product_category_name").alias("_key"), F.col("product_category_name_english").alias("_english"))
    return (
        typed.join(t, F.col("product_category_name") == F.col("_key"), "left")
        .withColumn("product_category_name_english", F.coalesce("_english", "product_category_name"))
        .drop("_key", "_english")
    )


@dataclass(frozen=True)
class Trusted:
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame


def build_trusted(raw) -> Trusted:
    """All seven cleaners over a bundle of raw tables; nothing runs until an action."""
    return Trusted(
        orders=clean_orders(raw.orders),
        order_items=clean_order_items(raw.order_items),
        order_payments=clean_order_payments(raw.order_payments),
        order_reviews=clean_order_reviews(raw.order_reviews),
        customers=clean_customers(raw.customers),
        products=clean_products(raw.products, raw.translation),
        sellers=clean_sellers(raw.sellers),
    )


# --- documented remedies -----------------------------------------------------
NAME_FIXES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def fix_column_typos(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(NAME_FIXES)


def derive_is_delivered(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "is_delivered": F.col("order_delivered_customer_date").isNotNull(),
            "delivery_delay_days": S.floor_days("order_estimated_delivery_date", "order_delivered_customer_date"),
        }
    )


def derive_processing_days(orders: DataFrame) -> DataFrame:
    return orders.withColumn("processing_days", S.days_between("order_approved_at", "order_delivered_carrier_date"))


def dedup_latest_review(reviews: DataFrame) -> DataFrame:
    order = total_order(reviews, F.col("review_answer_timestamp").desc_nulls_first())
    return first_per_key(reviews, ["order_id"], order)


def geo_centroid_max(geo: DataFrame) -> DataFrame:
    return geo.groupBy("geolocation_zip_code_prefix").agg(
        F.round(F.avg("geolocation_lat"), 6).alias("lat"),
        F.round(F.avg("geolocation_lng"), 6).alias("lng"),
        F.max("geolocation_city").alias("city"),
        F.max("geolocation_state").alias("state"),
    )


# canonical entity -> {canonical column: source column}; fixed values
CANONICAL = {
    "customer": {
        "customer_id": "customer_id", "customer_unique_id": "customer_unique_id",
        "location_zip_code": "customer_zip_code_prefix", "location_city": "customer_city",
        "location_state": "customer_state",
    },
    "order": {
        "order_id": "order_id", "customer_id": "customer_id", "status": "order_status",
        "purchase_timestamp": "order_purchase_timestamp",
        "estimated_delivery_date": "order_estimated_delivery_date",
    },
    "product": {
        "product_id": "product_id", "category_name_pt": "product_category_name",
        "category_name_en": "product_category_name_english",
    },
    "seller": {
        "seller_id": "seller_id", "location_zip_code": "seller_zip_code_prefix",
        "location_state": "seller_state",
    },
}


def cdm_mapping(df: DataFrame, entity: str, mapping: dict = CANONICAL) -> DataFrame:
    return df.select([F.col(source).alias(target) for target, source in mapping[entity].items()])


def split_quarantine(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); a rule that is NULL rejects the row."""
    ok = F.coalesce(rule, F.lit(False))
    return df.where(ok), df.where(~ok)


def audit_columns(df: DataFrame, source: str, batch_id: str, at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    return df.withColumns(
        {
            "_dw_created_at": at,
            "_dw_updated_at": at,
            "_dw_source_table": F.lit(source),
            "_dw_batch_id": F.lit(batch_id),
        }
    )


def scd2_merge(history: DataFrame, incoming: DataFrame, keys: list[str], attributes: list[str], as_of: Column) -> DataFrame:
    """Type-2 history: close changed current rows, append new versions, keep the rest.

    One full join of current and incoming rows; closed rows of the past pass through unjoined.
    `history` has keys, attributes, `_dw_valid_from`, `_dw_valid_to`, `_dw_is_current`.
    """
    cols = [*keys, *attributes, "_dw_valid_from", "_dw_valid_to", "_dw_is_current"]
    past = history.where("not _dw_is_current").select(*cols)
    now = history.where("_dw_is_current").select(F.struct(*cols).alias("old"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    new = incoming.select(F.struct(*keys, *attributes).alias("new"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    on = [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys]
    both = now.join(new, on, "full")
    same = reduce(lambda a, b: a & b, [F.col(f"old.{a}").eqNullSafe(F.col(f"new.{a}")) for a in attributes], F.lit(True))
    changed = F.col("old").isNotNull() & F.col("new").isNotNull() & ~same
    kept = F.when(
        F.col("old").isNotNull(),
        F.struct(
            *[F.col(f"old.{c}").alias(c) for c in [*keys, *attributes, "_dw_valid_from"]],
            F.when(changed, as_of).otherwise(F.col("old._dw_valid_to")).alias("_dw_valid_to"),
            (~changed).alias("_dw_is_current"),
        ),
    )
    opened = F.when(
        F.col("old").isNull() | changed,
        F.struct(
            *[F.col(f"new.{c}").alias(c) for c in [*keys, *attributes]],
            as_of.alias("_dw_valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("_dw_valid_to"),
            F.lit(True).alias("_dw_is_current"),
        ),
    )
    versions = both.select(F.explode(F.array_compact(F.array(kept, opened))).alias("v")).select("v.*")
    return past.unionByName(versions)
