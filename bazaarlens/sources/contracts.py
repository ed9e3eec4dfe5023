"""Typed table contracts of the three zones: 9 raw, 9 trusted and 7 refined tables.

A contract is a `StructType` whose nullability and comments say what a column must hold; primary
and unique keys are kept next to it and become data-quality rules (Spark does not enforce keys).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: column lists in DDL -------------------------------
TRUSTED = {
    "stg_orders": (
        "order_id string NOT NULL, customer_id string NOT NULL, order_status string NOT NULL, order_purchase_timestamp timestamp_ntz NOT NULL, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
        ["order_id"],
    ),
    "stg_order_items": (
        "order_id string NOT NULL, order_item_id int NOT NULL, product_id string NOT NULL, seller_id string NOT NULL, "
        "shipping_limit_date timestamp_ntz NOT NULL, price decimal(12,2) NOT NULL, freight_value decimal(12,2) NOT NULL",
        ["order_id", "order_item_id"],
    ),
    "stg_order_payments": (
        "order_id string NOT NULL, payment_sequential int NOT NULL, payment_type string NOT NULL, payment_installments int NOT NULL, payment_value decimal(12,2) NOT NULL",
        ["order_id", "payment_sequential"],
    ),
    "stg_order_reviews": (
        "review_id string NOT NULL, order_id string NOT NULL, review_score int NOT NULL, review_comment_title string, review_comment_message string, "
        "review_creation_date timestamp_ntz NOT NULL, review_answer_timestamp timestamp_ntz",
        ["review_id"],
    ),
    "stg_customers": (
        "customer_id string NOT NULL, customer_unique_id string NOT NULL, customer_zip_code_prefix string NOT NULL, customer_city string NOT NULL, customer_state string NOT NULL",
        ["customer_id"],
    ),
    "stg_products": (
        "product_id string NOT NULL, product_category_name string, product_name_length int, product_description_length int, "
        "product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int",
        ["product_id"],
    ),
    "stg_sellers": (
        "seller_id string NOT NULL, seller_zip_code_prefix string NOT NULL, seller_city string NOT NULL, seller_state string NOT NULL",
        ["seller_id"],
    ),
    "stg_geolocation": (
        "zip_code_prefix string NOT NULL, latitude decimal(12,8) NOT NULL, longitude decimal(12,8) NOT NULL, city string NOT NULL, state string NOT NULL",
        ["zip_code_prefix"],
    ),
    "stg_category_translation": (
        "product_category_name string NOT NULL, product_category_name_english string NOT NULL",
        ["product_category_name"],
    ),
}
REFINED = {
    "dim_date": (
        "date_key int NOT NULL, full_date date NOT NULL, year int NOT NULL, quarter int NOT NULL, month int NOT NULL, month_name string NOT NULL, week int NOT NULL, day_of_month int NOT NULL, "
        "day_of_week int NOT NULL, day_of_week_name string NOT NULL, is_weekend boolean NOT NULL, is_holiday boolean NOT NULL",
        ["date_key"], [],
    ),
    "dim_customer": (
        "customer_key bigint NOT NULL, customer_unique_id string NOT NULL, customer_city string NOT NULL, customer_state string NOT NULL, "
        "customer_zip_code string NOT NULL, customer_region string",
        ["customer_key"], ["customer_unique_id"],
    ),
    "dim_product": (
        "product_key bigint NOT NULL, product_id string NOT NULL, product_category_name string, product_category_english string, "
        "product_name_length int, product_description_length int, product_photos_qty int, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int",
        ["product_key"], ["product_id"],
    ),
    "dim_seller": (
        "seller_key bigint NOT NULL, seller_id string NOT NULL, seller_city string NOT NULL, seller_state string NOT NULL, seller_zip_code string NOT NULL, seller_region string",
        ["seller_key"], ["seller_id"],
    ),
    "dim_geography": (
        "geography_key bigint NOT NULL, zip_code string NOT NULL, city string NOT NULL, state string NOT NULL, region string, latitude decimal(12,8), longitude decimal(12,8)",
        ["geography_key"], ["zip_code"],
    ),
    "fact_orders": (
        "order_item_key bigint NOT NULL, order_id string NOT NULL, order_item_sequence int NOT NULL, customer_key bigint NOT NULL, product_key bigint NOT NULL, "
        "seller_key bigint NOT NULL, date_key int NOT NULL, geography_key bigint NOT NULL, payment_type string, order_status string NOT NULL, "
        "price decimal(12,2) NOT NULL, freight_value decimal(12,2) NOT NULL, payment_value decimal(12,2), payment_installments int",
        ["order_item_key"], [],
    ),
    "fact_reviews": (
        "review_key bigint NOT NULL, review_id string NOT NULL, order_id string NOT NULL, customer_key bigint NOT NULL, product_key bigint NOT NULL, date_key int NOT NULL, "
        "review_score int NOT NULL, response_time_hours decimal(10,2), review_comment_title string, review_comment_message string, "
        "review_answer_timestamp timestamp_ntz",
        ["review_key"], ["review_id"],
    ),
}
COMMENTS = {
    "customer_key": "Surrogate key; -1 is the unknown member",
    "product_key": "Surrogate key; -1 is the unknown member",
    "seller_key": "Surrogate key; -1 is the unknown member",
    "geography_key": "Customer postal area; -1 is the unknown member",
    "date_key": "Day as YYYYMMDD",
    "order_id": "Order number, kept in facts for cross-fact analysis",
    "customer_id": "Customer number of one order",
    "customer_unique_id": "Customer number of the person, across orders",
    "price": "Additive measure: unit price",
    "freight_value": "Additive measure: freight of the item",
    "payment_value": "Additive measure: payment attributed to the item",
    "payment_installments": "Use averages, not sums",
    "review_score": "1 (worst) to 5 (best)",
}
RAW_NAMES = {  # raw tables keep the misspelt source columns and hold text only
    "product_name_length": "product_name_lenght",
    "product_description_length": "product_description_lenght",
}
KEY_DEFAULT = -1
# --- end of fixed values ----------------------------------------------------------


@dataclass(frozen=True)
class Contract:
    name: str
    zone: str
    schema: T.StructType
    primary_key: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    defaults: dict = field(default_factory=dict)


TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType()}
COLUMN = re.compile(r"(\w+) (?:decimal\((\d+),(\d+)\)|(\w+))( NOT NULL)?(?:, |$)")


def _schema(ddl: str) -> T.StructType:
    """The DDL as a schema, with the comments of the columns that have one; needs no session, so it can be read on import."""
    fields = []
    for name, digits, scale, kind, required in COLUMN.findall(ddl):
        dtype = T.DecimalType(int(digits), int(scale)) if digits else TYPES[kind]
        fields.append(T.StructField(name, dtype, not required, {"comment": COMMENTS[name]} if name in COMMENTS else {}))
    return T.StructType(fields)


def contracts() -> dict[str, Contract]:
    out = {}
    for name, (text, key) in TRUSTED.items():
        schema = _schema(text)
        raw_fields = [T.StructField(RAW_NAMES.get(f.name, f.name), T.StringType(), True) for f in schema.fields]
        raw = name.replace("stg_", "raw_")
        stamp = T.StructField("_ingested_at", T.TimestampNTZType(), False)
        out[raw] = Contract(raw, "raw", T.StructType([*raw_fields, stamp]))
        out[name] = Contract(name, "trusted", T.StructType([*schema.fields, stamp]), key)
    for name, (text, key, unique) in REFINED.items():
        schema = _schema(text)
        keys = [f.name for f in schema.fields if f.name.endswith("_key") and f.name not in key]
        defaults = {k: KEY_DEFAULT for k in keys} if name.startswith("fact_") else {}
        tail = [T.StructField("_loaded_at", T.TimestampNTZType(), False), T.StructField("_source", T.StringType(), False)]
        out[name] = Contract(name, "refined", T.StructType([*schema.fields, *([] if name == "dim_date" else tail)]), key, unique, defaults)
    return out


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Select the contract's columns, cast to its types, with defaults for missing keys."""
    cols = []
    for f in contract.schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
        elif f.name in ("_ingested_at", "_loaded_at"):
            c = F.current_timestamp()
        elif f.name == "_source":
            c = F.lit(contract.name)
        else:
            c = F.lit(None)
        c = c.cast(f.dataType)
        if f.name in contract.defaults:
            c = F.coalesce(c, F.lit(contract.defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name, metadata=f.metadata))
    return df.select(cols)
