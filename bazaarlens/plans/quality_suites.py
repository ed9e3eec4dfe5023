"""The rule sets: expectations per table, consistency checks, documented rules, contracts, gates."""

from __future__ import annotations

from dataclasses import dataclass

from bazaarlens.functions import fixed
from bazaarlens.operators.quality import Rule

# --- fixed values: limits, domains and thresholds of the rules --------------------
ZIP = r"^\d{5}$"
SCORES = (1, 2, 3, 4, 5)
VOLUME = {
    "orders": (90_000, 110_000),
    "order_items": (100_000, 125_000),
    "order_reviews": (90_000, 110_000),
    "customers": (90_000, 110_000),
    "products": (28_000, 38_000),
    "sellers": (2_500, 4_000),
    "geolocation": (900_000, 1_100_000),
    "category_translation": (60, 80),
}


def filled(table: str, columns: list[str]) -> list[Rule]:
    return [Rule(table, "not_null", c, "completeness") for c in columns]


def key(table: str, column: str) -> Rule:
    return Rule(table, "unique", column, "uniqueness")


def in_set(table: str, column: str, values) -> Rule:
    return Rule(table, "in_set", column, "validity", tuple(values))


def between(table: str, column: str, low, high, mostly: float = 1.0) -> Rule:
    return Rule(table, "between", column, "validity", (low, high), mostly)


def volume(table: str) -> Rule:
    return Rule(table, "row_count", "TABLE", "volume", VOLUME[table])


EXPECTATIONS: list[Rule] = [
    *filled("orders", ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_estimated_delivery_date"]),
    key("orders", "order_id"),
    in_set("orders", "order_status", fixed.ORDER_STATUSES),
    volume("orders"),
    *filled("order_items", ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]),
    key("order_items", "order_id, order_item_id"),
    between("order_items", "price", 0.01, 10_000),
    between("order_items", "freight_value", 0, 5_000),
    between("order_items", "order_item_id", 1, 999),
    volume("order_items"),
    *filled("order_payments", ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]),
    key("order_payments", "order_id, payment_sequential"),
    in_set("order_payments", "payment_type", fixed.PAYMENT_TYPES),
    between("order_payments", "payment_value", 0.01, 100_000),
    between("order_payments", "payment_installments", 1, 24),
    between("order_payments", "payment_sequential", 1, 29),
    *filled("order_reviews", ["review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"]),
    key("order_reviews", "review_id"),
    in_set("order_reviews", "review_score", SCORES),
    Rule("order_reviews", "length", "review_comment_title", "validity", (1, 255), 0.99),
    volume("order_reviews"),
    *filled("customers", ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]),
    key("customers", "customer_id"),
    in_set("customers", "customer_state", fixed.STATES),
    Rule("customers", "regex", "customer_zip_code_prefix", "validity", (ZIP,)),
    Rule("customers", "length", "customer_zip_code_prefix", "validity", (5, 5)),
    volume("customers"),
    *filled("products", ["product_id"]),
    key("products", "product_id"),
    Rule("products", "not_null", "product_category_name", "completeness", (), 0.95),
    *[between("products", c, 1, 100_000, 0.999) for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")],
    between("products", "product_photos_qty", 1, 20, 0.999),
    volume("products"),
    *filled("sellers", ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]),
    key("sellers", "seller_id"),
    in_set("sellers", "seller_state", fixed.STATES),
    Rule("sellers", "regex", "seller_zip_code_prefix", "validity", (ZIP,)),
    volume("sellers"),
    *filled("geolocation", ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"]),
    between("geolocation", "geolocation_lat", *fixed.DQ_BOX["lat"], 0.999),
    between("geolocation", "geolocation_lng", *fixed.DQ_BOX["lng"], 0.999),
    in_set("geolocation", "geolocation_state", fixed.STATES),
    Rule("geolocation", "regex", "geolocation_zip_code_prefix", "validity", (ZIP,)),
    volume("geolocation"),
    *filled("category_translation", ["product_category_name", "product_category_name_english"]),
    key("category_translation", "product_category_name"),
    key("category_translation", "product_category_name_english"),
    volume("category_translation"),
]


def refers(child: str, column: str, parent: str, threshold: float = 1.0, parent_column: str | None = None) -> Rule:
    return Rule(child, "refers", column, "consistency", (parent, parent_column or column), threshold)


def ordered(table: str, earlier: str, later: str, threshold: float = 0.995) -> Rule:
    return Rule(table, "check", f"{earlier}, {later}", "consistency", (f"{earlier} <= {later}",), threshold)


REFERENCES = [
    refers("orders", "customer_id", "customers"),
    refers("order_items", "order_id", "orders"),
    refers("order_items", "product_id", "products"),
    refers("order_items", "seller_id", "sellers"),
    refers("order_payments", "order_id", "orders"),
    refers("order_reviews", "order_id", "orders"),
]
DATE_ORDERS = [
    ordered("orders", "order_purchase_timestamp", "order_approved_at"),
    ordered("orders", "order_approved_at", "order_delivered_carrier_date"),
    ordered("orders", "order_delivered_carrier_date", "order_delivered_customer_date"),
    ordered("orders", "order_purchase_timestamp", "order_estimated_delivery_date"),
    ordered("order_reviews", "review_creation_date", "review_answer_timestamp"),
]


def check(table: str, column: str, text: str, dimension: str = "validity", threshold: float = 1.0, strict: bool = False) -> Rule:
    return Rule(table, "check", column, dimension, (text,), threshold, strict)


def limits(table: str, column: str, low, high, threshold: float, dimension: str = "validity") -> Rule:
    return Rule(table, "between", column, dimension, (low, high), threshold)


CATALOG: list[Rule] = [
    *filled("orders", ["order_id"]),
    key("orders", "order_id"),
    *filled("orders", ["customer_id"]),
    in_set("orders", "order_status", fixed.ORDER_STATUSES),
    *filled("orders", ["order_purchase_timestamp", "order_estimated_delivery_date"]),
    ordered("orders", "order_purchase_timestamp", "order_delivered_customer_date", 1.0),
    ordered("orders", "order_purchase_timestamp", "order_approved_at", 1.0),
    volume("orders"),
    check("orders", "order_delivered_customer_date", "order_delivered_customer_date is not null or order_status <> 'delivered'", "consistency", 0.995),
    *filled("order_items", ["order_id"]),
    check("order_items", "order_item_id", "order_item_id >= 1", strict=True),
    *filled("order_items", ["product_id", "seller_id"]),
    check("order_items", "price", "price > 0"),
    check("order_items", "freight_value", "freight_value >= 0"),
    key("order_items", "order_id, order_item_id"),
    limits("order_items", "price", 0.85, 6735, 0.99, "accuracy"),
    refers("order_items", "product_id", "products", 0.999),
    refers("order_items", "seller_id", "sellers", 0.999),
    *filled("order_payments", ["order_id"]),
    check("order_payments", "payment_sequential", "payment_sequential >= 1", strict=True),
    in_set("order_payments", "payment_type", fixed.PAYMENT_TYPES),
    check("order_payments", "payment_installments", "payment_installments >= 1"),
    check("order_payments", "payment_value", "payment_value > 0"),
    key("order_payments", "order_id, payment_sequential"),
    check("order_payments", "payment_installments", "payment_type <> 'boleto' or payment_installments = 1", "consistency"),
    *filled("order_reviews", ["review_id"]),
    key("order_reviews", "review_id"),
    *filled("order_reviews", ["order_id"]),
    limits("order_reviews", "review_score", 1, 5, 1.0),
    *filled("order_reviews", ["review_creation_date"]),
    ordered("order_reviews", "review_creation_date", "review_answer_timestamp", 1.0),
    refers("order_reviews", "order_id", "orders", 0.999),
    key("customers", "customer_id"),
    *filled("customers", ["customer_unique_id", "customer_zip_code_prefix"]),
    Rule("customers", "regex", "customer_zip_code_prefix", "validity", (ZIP,)),
    in_set("customers", "customer_state", fixed.STATES),
    *filled("customers", ["customer_city"]),
    key("products", "product_id"),
    *[check("products", c, f"{c} > 0") for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")],
    check("products", "product_photos_qty", "product_photos_qty >= 1"),
    Rule("products", "not_null", "product_category_name", "completeness", (), 0.95),
    limits("geolocation", "geolocation_lat", *fixed.DQ_BOX["lat"], 0.999),
    limits("geolocation", "geolocation_lng", *fixed.DQ_BOX["lng"], 0.999),
    *filled("geolocation", ["geolocation_zip_code_prefix"]),
    in_set("geolocation", "geolocation_state", fixed.STATES),
    volume("geolocation"),
]
STAR_CONTRACTS: list[Rule] = [
    check("fact_orders", "price", "price >= 0"),
    check("fact_orders", "freight_value", "freight_value >= 0"),
    *filled("fact_orders", ["customer_key"]),
    limits("fact_orders", "purchase_date_key", 20160101, 20181231, 1.0),
    limits("fact_reviews", "review_score", 1, 5, 1.0),
    check("fact_reviews", "response_time_hours", "response_time_hours >= 0"),
    *filled("dim_customer", ["customer_unique_id"]),
    check("dim_date", "date_key", "date_key = year(full_date) * 10000 + month(full_date) * 100 + day(full_date)", "consistency"),
    limits("dim_geography", "latitude", -90, 90, 1.0),
    limits("dim_geography", "longitude", -180, 180, 1.0),
]
ZONE_ASSERTS: list[Rule] = [
    key("orders", "order_id"),
    check("order_items", "price", "price >= 0", strict=True),
    Rule("order_reviews", "between", "review_score", "validity", (1, 5), 1.0, True),
]


@dataclass(frozen=True)
class Gate:
    rule: Rule
    action: str


GATES: list[Gate] = [
    Gate(filled("orders", ["order_id"])[0], "block"),
    Gate(filled("orders", ["customer_id"])[0], "block"),
    Gate(filled("order_items", ["price"])[0], "block"),
    Gate(key("orders", "order_id"), "block"),
    Gate(key("customers", "customer_id"), "block"),
    Gate(limits("order_reviews", "review_score", 1, 5, 1.0), "block"),
    Gate(check("order_items", "price", "price > 0"), "block"),
    Gate(check("geolocation", "geolocation_lat, geolocation_lng", "geolocation_lat between -33.75 and 5.27 and geolocation_lng between -73.99 and -28.85", threshold=0.999), "filter_and_log"),
    Gate(refers("orders", "customer_id", "customers", 0.999), "alert"),
    Gate(ordered("orders", "order_purchase_timestamp", "order_estimated_delivery_date"), "alert"),
    Gate(volume("orders"), "alert"),
]
# --- end of fixed values ----------------------------------------------------------


def of_kind(kind: str, rules: list[Rule] = EXPECTATIONS) -> list[Rule]:
    return [r for r in rules if r.kind == kind]
