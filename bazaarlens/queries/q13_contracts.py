"""All table contracts, checked over landing rows and the star."""

from __future__ import annotations

from pyspark.sql import types as T

from bazaarlens.operators import contract_checks as K
from bazaarlens.oracle.registry import QUERIES, query
from bazaarlens.queries.q03_star import Warehouse
from bazaarlens.sources import contracts, io

# raw and trusted contracts are checked on the landing rows, as they would be loaded; refined ones on the star
LANDING = {
    "orders": ("landing_orders", "l_orders"), "order_items": ("landing_order_items", "l_items"), "order_payments": ("landing_order_payments", "l_payments"),
    "order_reviews": ("landing_order_reviews", "l_reviews"), "customers": ("customers", "m_customers"), "products": ("landing_products", "l_products"),
    "sellers": ("sellers", "m_sellers"), "geolocation": ("landing_geolocation", "m_geo"), "category_translation": ("translation", "m_translation"),
}
STAR = {"dim_date": "d_date_ddl", "dim_customer": "d_customer", "dim_product": "d_product", "dim_seller": "d_seller", "dim_geography": "d_geography", "fact_orders": "f_orders", "fact_reviews": "f_reviews"}
POINTS = {"zip_code_prefix": "geolocation_zip_code_prefix", "latitude": "geolocation_lat", "longitude": "geolocation_lng", "city": "geolocation_city", "state": "geolocation_state"}
NAMES = {
    "raw_geolocation": POINTS,
    "stg_geolocation": POINTS,
    "stg_products": contracts.RAW_NAMES,
    "dim_customer": {"customer_zip_code": "customer_zip_code_prefix"},
    "dim_seller": {"seller_zip_code": "seller_zip_code_prefix"},
    "fact_orders": {"order_item_sequence": "order_item_id", "date_key": "purchase_date_key"},
    "fact_reviews": {"date_key": "review_date_key"},
}


def tables_of(m) -> dict:
    w = Warehouse(m)
    found = {f"{zone}_{name}": getattr(m, attribute) for name, (attribute, _) in LANDING.items() for zone in ("raw", "stg")}
    found |= {name: getattr(w, name) for name in STAR if name != "dim_date"}
    found["fact_reviews"] = io.stage(found["fact_reviews"], "fact_reviews")
    return found | {"dim_date": QUERIES["dim_date_ddl"](m.spark, m.root)}


# --- the same checks as SQL ---------------------------------------------------------------
def _type(t: T.DataType) -> str:
    return {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}.get(t.simpleString(), t.simpleString().upper())


def _same(kind: str, t: T.DataType) -> bool:
    return kind == _type(t)


def _column_sql(contract, table: str, kinds: dict[str, str]) -> str | None:
    names, out = NAMES.get(contract.name, {}), []
    for f in K.columns_of(contract):
        source = names.get(f.name, f.name)
        known = source in kinds
        given = f'"{source}"' if known else f"NULL::{_type(f.dataType)}"
        value = f"TRY_CAST({given} AS {_type(f.dataType)})"
        if known and not _same(kinds[source], f.dataType):
            out.append(("TYPE", f.name, f"{given} IS NOT NULL AND {value} IS NULL"))
        if isinstance(f.dataType, T.StringType) and f.name in K.LENGTHS and contract.zone != "raw":
            out.append(("LENGTH", f.name, f"length({value}) > {K.LENGTHS[f.name]}"))
        if f.name in contract.defaults:
            out.append(("DEFAULT", f.name, f"{value} IS NULL"))
            value = f"coalesce({value}, {contract.defaults[f.name]})"
        if not f.nullable:
            out.append(("NOT NULL", f.name, f"{value} IS NULL"))
    if not out:
        return None
    rows = ", ".join(f"{{'table_name': '{contract.name}', 'constraint_type': '{k}', 'column_name': '{c}', 'n_rows': n, 'n_faults': f{i}}}" for i, (k, c, _) in enumerate(out))
    sums = ", ".join(f"count(*) FILTER (WHERE {bad}) AS f{i}" for i, (_, _, bad) in enumerate(out))
    return f"SELECT unnest([{rows}], recursive := true) FROM (SELECT count(*) AS n, {sums} FROM {table})"


def _key_sql(contract, kind: str, keys: list[str], table: str, kinds: dict[str, str]) -> str:
    names = NAMES.get(contract.name, {})
    fields = {f.name: f for f in contract.schema.fields}
    value = lambda k: f"TRY_CAST({names.get(k, k)} AS {_type(fields[k].dataType)})" if names.get(k, k) in kinds else "NULL"
    whole = " AND ".join(f"{value(k)} IS NOT NULL" for k in keys)
    return f"SELECT '{contract.name}', '{kind}', '{', '.join(keys)}', count(*), count(*) FILTER (WHERE {whole}) - count(DISTINCT ({', '.join(value(k) for k in keys)})) FILTER (WHERE {whole}) FROM {table}"


def oracle_sql(kinds: dict[str, dict[str, str]]) -> str:
    """`kinds`: SQL types of the columns per contract."""
    tables = {f"{zone}_{name}": sql for name, (_, sql) in LANDING.items() for zone in ("raw", "stg")} | STAR
    parts = []
    for name, contract in contracts.contracts().items():
        parts.append(_column_sql(contract, tables[name], kinds[name]))
        if contract.primary_key:
            parts.append(_key_sql(contract, "PRIMARY KEY", contract.primary_key, tables[name], kinds[name]))
        if contract.unique:
            parts.append(_key_sql(contract, "UNIQUE", contract.unique, tables[name], kinds[name]))
        for key, dim in K.REFERENCES.get(name, {}).items():
            source = NAMES.get(name, {}).get(key, key)
            given = f"coalesce({source}, -1)" if source in kinds[name] else "-1"
            parts.append(f"SELECT '{name}', 'FOREIGN KEY', '{key}', count(*), count(*) FILTER (WHERE {given} <> -1 AND {given} NOT IN (SELECT {key} FROM {tables[dim]})) FROM {tables[name]}")
    return " UNION ALL ".join(p for p in parts if p)


_TEXT, _DATES = "VARCHAR", "TIMESTAMP"
_landing = {name: {f.name: _TEXT for f in c.schema.fields} for name, c in contracts.contracts().items() if c.zone == "raw"}
_KINDS = {}
for _name, _columns in _landing.items():
    _source = {NAMES.get(_name, {}).get(c, c): k for c, k in _columns.items() if c not in K.STAMPS}
    _KINDS[_name] = _KINDS[_name.replace("raw_", "stg_")] = _source
_big, _int, _dbl = "BIGINT", "INTEGER", "DOUBLE"
_star_types = {
    "dim_date": {f.name: _type(f.dataType) for f in contracts.contracts()["dim_date"].schema.fields},
    "dim_customer": {"customer_key": _big, "customer_unique_id": _TEXT, "customer_zip_code_prefix": _TEXT, "customer_city": _TEXT, "customer_state": _TEXT, "customer_region": _TEXT},
    "dim_product": {"product_key": _big, "product_id": _TEXT, "product_category_name": _TEXT, "product_category_english": _TEXT, **{c: _int for c in ("product_name_length", "product_description_length", "product_photos_qty")}, **{c: _dbl for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")}},
    "dim_seller": {"seller_key": _big, "seller_id": _TEXT, "seller_zip_code_prefix": _TEXT, "seller_city": _TEXT, "seller_state": _TEXT},
    "dim_geography": {"geography_key": _big, "zip_code": _TEXT, "city": _TEXT, "state": _TEXT, "region": _TEXT, "latitude": _dbl, "longitude": _dbl},
    "fact_orders": {"order_item_key": _TEXT, "order_id": _TEXT, "order_item_id": _int, "customer_key": _big, "product_key": _big, "seller_key": _big, "purchase_date_key": _int, "payment_type": _TEXT, "order_status": _TEXT, "price": "DECIMAL(12,2)", "freight_value": "DECIMAL(12,2)", "payment_value": "DECIMAL(12,2)", "payment_installments": _int},
    "fact_reviews": {"review_id": _TEXT, "order_id": _TEXT, "customer_key": _big, "product_key": _big, "review_date_key": _int, "review_score": _int, "response_time_hours": _big, "review_comment_title": _TEXT, "review_comment_message": _TEXT, "review_answer_timestamp": _DATES},
}
_KINDS |= _star_types


query("ddl_all_contracts", oracle_sql(_KINDS))(lambda m: K.check_contracts(contracts.contracts(), tables_of(m), NAMES))
