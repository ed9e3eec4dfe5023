"""Table contracts compiled into checks: one pass per table for columns, one grouping per key, one anti join per reference.

A contract's columns become counting expressions: values that do not fit the type, texts that are too long, values for which
the default steps in, and missing values where none may be missing (after the default). They are all counted in one aggregate
over the table. A key is grouped by its columns before it is counted, so a hot key is one row per task.
A reference is checked on the distinct keys of the fact only; the default key stands for the unknown member and is no fault.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.sources.contracts import KEY_DEFAULT, Contract

# --- fixed values: longest texts of the tables, and references of the facts ------------
LENGTHS = {
    "city": 100, "customer_city": 100, "customer_id": 50, "customer_region": 20, "customer_state": 5, "customer_unique_id": 50,
    "customer_zip_code": 10, "customer_zip_code_prefix": 10, "day_of_week_name": 20, "month_name": 20, "order_id": 50, "order_status": 20,
    "payment_type": 20, "product_category_english": 100, "product_category_name": 100, "product_category_name_english": 100,
    "product_id": 50, "region": 20, "review_comment_message": 2000, "review_comment_title": 200, "review_id": 50, "seller_city": 100,
    "seller_id": 50, "seller_region": 20, "seller_state": 5, "seller_zip_code": 10, "seller_zip_code_prefix": 10, "state": 5,
    "zip_code": 10, "zip_code_prefix": 10,
}
REFERENCES = {
    "fact_orders": {"customer_key": "dim_customer", "product_key": "dim_product", "seller_key": "dim_seller", "date_key": "dim_date", "geography_key": "dim_geography"},
    "fact_reviews": {"customer_key": "dim_customer", "product_key": "dim_product", "date_key": "dim_date"},
}
STAMPS = {"_ingested_at", "_loaded_at", "_source"}  # filled on loading
# --- end of fixed values -----------------------------------------------------------------

RESULT = "table_name string, constraint_type string, column_name string, n_rows bigint, n_faults bigint"


def columns_of(contract: Contract) -> list[T.StructField]:
    return [f for f in contract.schema.fields if f.name not in STAMPS]


def source_of(f: T.StructField, df: DataFrame, names: dict[str, str]) -> str | None:
    name = names.get(f.name, f.name)
    return name if name in df.columns else None


def as_type(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """The value in the wanted type, NULL if it does not fit; text that reads as a number is rounded to a whole one."""
    if isinstance(given, T.StringType) and isinstance(wanted, (T.IntegerType, T.LongType)):
        return F.round(value.try_cast("double")).try_cast(wanted)
    return value.try_cast(wanted)


def fitted(contract: Contract, df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The contract's columns with its types (values that do not fit are NULL), before defaults."""
    return df.select(*((as_type(F.col(s), df.schema[s].dataType, f.dataType) if (s := source_of(f, df, names)) else F.lit(None).cast(f.dataType)).alias(f.name) for f in columns_of(contract)))


def column_checks(contract: Contract, df: DataFrame, names: dict[str, str]) -> list[tuple[str, str, Column]]:
    """(constraint, column, faulty) of every column rule, over the columns of `df`."""
    checks = []
    for f in columns_of(contract):
        source = source_of(f, df, names)
        given = F.col(source) if source else F.lit(None).cast(f.dataType)
        value = as_type(given, df.schema[source].dataType if source else f.dataType, f.dataType)
        if source and df.schema[source].dataType != f.dataType:
            checks.append(("TYPE", f.name, given.isNotNull() & value.isNull()))
        if isinstance(f.dataType, T.StringType) and f.name in LENGTHS and contract.zone != "raw":
            checks.append(("LENGTH", f.name, F.length(value) > LENGTHS[f.name]))
        if f.name in contract.defaults:
            checks.append(("DEFAULT", f.name, value.isNull()))
            value = F.coalesce(value, F.lit(contract.defaults[f.name]).cast(f.dataType))
        if not f.nullable:
            checks.append(("NOT NULL", f.name, value.isNull()))
    return checks


def check_columns(contract: Contract, df: DataFrame, names: dict[str, str]) -> DataFrame | None:
    """One row per column rule, from one pass."""
    checks = column_checks(contract, df, names)
    if not checks:
        return None
    counted = df.agg(F.count("*").alias("n_rows"), *(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"f{i}") for i, (_, _, bad) in enumerate(checks)))
    rows = [F.struct(F.lit(contract.name).alias("table_name"), F.lit(k).alias("constraint_type"), F.lit(c).alias("column_name"), "n_rows", F.col(f"f{i}").alias("n_faults")) for i, (k, c, _) in enumerate(checks)]
    return counted.select(F.inline(F.array(*rows)))


def check_key(contract: Contract, kind: str, keys: list[str], df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rows beyond the first of their key; keys with a missing part are no repeats."""
    given = fitted(contract, df, names).select(*keys)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    groups = given.select(*(F.when(whole, F.col(k)).alias(k) for k in keys)).groupBy(*keys).agg(F.count("*").alias("n"))
    faults = F.coalesce(F.sum(F.when(F.col(keys[0]).isNotNull(), F.col("n") - 1)), F.lit(0))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), faults.alias("n_faults")).select(
        F.lit(contract.name).alias("table_name"), F.lit(kind).alias("constraint_type"), F.lit(", ".join(keys)).alias("column_name"), "n_rows", "n_faults"
    )


def check_reference(contract: Contract, key: str, df: DataFrame, dim: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rows whose key is not in the dimension; distinct keys are counted before they meet it."""
    counts = fitted(contract, df, names).groupBy(F.coalesce(key, F.lit(KEY_DEFAULT)).cast("bigint").alias("k")).agg(F.count("*").alias("n"))
    known = dim.select(F.col(key).cast("bigint").alias("known")).where("known IS NOT NULL").distinct()
    met = counts.join(known, F.col("k") == F.col("known"), "left")
    lost = F.col("known").isNull() & (F.col("k") != KEY_DEFAULT)
    return met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("n_faults")).select(
        F.lit(contract.name).alias("table_name"), F.lit("FOREIGN KEY").alias("constraint_type"), F.lit(key).alias("column_name"), "n_rows", "n_faults"
    )


def check_contracts(contracts: dict[str, Contract], tables: dict[str, DataFrame], names: dict[str, dict[str, str]]) -> DataFrame:
    """One row per constraint of every contract: its table, kind, columns, rows and faults.

    `tables` has the data per contract, `names` the source column of contract columns that are called otherwise.
    """
    parts = []
    for name, contract in contracts.items():
        df, called = tables[name], names.get(name, {})
        parts.append(check_columns(contract, df, called))
        if contract.primary_key:
            parts.append(check_key(contract, "PRIMARY KEY", contract.primary_key, df, called))
        if contract.unique:
            parts.append(check_key(contract, "UNIQUE", contract.unique, df, called))
        for key, dim in REFERENCES.get(name, {}).items():
            parts.append(check_reference(contract, key, df, tables[dim], called))
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])
