"""Registry of named queries: a Spark callable per key and, where SQL can say it, the oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.oracle.tables import lib
from bazaarlens.sources.market import Market

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register `fn(market) -> DataFrame` under `key`, with its oracle query."""

    def wrap(fn: Callable[[Market], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = lambda spark, root: fn(Market(spark, root))
        if sql is not None:
            ORACLE[key] = lib.with_tables(sql)
        return fn

    return wrap
