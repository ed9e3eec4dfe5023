"""Join helpers that leave the physical strategy to Catalyst and AQE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def attach(fact: DataFrame, dim: DataFrame, on: str | Column, how: str = "left") -> DataFrame:
    """Fact-to-dimension join on a unique dimension key.

    No hint: Spark broadcasts the dimension while its measured size is below
    spark.sql.autoBroadcastJoinThreshold, and shuffles otherwise, when AQE splits hot fact keys.
    """
    return fact.join(dim, on, how)


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str | Column, str]]) -> DataFrame:
    for dim, on, how in dims:
        fact = attach(fact, dim, on, how)
    return fact


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table to every row (scalar subqueries, no row product)."""
    return df.withColumns({c: total.select(c).scalar() for c in total.columns})


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null child keys without a parent."""
    keys = child.where(F.col(child_key).isNotNull()).select(F.col(child_key).alias("orphan")).distinct()
    return keys.join(parent.select(F.col(parent_key).alias("orphan")).distinct(), "orphan", "left_anti")
