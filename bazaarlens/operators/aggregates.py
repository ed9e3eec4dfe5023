"""Aggregates that need more than one built-in call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bazaarlens.functions import scalars as S
from bazaarlens.operators.ranges import exact_quantiles
from bazaarlens.sources.io import stage


def value_counts(df: DataFrame, column: str, drop_null: bool = True) -> DataFrame:
    src = df.where(F.col(column).isNotNull()) if drop_null else df
    return src.groupBy(column).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Rows per bin of [lo, hi]; empty bins are left out."""
    return (
        df.select(S.bucket_of(column, lo, hi, bins).alias("bin"))
        .where("bin is not null")
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
        .withColumn("bin_start", F.lit(float(lo)) + F.col("bin") * F.lit((hi - lo) / bins))
    )


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles and the whiskers: the outermost values within 1.5 interquartile ranges."""
    q = stage(exact_quantiles(df, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}), "quartiles")  # one row, read often
    fences = q.select("*", (F.expr("q1 - 1.5 * (q3 - q1)")).alias("lo"), F.expr("q3 + 1.5 * (q3 - q1)").alias("hi"))
    x = F.col(column).cast("double")
    inside = df.select(x.alias("x")).withColumns({"lo": fences.select("lo").scalar(), "hi": fences.select("hi").scalar()})
    ends = inside.where("x between lo and hi").agg(F.min("x").alias("whisker_low"), F.max("x").alias("whisker_high"))
    return ends.withColumns({c: q.select(c).scalar() for c in ["q1", "median", "q3"]})


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 2) -> DataFrame:
    """Percent of the grand total. Use on aggregated rows: the window has one partition."""
    return df.withColumn(name, S.percent(F.col(value), F.sum(value).over(W.partitionBy()), digits))


def duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """rows - distinct rows, through one grouping (no DISTINCT over the raw rows)."""
    columns = columns or df.columns
    groups = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_distinct")).select(
        "n_rows", "n_distinct", (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates")
    )


def sample_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """n rows in the order of a hash of the key: a repeatable sample, kept per task before merging."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
