"""Catalogue operations on an assets table (id, name, type, asset_type, assetType, description, tags)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.operators.ranges import running_total

TYPE_FIELDS = ["type", "asset_type", "assetType"]


def asset_type() -> Column:
    """First non-empty of the three type fields."""
    return F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in TYPE_FIELDS])


def page(assets: DataFrame, number: int, size: int) -> DataFrame:
    """One page in id order; row numbers come from range totals, not from one sorted task."""
    placed = running_total(assets, ["id"], name="_place")
    first = (number - 1) * size
    return placed.where((F.col("_place") >= first) & (F.col("_place") < first + size)).drop("_place")


def filter_type(assets: DataFrame, wanted: str) -> DataFrame:
    match = F.lit(False)
    for c in TYPE_FIELDS:
        match = match | F.coalesce(F.lower(c) == wanted.lower(), F.lit(False))
    return assets.where(match)


def search(assets: DataFrame, text: str) -> DataFrame:
    in_tags = F.coalesce(F.exists("tags", lambda t: F.contains(F.lower(t), F.lit(text.lower()))), F.lit(False))
    return assets.where(S.contains_text("name", text) | S.contains_text("description", text) | in_tags)


def summary(assets: DataFrame) -> DataFrame:
    return assets.groupBy(F.coalesce(asset_type(), F.lit("unknown")).alias("asset_type")).agg(F.count("*").alias("n"))


def merge_tags(assets: DataFrame, targets: DataFrame, tags: list[str], append: bool = True) -> DataFrame:
    """Add (or set) tags on the assets listed in `targets` (id)."""
    new = F.array(*[F.lit(t) for t in tags])
    merged = F.array_sort(F.array_union(F.coalesce("tags", F.array().cast("array<string>")), new)) if append else new
    marked = assets.join(targets.select("id").distinct().withColumn("_hit", F.lit(True)), "id", "left")
    return marked.withColumn("tags", F.when(F.col("_hit"), merged).otherwise(F.col("tags"))).drop("_hit")
