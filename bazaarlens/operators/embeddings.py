"""Dense vectors: class centroids, nearest classes, nearest products per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BLOCK = 256  # centroids per block; a block is one bounded array


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def centroids(df: DataFrame, label: str, dim: int) -> DataFrame:
    """Mean vector per label, one partial aggregate per task and label."""
    means = [F.avg(F.col("embedding")[i].cast("double")) for i in range(dim)]
    return df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("category")).agg(F.array(*means).alias("centre"))


def class_scores(df: DataFrame, centres: DataFrame) -> DataFrame:
    """Cosine of every row with every class centre.

    Centres are packed into blocks of bounded size and met through an equality join on the block
    number; Spark broadcasts the block table while it is small.
    """
    numbered = centres.withColumn("block", F.floor((F.row_number().over(W.orderBy("category")) - 1) / BLOCK))
    blocks = numbered.groupBy("block").agg(F.collect_list(F.struct("category", "centre")).alias("centres"))
    n_blocks = blocks.select(F.count("*")).scalar()
    spread = df.withColumn("n_blocks", n_blocks).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)))
    vector = F.transform("embedding", lambda x: x.cast("double"))
    met = spread.withColumn("vector", vector).join(blocks, "block").select("product_id", "vector", F.explode("centres").alias("c"))
    norm = lambda v: F.sqrt(_dot(v, v))
    cosine = _dot(F.col("vector"), F.col("c.centre")) / (norm(F.col("vector")) * norm(F.col("c.centre")))
    return met.select("product_id", F.col("c.category").alias("category"), F.round(cosine, 6).alias("similarity"))


def zero_shot(df: DataFrame, label: str, dim: int) -> DataFrame:
    """Nearest class for rows without one."""
    scores = class_scores(df.where(F.col(label).isNull()), centroids(df, label, dim))
    best = scores.groupBy("product_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "category")).alias("b"))
    return best.select("product_id", F.col("b.category").alias("assigned_category"), (-F.col("b.s")).alias("similarity"))


def nearest_products(df: DataFrame, label: str, dim: int, k: int) -> DataFrame:
    """The k products nearest to each class centre."""
    place = F.row_number().over(W.partitionBy("category").orderBy(F.desc("similarity"), "product_id"))
    return class_scores(df, centroids(df, label, dim)).withColumn("place", place).where(F.col("place") <= k)
