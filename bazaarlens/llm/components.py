"""Connected components of a large edge list by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm import common as C


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the least of u and its neighbours."""
    pairs = _both_ways(edges)
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (u, v) edges; root is the least node that can be reached.

    Sums and joins only: a node with very many neighbours is one aggregate row and a join side that Spark may split.
    Stops when a round leaves the edges as they were; the number of rounds grows with the logarithm of the longest path.
    """
    current = C.staged(edges.where("u <> v").select("u", "v").distinct(), "edges")
    while True:
        following = C.staged(small_star(large_star(current).distinct()).distinct(), "edges")
        mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark(following) == mark(current):
            break
        current = following
    return following.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        following.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
