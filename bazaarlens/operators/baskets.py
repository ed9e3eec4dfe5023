"""Products bought together.

The pairs of a basket grow with its square, so pairs are made only inside baskets of a bounded
size. Products of larger baskets are grouped by the set of large baskets they occur in: all members
of such a class share the same large-basket partners, which are counted per class and never listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators.ranges import running_total
from bazaarlens.sources.io import stage

PAIR_LIMIT = 1000


def basket_lines(items: DataFrame) -> DataFrame:
    """Distinct (order, product) lines."""
    return items.where("order_id is not null and product_id is not null").select("order_id", "product_id").distinct()


def _split(lines: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    sizes = lines.groupBy("order_id").agg(F.count("*").alias("basket_size"))
    sized = lines.join(sizes, "order_id")
    return sized.where(F.col("basket_size").between(2, limit)), sized.where(F.col("basket_size") > limit)


def one_way_pairs(small: DataFrame) -> DataFrame:
    """Distinct pairs of products of a basket, the smaller one first; every line meets at most `limit` others."""
    a = small.select("order_id", F.col("product_id").alias("product_id"))
    b = small.select("order_id", F.col("product_id").alias("partner_id"))
    return a.join(b, "order_id").where("product_id < partner_id").select("product_id", "partner_id").distinct()


def small_pairs(small: DataFrame) -> DataFrame:
    """Ordered pairs of different products: made distinct in one direction and turned afterwards, so that half the rows are
    shuffled."""
    pairs = one_way_pairs(small)
    turned = F.struct(F.col("partner_id").alias("product_id"), F.col("product_id").alias("partner_id"))
    return pairs.select(F.inline(F.array(F.struct("product_id", "partner_id"), turned)))


def large_classes(large: DataFrame) -> DataFrame:
    """Product -> class. Two products share a class when they occur in the same large baskets; the
    set is compared by an order-free fingerprint, so it is never collected."""
    mark = lambda salt: F.sum(F.xxhash64("order_id", F.lit(salt)).cast("decimal(38,0)"))
    return large.groupBy("product_id").agg(
        F.concat_ws(":", F.count("*").cast("string"), mark(1).cast("string"), mark(2).cast("string")).alias("basket_class")
    )


def near_classes(large: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes that share a large basket, with the size of the second one."""
    kinds = classes.groupBy("basket_class").agg(F.count("*").alias("members"), F.min("product_id").alias("product_id"))
    spread = kinds.join(large.select("product_id", "order_id"), "product_id").select("basket_class", "members", "order_id")
    mine = spread.select(F.col("basket_class").alias("mine"), "order_id")
    return mine.join(spread, "order_id").select("mine", "basket_class", "members").distinct()


def partner_counts(items: DataFrame, limit: int = PAIR_LIMIT) -> DataFrame:
    """Distinct co-purchased partners per product that has any."""
    small, large = _split(basket_lines(items), limit)
    classes = large_classes(large)
    near = near_classes(large, classes)
    mine = classes.select("product_id", F.col("basket_class").alias("mine"))
    theirs = classes.select(F.col("product_id").alias("partner_id"), "basket_class")
    from_small = (
        small_pairs(small)
        .join(mine, "product_id", "left")
        .join(theirs, "partner_id", "left")
        .join(near.select("mine", "basket_class"), ["mine", "basket_class"], "left_anti")
        .groupBy("product_id")
        .agg(F.count("*").alias("n"))
    )
    per_class = near.groupBy("mine").agg((F.sum("members") - 1).alias("n"))
    from_large = mine.join(per_class, "mine").select("product_id", "n")
    return from_small.unionByName(from_large).groupBy("product_id").agg(F.sum("n").alias("n_partners")).where("n_partners > 0")


def bought_together(items: DataFrame, candidates: DataFrame, limit: int = PAIR_LIMIT) -> DataFrame:
    """The candidate rows (product_id, partner_id) whose two products share an order.

    Candidates look themselves up among the distinct pairs of small baskets. In larger baskets, where pairs are not listed, they
    meet the lines of their product, then one line of the same order, so that no such basket is paired with itself.
    """
    lines = basket_lines(items)
    small, large = _split(lines, limit)
    candidates = candidates.select("product_id", "partner_id")
    pairs = one_way_pairs(small).select(F.col("product_id").alias("low"), F.col("partner_id").alias("high"))
    ends = candidates.withColumns({"low": F.least("product_id", "partner_id"), "high": F.greatest("product_id", "partner_id")})
    from_small = ends.join(pairs, ["low", "high"], "left_semi").select("product_id", "partner_id")
    large = large.select("order_id", "product_id")
    partner = large.select("order_id", F.col("product_id").alias("partner_id"))
    from_large = candidates.join(large, "product_id").join(partner, ["order_id", "partner_id"], "left_semi").select("product_id", "partner_id")
    itself = candidates.where("product_id = partner_id").join(lines, "product_id", "left_semi")
    return from_small.unionByName(from_large).unionByName(itself).distinct()


def basket_lists(items: DataFrame, chunk: int = 1000) -> DataFrame:
    """Product lists per order, as numbered parts: lines sorted by product, `chunk` lines in a part, so that no list has to
    hold a whole hot order. Parts follow each other in order; an order up to `chunk` lines is part 0.

    Orders are counted first. One up to `chunk` lines is one list, made by one grouping. Lines of larger orders are numbered in
    two levels: a running total over ranges of (order, product, line), which cut a hot order into several tasks, less the total
    at the start of the order.
    """
    keys = ["order_id", "product_id", "order_item_id"]
    items = items.select(*keys)
    # at most one in `chunk` rows
    hot = stage(items.groupBy("order_id").agg(F.count("*").alias("n")).where(F.col("n") > chunk).select(F.col("order_id").alias("_order")), "hot-orders")
    same = F.col("order_id").eqNullSafe(F.col("_order"))
    whole = items if hot.isEmpty() else items.join(hot, same, "left_anti")
    lists = whole.groupBy("order_id", F.lit(0).cast("bigint").alias("part")).agg(F.array_sort(F.collect_list("product_id")).alias("products"))
    if hot.isEmpty():
        return lists
    counted = items.join(hot, same, "left_semi").groupBy(*keys).agg(F.count("*").alias("copies"))
    placed = running_total(counted, keys, F.col("copies"), "before")
    starts = placed.groupBy(F.col("order_id").alias("_order")).agg(F.min("before").alias("start"))
    numbered = placed.join(starts, F.col("order_id").eqNullSafe(F.col("_order"))).withColumn("number", F.col("before") - F.col("start"))
    lines = numbered.select("order_id", "product_id", F.explode(F.sequence("number", F.col("number") + F.col("copies") - 1)).alias("number"))
    parts = lines.select("order_id", "product_id", F.floor(F.col("number") / chunk).alias("part"))
    return lists.unionByName(parts.groupBy("order_id", "part").agg(F.array_sort(F.collect_list("product_id")).alias("products")))


class PairTable:
    """All co-purchase pairs in compressed form, from which any pair can be read with its number of orders.

    Pairs of baskets up to `limit` products are listed once, a < b, with their orders. Of larger baskets only the lines are
    kept: a basket is a clique, and its pairs are those of its lines. So the table grows with the lines, not with their square,
    also where every product has its own set of large baskets.
    """

    def __init__(self, items: DataFrame, limit: int = PAIR_LIMIT) -> None:
        small, large = _split(basket_lines(items), limit)
        a = small.select("order_id", F.col("product_id").alias("a"))
        b = small.select("order_id", F.col("product_id").alias("b"))
        pairs = a.join(b, "order_id").where("a < b").groupBy("a", "b").agg(F.count("*").alias("n_orders"))
        self.pairs = stage(pairs, "basket-pairs")
        self.cliques = stage(large.select("order_id", "product_id"), "basket-cliques")

    def partners_of(self, asked: DataFrame) -> DataFrame:
        """(product_id, partner_id, n_orders) of the asked products (`product_id`) with all others."""
        asked = asked.select("product_id").distinct()
        turned = lambda x, y: self.pairs.select(F.col(x).alias("product_id"), F.col(y).alias("partner_id"), "n_orders").join(asked, "product_id", "left_semi")
        mine = self.cliques.join(asked, "product_id", "left_semi")
        theirs = self.cliques.select("order_id", F.col("product_id").alias("partner_id"))
        met = mine.join(theirs, "order_id").where("product_id <> partner_id").groupBy("product_id", "partner_id").agg(F.count("*").alias("n_orders"))
        found = turned("a", "b").unionByName(turned("b", "a")).unionByName(met)
        return found.groupBy("product_id", "partner_id").agg(F.sum("n_orders").alias("n_orders"))
