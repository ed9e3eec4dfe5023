"""Mixing sources to target weights (6): systematic sampling over prefix sums of expected copies.

Every document of a source is expected `target / size of the source` times. The documents of a source stand in one fixed
order; the expected copies are summed along it, one random offset is added, and a document is taken once for every whole
number that its stretch of the sum crosses. So the copies of any run of documents differ from their expectation by less
than one, and as the order goes by size, so do the words; large documents come first, as the last stretch of the order weighs most.

Order and sums without a large sort: rows are dealt into cells of (source, size class, hash), about as many cells of a
source as a cell has rows; the few cell totals are summed first, then each cell on its own. Only ids, sources and sizes are
moved, never texts, and a source that holds most rows is spread over all cells.

Defined cases: NULL texts have size 0; rows of size 0 are dealt like all others and take no words. A NULL source is a
source of its own, last in order. Repeated rows are separate documents. Sources without words get target 0 and no copies.
An empty table gives an empty mix; texts of any length count whole. `mix` replaces a column named `copy`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm import common as C

WEIGHTS = (5, 2, 1)
MOST = 3.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(C.WORD)), F.lit(0)).cast("long")


def source_targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> dict[str | None, float]:
    """Target size per source: weights repeat along the sources by code point (None last); what exceeds `most` times a
    source's size is shared again among the others by weight until none exceeds."""
    named = sorted((s for s in sizes if s[0] is not None), key=lambda s: s[0].encode()) + [s for s in sizes if s[0] is None]
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(named)}
    size = dict(named)
    target: dict[str | None, float] = {}
    free = set(size)
    while free:
        left = sum(size.values()) - sum(target.values())
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > most * size[s]}
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: most * size[s] for s in over}
        free -= over
    return target


def mixed(docs: DataFrame, seed: int = 20, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Every row's _key columns (doc_id, size, source) with source_size, target, copies and taken words; no text.

    The list of sources comes to the driver as one row each (a few thousand at most are expected; it is the only list that does).
    """
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    rows = C.staged(slim, "mix-sizes")
    totals = [(r["source"], r["size"], r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()]
    target = source_targets([(s, int(w)) for s, w, _ in totals], weights, most)
    # some 40 size classes times these cells: about as many cells of a source as rows in a cell
    cells = max(1, round(max([n for *_, n in totals], default=1) ** 0.5 / 40))
    plan = docs.sparkSession.createDataFrame(
        [(s, int(w), float(target[s]), (target[s] / w) if w else 0.0) for s, w, _ in totals],
        "source string, source_size long, target double, rate double",
    )
    in_class = F.floor(F.log2(F.col("size") + 1) * 4).cast("int")
    digest = F.xxhash64(F.lit(seed), "doc_id", "size")
    dealt = rows.withColumn("class", in_class).withColumn("digest", digest).withColumn("cell", F.pmod("digest", F.lit(cells)))
    place = ["source", "class", "cell"]
    by_cell = dealt.groupBy(*place).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy(F.desc("class"), "cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_cell.select(*(F.col(c).alias(f"_{c}") for c in place), F.coalesce(before, F.lit(0)).alias("before"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("class") == F.col("_class")) & (F.col("cell") == F.col("_cell"))
    in_cell = Window.partitionBy(*place).orderBy("digest", "doc_id")
    ordered = dealt.withColumn("number", F.row_number().over(in_cell)).join(starts, same)
    known = ordered.join(F.broadcast(plan.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s")))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.lit("offset")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    rank = F.col("before") + F.col("number")
    copies = (F.floor(F.col("rate") * rank + offset) - F.floor(F.col("rate") * (rank - 1) + offset)).cast("int")
    return known.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, seed: int = 20, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken, with its copy number in `copy`.

    Rows are matched to their copies by (doc_id, source, size) and a running number among equal ones.
    """
    docs = docs.drop("copy")

    def row_key(source: str, size: Column) -> Column:
        return F.concat_ws("\x1f", size, F.coalesce(F.col("doc_id").cast("string"), F.lit("\x1e")), F.coalesce(F.col(source).cast("string"), F.lit("\x1e")))

    decided = mixed(docs, seed, weights, most).select(row_key("source", F.col("size")).alias("__key"), "copies")
    times = decided.groupBy("__key").agg(F.sum("copies").alias("__all"), F.count("*").alias("__n"))
    keyed = docs.withColumn("__key", row_key("source", word_count(F.col("text"))))
    # rows that are equal in key share their copies as evenly as whole numbers allow; join and window use one shuffle
    number = F.row_number().over(Window.partitionBy("__key").orderBy("text"))
    upto = lambda i: F.floor(i * F.col("__all") / F.col("__n"))
    numbered = keyed.join(times, "__key").withColumn("__i", number)
    chosen = numbered.withColumn("__times", (upto(F.col("__i")) - upto(F.col("__i") - 1)).cast("int")).where("__times > 0")
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns, "copy")
