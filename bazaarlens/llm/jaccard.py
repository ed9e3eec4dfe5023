"""N-gram Jaccard join (8): a parity-sketch join over sets of distinct three-word shingles, exact at the given share.

A set's parity sketch is the XOR of its shingles' 64-bit codes in each of B blocks (a shingle's block follows from its
code). Two sets differ in at most as many blocks as their symmetric difference has members. In a band of sizes whose
linked pairs differ by at most d members, any d + 1 blocks contain one in which linked sets agree: the sets are joined on
(band, block, XOR). B is so far above d + 1 that a set has more than d blocks with members but for one in a milliard; then one
of those agrees, and its empty blocks, which all sets would share, need not be entered. A set is also entered in the band
below when it may link with sets there. Keys are made from the texts, a class once per task, and shuffled once: within the
partition of a key, keys of one class only are left out, and keys of the same classes become one.

Equal sets are one class, so copies cost one row each. Among the classes that share a block, every class is paired with one
central class. A narrow parity sketch, whose Hamming distance is also a lower bound of the symmetric difference, screens the
pairs. Classes that share a block but are not yet connected are paired and screened as well; all pairs left are verified on
their shingle codes. That is repeated once from the verified links, for the pairs that only screened pairs had connected: then
every two classes that share a block are connected, or were screened out, or were verified and do not link, since links only grow. So no link is lost, and a group of near copies costs
about one pair a member. Between steps a class goes by the number of its first row.

Shingles are compared by 64-bit hashes and classes by 128-bit hashes of the whole set (their first half while keys are met).

Defined cases: NULL and wordless texts have no shingles and link with nothing; fewer than three words make one shingle of
the whole sequence. Repeated rows fall into one class; rows without an id take part, and a component of such rows only has
a NULL id. An empty table gives an empty result; texts of any length are read whole, and memory follows the longest one. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm import common as C
from bazaarlens.llm.components import components

WORDS = 3
#: Chance that a set has so few blocks with members that its empty ones are entered.
RARE = 1e-9
#: Up to so many ids are sent to the tasks to pick out their texts; more are joined.
FEW = 300_000
#: Shingles whose keys one task sorts.
TASK_KEYS = 1_000_000
#: Longs of the narrow sketch that screens pairs before they are verified.
NARROW = 32


def size_bands() -> np.ndarray:
    """Lower ends of the size bands, each about 1.5 times the one before."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return np.array(bounds)


def shingle_codes(text: pa.Array, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit code of every shingle position, positions per row), of a lower-cased text array."""
    ids, counts, distinct = C.words(pc.ascii_lower(text))
    h = C.hash_rows(distinct.cast(pa.large_string()))[ids]
    first = np.cumsum(counts) - counts
    code = np.zeros(len(h), np.uint64)
    short = counts < n_words
    width = np.repeat(np.where(short, counts, n_words), counts)
    for j in range(n_words):
        reach = width > j  # a short text is one shingle of all its words
        step = np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) & (2**64 - 1))
        moved = np.zeros(len(h), np.uint64)
        moved[: len(h) - j] = C.mix64(h[j:] + step)
        code[reach] += moved[reach] * step
    place = np.arange(len(h)) - np.repeat(first, counts)
    starts = place <= np.repeat(np.where(short, 0, counts - n_words), counts)
    return C.mix64(code[starts] + np.uint64(1)), np.where(short, np.minimum(counts, 1), counts - n_words + 1)


def identity(codes: np.ndarray) -> tuple[int, int]:
    """128-bit hash of a sorted set of codes."""
    with np.errstate(over="ignore"):
        a = C.mix64(codes).sum(dtype=np.uint64) + np.uint64(len(codes))
        b = C.mix64(codes ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


@lru_cache(maxsize=None)
def block_number(least: int, most: int) -> int:
    """Blocks of a band: so many above most + 1 that a set of `least` members fills more than `most` of them, but for a
    chance of `RARE`: either all members can fall into some `most` blocks with chance C(blocks, most) * (most / blocks) **
    least at most, or, among many blocks, the number of filled ones lies six deviations above `most`.

    Linked sets n <= m, 100 * both >= share * all, differ by at most (n + m) * (100 - share) / (100 + share) members, which is
    `most` for the largest n of the band.
    """
    chance = lambda b: math.lgamma(b + 1) - math.lgamma(most + 1) - math.lgamma(b - most + 1) + least * math.log(most / b)

    def enough(b: int) -> bool:
        bare = math.exp(-least / b)
        spread = math.sqrt(b * (bare - (1 + least / b) * bare * bare))
        return chance(b) <= math.log(RARE) or (most >= 30 and b * (1 - bare) - 6 * spread >= most + 1)

    blocks = most + 1
    while not enough(blocks):
        blocks += max(1, blocks // 64)
    return blocks


def block_keys(codes: np.ndarray, share: int, bounds: np.ndarray) -> np.ndarray:
    """Join keys of a sorted set: one per block in its band, and in the band below if it can link into that."""
    n, out = len(codes), []
    own = int(np.searchsorted(bounds, n, side="right")) - 1
    for band in (own, own - 1):
        if band < 0:
            break
        top = int(bounds[band + 1]) - 1
        if band < own and share * n > 100 * top:
            break
        most = top * (100 - share) // share
        if most == 0:
            continue  # only equal sets can link there, and those are one class
        blocks = block_number(int(bounds[band]), most)
        at = np.searchsorted(codes, (np.arange(blocks, dtype=np.uint64) * np.uint64(2**64 // blocks)))
        end = np.append(at[1:], n)
        xor = np.zeros(blocks, np.uint64)
        full = at < end
        xor[full] = np.bitwise_xor.reduceat(codes, at[full])
        tag = np.uint64(band << 32) + np.arange(blocks, dtype=np.uint64)
        keys = C.mix64(C.mix64(tag + np.uint64(0x1234567)) ^ xor)
        out.append(keys[full] if full.sum() > most else keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def narrow_sketch(codes: np.ndarray) -> np.ndarray:
    """Parity of the codes in NARROW * 64 bits."""
    bit = (C.mix64(codes) >> np.uint64(20)) % np.uint64(NARROW * 64)
    odd = (np.bincount(bit.astype(np.int64), minlength=NARROW * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def sets_of(text: pa.Array, n_words: int) -> Iterator[np.ndarray]:
    """Sorted distinct codes of every row."""
    for i, j in C.slices(text, 4 << 20):
        codes, counts = shingle_codes(text.slice(i, j - i), n_words)
        for part in np.split(codes, np.cumsum(counts)[:-1]):
            yield np.unique(part)


def sketched(docs: DataFrame, n_words: int) -> DataFrame:
    """row number, doc_id, n_shingles, class (h1, h2) and narrow sketch of every row; one scan, no shuffle."""
    kind = docs.schema["doc_id"].dataType
    long = T.LongType()
    narrow = T.StructField("narrow", T.ArrayType(long, False))
    schema = T.StructType([T.StructField("row", long), T.StructField("doc_id", kind), *(T.StructField(c, long) for c in ("n_shingles", "h1", "h2")), narrow])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            text = C.as_array(b.column(1))
            for i, j in C.slices(text, 2 << 20):
                found = list(sets_of(text.slice(i, j - i), n_words))
                marks = np.array([identity(s) for s in found], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(found))), b.column(0).slice(i, j - i), pa.array([len(s) for s in found], pa.int64()),
                        pa.array(marks[:, 0]), pa.array(marks[:, 1]), lists([narrow_sketch(s) for s in found]),
                    ],
                    schema.names,
                )
                row += len(found)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keyed(docs: DataFrame, share: int, n_words: int) -> DataFrame:
    """(key, h1): the join keys of every class, entered once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = size_bands()
        entered: set[int] = set()
        for b in batches:
            text = C.as_array(b.column(0))
            for i, j in C.slices(text, 2 << 20):
                marks, keys = [], []
                for codes in sets_of(text.slice(i, j - i), n_words):
                    mark = identity(codes)[0]
                    if mark not in entered:
                        entered.add(mark)
                        marks.append(mark)
                        keys.append(block_keys(codes, share, bounds))
                flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
                owner = np.repeat(np.array(marks, np.int64), [len(k) for k in keys])
                for at in range(0, len(flat), 1 << 17):
                    yield pa.RecordBatch.from_arrays([pa.array(flat[at : at + (1 << 17)].view(np.int64)), pa.array(owner[at : at + (1 << 17)])], ["key", "h1"])

    return docs.select("text").mapInArrow(run, "key long, h1 long")


def full_sets(docs: DataFrame, n_words: int) -> DataFrame:
    """Class, size and shingle codes of every row."""
    schema = "h1 bigint, h2 bigint, n bigint, codes array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = C.as_array(b.column(0))
            for i, j in C.slices(text, 4 << 20):  # codes take more room than the text: pass them on in slices
                found = list(sets_of(text.slice(i, j - i), n_words))
                marks = [identity(s) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([m[0] for m in marks], pa.int64()),
                        pa.array([m[1] for m in marks], pa.int64()),
                        pa.array([len(s) for s in found], pa.int64()),
                        lists(found),
                    ],
                    ["h1", "h2", "n", "codes"],
                )

    return docs.select("text").mapInArrow(run, schema)


def linked_pairs(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The (u, v) class pairs whose sets share at least share/100 of their union."""
    side = lambda name: sets.select(F.col("c").alias(name), F.col("n").alias(f"n_{name}"), F.col("codes").alias(f"codes_{name}"))
    both = F.size(F.array_intersect("codes_u", "codes_v"))
    joined = pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v")
    return joined.where(100 * both >= share * (F.col("n_u") + F.col("n_v") - both)).select("u", "v")


def may_link(share: int) -> Column:
    """Whether sizes and narrow sketches of the sides u and v leave room for a link."""
    apart = F.aggregate(F.zip_with("narrow_u", "narrow_v", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    sizes = 100 * F.least("n_u", "n_v") >= share * F.greatest("n_u", "n_v")
    return sizes & ((100 + share) * apart <= (100 - share) * (F.col("n_u") + F.col("n_v")))


class Search:
    """Tables of one run: rows, the classes that share a block with another, and the keys they share."""

    def __init__(self, docs: DataFrame, share: int, n_words: int) -> None:
        self.docs, self.share, self.n_words = docs, share, n_words
        self.rows = C.staged(sketched(docs, n_words), "sketches")
        # one shuffle by key serves the filter, the distinct and the crowd; a set has fewer keys than shingles
        same = Window.partitionBy("key")
        parts = max(1, (self.rows.agg(F.sum("n_shingles")).first()[0] or 0) // TASK_KEYS)
        entered = keyed(docs, share, n_words).repartition(parts, "key").withColumns({"low": F.min("h1").over(same), "high": F.max("h1").over(same)})
        met = entered.where("low <> high").select("key", "h1").distinct().withColumn("crowd", F.count("*").over(same))
        # keys met by the same classes are one: pairs of near copies share most of theirs
        met = met.select(F.xxhash64("crowd", F.bit_xor(F.xxhash64("h1")).over(same)).alias("key"), "h1", "crowd").distinct()
        met = C.staged(met, "met-keys")
        classes = self.rows.groupBy("h1", "h2").agg(F.min("row").alias("c")).select("h1", "c")
        self.live = C.staged(met.join(classes, "h1").select("key", "c", "crowd"), "live-keys")
        alive = self.live.select(F.col("c").alias("row")).distinct()
        about = self.rows.join(alive, "row").select(F.col("row").alias("c"), F.col("n_shingles").alias("n"), "narrow", "doc_id", "h1", "h2")
        self.classes = C.staged(about, "classes")
        self.sets: DataFrame | None = None
        self.placed: DataFrame | None = None

    def side(self, name: str) -> DataFrame:
        return self.classes.select(F.col("c").alias(name), F.col("n").alias(f"n_{name}"), F.col("narrow").alias(f"narrow_{name}"))

    def stars(self) -> DataFrame:
        """Every class with the class whose blocks are shared most, of each of its blocks; screened."""
        central = self.live.groupBy("c").agg(F.sum("crowd").alias("weight"))
        ranked = self.live.join(central, "c").select("key", "c", F.struct("weight", "c").alias("rank"))
        middle = ranked.groupBy("key").agg(F.max("rank").alias("top")).select("key", F.col("top.c").alias("mid"))
        pairs = ranked.join(middle, "key").where("c <> mid").select(F.least("c", "mid").alias("u"), F.greatest("c", "mid").alias("v")).distinct()
        return pairs.join(self.side("u"), "u").join(self.side("v"), "v").where(may_link(self.share)).select("u", "v")

    def across(self, links: DataFrame) -> DataFrame:
        """All pairs of classes that share a block but are not connected by `links`; screened. The only pair of a block with two
        classes is a star and left out. A second call lists only pairs that the first call's links connected: all others that
        pass the screen were listed by it."""
        roots = components(links).withColumnRenamed("node", "c")
        first = self.placed is None
        keys = self.live.where("crowd > 2").withColumn("base", F.lit(0)) if first else self.placed.withColumn("base", F.col("root"))
        placed = C.staged(keys.select("key", "base", "c").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c")), "placed")
        if first:
            self.placed = placed
        same = ["key", "base"]
        split = placed.groupBy(*same).agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select(*same)
        open_ = placed.join(split, same).join(self.classes.select("c", "n", "narrow"), "c")
        u, v = (open_.select(*(F.col(x).alias(f"{x}_{side}") for x in [*same, "c", "root", "n", "narrow"])) for side in "uv")
        meet = (F.col("key_u") == F.col("key_v")) & (F.col("base_u") == F.col("base_v"))
        apart = meet & (F.col("root_u") != F.col("root_v")) & (F.col("c_u") < F.col("c_v"))
        return u.join(v, apart & may_link(self.share)).select(F.col("c_u").alias("u"), F.col("c_v").alias("v")).distinct()

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link. The sets of their classes are made from the texts once, class by class."""
        asked = sides = pairs.select(F.col("u").alias("c")).unionAll(pairs.select(F.col("v").alias("c"))).distinct()
        if self.sets is not None:
            asked = asked.join(self.sets.select("c"), "c", "left_anti")
        wanted = C.staged(asked.join(self.classes, "c").select("c", "h1", "h2", "doc_id"), "wanted")
        asked_for = wanted.count()
        if asked_for:
            ids = wanted.select(F.col("doc_id").alias("__id")).distinct()
            marks = wanted.select("c", "h1", "h2")
            if asked_for <= FEW:  # then neither texts nor sets need a shuffle to be picked out
                ids, marks = F.broadcast(ids), F.broadcast(marks)
            texts = self.docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
            found = full_sets(texts, self.n_words).join(marks, ["h1", "h2"]).select("c", "n", "codes").dropDuplicates(["c"])
            made = C.staged(found, "sets")
            self.sets = made if self.sets is None else self.sets.unionAll(made)
        if self.sets is None:
            return pairs
        # only the sets of these pairs are shuffled
        sides = F.broadcast(sides) if sides.count() <= FEW else sides
        return linked_pairs(pairs, self.sets.join(sides, "c", "left_semi"), self.share)


def links_of(search: Search) -> DataFrame:
    """All links that matter: classes are connected over them exactly if they are over all links."""
    stars = C.staged(search.stars(), "stars")
    # the pairs that the screened stars leave unconnected are verified in the same pass
    tested = C.staged(stars.unionAll(search.across(stars)), "pairs")
    links = C.staged(search.verified(tested), "links")
    # all pairs that the links leave apart: more links can only leave fewer, so these are the last
    rest = C.staged(search.across(links).join(tested, ["u", "v"], "left_anti"), "pairs")
    return links if rest.isEmpty() else C.staged(links.unionAll(search.verified(rest)), "links")


def near_components(docs: DataFrame, share: int = 90, n_words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable over links) of every row of `docs`."""
    search = Search(docs, share, n_words)
    joined = components(links_of(search))
    slim = search.rows.select("row", "doc_id", "n_shingles", "h1", "h2")
    # class -> root -> smallest id
    least = slim.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("least_id"), F.min("row").alias("node"))
    rooted = least.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = rooted.join(low, "root").select("h1", "h2", "component_id")
    filled = slim.where("n_shingles > 0").join(of_class, ["h1", "h2"])
    empty = slim.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return filled.select("doc_id", "n_shingles", "component_id").unionByName(empty.select("doc_id", "n_shingles", "component_id"))
