"""Benchmark decontamination (7): SimHash of item-sized windows, multi-index Hamming lookup, exact weighted verification.

Words are lower-cased and lose punctuation at their edges; features are five-word shingles. For a ladder of window lengths
(a factor of about 1.25 apart), every benchmark item is fingerprinted at all offsets by the lengths between half of it and
the whole, and every document at every fourth part of a length. A stretch that a document shares with an item therefore
contains a window that stands in both, if it is at least half the item and a quarter longer than some length of the ladder.
Edits can leave no such stretch, so the lowest rung are windows of one shingle, at every place: the anchors of an item, its
rarest shingles, whose absence would leave less than the limit. A window at the limit holds at least one of them, wherever
the edits are.

The 64 bits fall into `RADIUS + 1` blocks. Fingerprints within the radius agree in one block at least, so looking up every
block finds all of them. Each find names an item and a place; the item-sized window there (of an anchor, every item-sized
window that holds it) is compared exactly: the sum of the weighted minima of the shingle counts over that of the maxima, the
weight of a shingle being one over the number of items that hold it. At `SIMILARITY` or more, the document is contaminated by
the item. So the result equals the comparison of every item with every window.

One scan of the documents without a shuffle of texts per part of the benchmark (`ITEMS` items, `PART_CHARS` characters); the
items of one scan travel with the tasks, more items take more scans, and one item longer than a part is a part of its own size.
The holders of a shingle are counted over all items first.

Defined cases: NULL and short documents contain nothing; items of fewer than five words or NULL have no shingle and match
nothing; repeated items and rows are judged alike. Extra columns are carried along.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm import common as C

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 3
#: Items and characters of one scan.
ITEMS, PART_CHARS = 20_000, 8_000_000
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¿¡"


def shingles(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every shingle, shingles per row, place of its first word in the text, words that count per row)."""
    ids, counts, distinct = C.words(text)
    bare = pc.utf8_trim(pc.utf8_lower(distinct), characters=EDGE)
    spoken = (pc.binary_length(bare).to_numpy(zero_copy_only=False) > 0)[ids] if len(ids) else np.zeros(0, bool)
    place = (np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts))[spoken]
    h = C.hash_rows(bare.cast(pa.large_string()))[ids[spoken]]
    kept = np.bincount(np.repeat(np.arange(len(counts)), counts)[spoken], minlength=len(counts))
    code = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        code += C.mix64(h[j : j + len(code)]) * np.uint64((0xBF58476D1CE4E5B9 * (2 * j + 1)) & (2**64 - 1))
    n = np.maximum(kept - SHINGLE + 1, 0)
    first = np.repeat(np.cumsum(kept) - kept, n)
    at = first + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return C.mix64(code[at] + np.uint64(3)), n, place[at], kept


def ladder(longest: int) -> list[int]:
    out = [1]
    while out[-1] < longest:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return out


def running_bits(codes: np.ndarray, longest: int) -> np.ndarray:
    """Running sum of each of the 64 bits; differences of up to `longest` positions are exact in the small type."""
    kind = np.uint8 if longest < 256 else np.uint16 if longest < 65536 else np.uint32
    bits = np.unpackbits(codes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    out = np.zeros((len(codes) + 1, 64), kind)
    np.cumsum(bits, axis=0, dtype=kind, out=out[1:])
    return out


def fingerprints(running: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """SimHash of the windows of `length` shingles that start at `at`."""
    ones = running[at + length] - running[at]
    return np.packbits(ones > length // 2, axis=1).view(">u8").astype(np.uint64).ravel()


class Index:
    """Fingerprints of a bounded set of items per window length, with one lookup table per block."""

    def __init__(self, items: list[tuple[int, str]], weights: dict[int, float], least: float = SIMILARITY) -> None:
        codes, n, _, _ = shingles(C.as_array(pa.array([t for _, t in items], pa.large_string())))
        self.ids = [i for i, _ in items]
        self.size = n
        ends = np.cumsum(n)
        self.items = [Counter(codes[e - k : e].tolist()) for e, k in zip(ends, n, strict=True)]
        self.weights = weights
        self.longest = int(n.max(initial=0))
        running = running_bits(codes, self.longest)
        self.lengths: dict[int, tuple] = {}
        block = 64 // (RADIUS + 1)
        for length in ladder(self.longest):
            fit = np.flatnonzero((n >= length) & (2 * length >= n))
            if not len(fit):
                continue
            each = n[fit] - length + 1
            item = np.repeat(fit, each)
            offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            prints = fingerprints(running, (ends - n)[item] + offset, length)
            tables = []
            for b in range(RADIUS + 1):
                key = (prints >> np.uint64(b * block) & np.uint64((1 << block) - 1)).astype(np.int64)
                order = np.argsort(key, kind="stable")
                bounds = np.searchsorted(key[order], np.arange((1 << block) + 1)).astype(np.int32)
                tables.append((order, bounds))
            self.lengths[length] = (prints, item, offset, tables)
        shared = sorted(weights)
        self.shared = np.array(shared, np.uint64), np.array([weights[s] for s in shared], np.float64)
        anchors = [(s, i) for i in range(len(self.items)) for s in self.anchors(i, least)]
        anchors.sort()
        self.anchor_codes, self.anchor_first, self.anchor_many = np.unique(np.array([s for s, _ in anchors], np.uint64), return_index=True, return_counts=True)
        self.anchor_items = np.array([i for _, i in anchors], np.int64)
        self.maybe = np.zeros(1 << 20, bool)  # by the highest bits, a quick first look
        self.maybe[(self.anchor_codes >> np.uint64(44)).astype(np.int64)] = True
        self.parts = []  # distinct shingles of every item, their counts and weights
        for c in self.items:
            keys = np.array(sorted(c), np.uint64)
            self.parts.append((keys, np.array([c[s] for s in keys.tolist()], np.int64), self.weight_of(keys)))

    def anchors(self, item: int, least: float) -> list[int]:
        """The rarest shingles of an item, without which no window can reach `least`."""
        weigh = lambda s: self.weights.get(s, 1.0)
        mine, out = self.items[item], []
        rest = sum(weigh(s) * c for s, c in mine.items())
        enough = least * rest * (1 - 1e-9)
        for s in sorted(mine, key=lambda s: (-weigh(s), s)):
            if rest < enough:
                break
            out.append(s)
            rest -= weigh(s) * mine[s]
        return out

    def weight_of(self, codes: np.ndarray) -> np.ndarray:
        keys, values = self.shared
        out = np.ones(len(codes))
        if len(keys):
            at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
            same = keys[at] == codes
            out[same] = values[at[same]]
        return out

    def anchored(self, codes: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(row, item, places of the item's anchors in the row), once per pair."""
        if not len(codes) or not len(self.anchor_codes):
            return
        hit = np.flatnonzero(self.maybe[(codes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.anchor_codes, codes[hit]), len(self.anchor_codes) - 1)
        same = self.anchor_codes[at] == codes[hit]
        hit, at = hit[same], at[same]
        first, row = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)[hit]
        size, lo = np.cumsum(self.anchor_many[at]), 0
        while lo < len(hit):  # whole rows, about a million finds at a time
            done = size[lo - 1] if lo else 0
            hi = max(int(np.searchsorted(size, done + (1 << 20), side="right")), lo + 1)
            hi = int(np.searchsorted(row, row[hi - 1], side="right"))
            many = self.anchor_many[at[lo:hi]]
            w = np.repeat(np.arange(lo, hi), many)
            item = self.anchor_items[np.repeat(self.anchor_first[at[lo:hi]], many) + np.arange(len(w)) - np.repeat(np.cumsum(many) - many, many)]
            pair = row[w] * np.int64(len(self.items)) + item
            order = np.argsort(pair, kind="stable")
            pair, place = pair[order], (hit[w] - first[row[w]])[order]
            cuts = np.flatnonzero(np.diff(pair)) + 1
            for key, places in zip(pair[np.concatenate([[0], cuts])].tolist(), np.split(place, cuts), strict=True):
                yield key // len(self.items), key % len(self.items), places
            lo = hi

    def best_start(self, item: int, row: np.ndarray, places: np.ndarray, least: float) -> Iterator[int]:
        """Start of the most similar item-sized window in every stretch of windows that hold one of the places, at `least` or more."""
        keys, count, weight = self.parts[item]
        size = min(int(self.size[item]), len(row))
        whole = float((count * weight).sum())
        cuts = np.flatnonzero(np.diff(places) > size) + 1
        for run in np.split(places, cuts):
            begin, last = max(int(run[0]) - size + 1, 0), min(int(run[-1]), len(row) - size)
            part, starts = row[begin : last + size], last - begin + 1
            if starts <= 0:
                continue
            at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
            q = np.flatnonzero(keys[at] == part)
            own = at[q]
            there = np.minimum(np.bincount(own, minlength=len(keys)), count)
            if (there * weight).sum() < least * whole * (1 - 1e-9):
                continue
            # an occurrence counts from the window that starts behind the one `count` places before it
            order = np.argsort(own, kind="stable")
            q, own = q[order], own[order]
            nth = np.arange(len(own)) - np.searchsorted(own, own)
            need = count[own]
            before = np.where(nth >= need, q[np.maximum(np.arange(len(q)) - need, 0)], -1)
            low, high = np.maximum(before + 1, q - size + 1), np.minimum(q, starts - 1)
            low = np.maximum(low, 0)
            fit = low <= high
            gain = np.bincount(low[fit], weights=weight[own[fit]], minlength=starts + 1) - np.bincount(high[fit] + 1, weights=weight[own[fit]], minlength=starts + 1)
            both = np.cumsum(gain)[:starts]
            total = np.concatenate([[0.0], np.cumsum(self.weight_of(part))])
            similar = both / (whole + total[size : size + starts] - total[:starts] - both)
            top = similar.max()
            if top >= least - 1e-9:
                yield begin + int(np.argmax(similar >= top - 1e-9))

    def places(self, codes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Distinct (row, item, start of the item-sized window) that some fingerprint points at."""
        if not len(codes) or not self.lengths:
            return np.zeros((0, 3), np.int64)
        running = running_bits(codes, self.longest)
        first, found, block = np.cumsum(n) - n, [], 64 // (RADIUS + 1)
        for length, (prints, item, offset, tables) in self.lengths.items():
            step = max(1, length // 4)
            each = np.maximum(0, (n - length) // step + 1)
            row = np.repeat(np.arange(len(n)), each)
            start = (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)) * step
            for lo in range(0, len(row), 1 << 17):
                r, s = row[lo : lo + (1 << 17)], start[lo : lo + (1 << 17)]
                own = fingerprints(running, first[r] + s, length)
                for b, (order, bounds) in enumerate(tables):
                    key = (own >> np.uint64(b * block) & np.uint64((1 << block) - 1)).astype(np.int64)
                    low, many = bounds[key], bounds[key + 1] - bounds[key]
                    hit = np.flatnonzero(many)
                    if not len(hit):
                        continue
                    w = np.repeat(hit, many[hit])
                    cand = order[np.repeat(low[hit], many[hit]) + np.arange(len(w)) - np.repeat(np.cumsum(many[hit]) - many[hit], many[hit])]
                    near = np.bitwise_count(own[w] ^ prints[cand]) <= RADIUS
                    w, cand = w[near], cand[near]
                    found.append(np.stack([r[w], item[cand], s[w] - offset[cand]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted sum of minima over maxima of the shingle counts."""
        mine, theirs = self.items[item], Counter(window.tolist())
        weight = lambda s: self.weights.get(s, 1.0)
        low = sum(weight(s) * min(c, theirs[s]) for s, c in mine.items() if s in theirs)
        high = sum(weight(s) * c for s, c in mine.items()) + sum(weight(s) * c for s, c in theirs.items()) - low
        return low / high if high else 0.0

    def matches(self, text: pa.Array, least: float) -> Iterator[tuple[int, int, float, int, int]]:
        """(row, item id, similarity, first word, shingles) of the best window per row and item at `least` or more."""
        codes, n, place, _ = shingles(text)
        first, best = np.cumsum(n) - n, {}
        finds = self.places(codes, n).tolist()
        for row, item, places in self.anchored(codes, n):
            finds += [(row, item, a) for a in self.best_start(item, codes[first[row] : first[row] + n[row]], places, least)]
        for row, item, start in sorted(map(tuple, finds)):
            size, have = int(self.size[item]), int(n[row])
            a = min(max(start, 0), max(have - size, 0))
            window = codes[first[row] + a : first[row] + min(a + size, have)]
            s = self.similarity(item, window)
            key = (row, self.ids[item])
            if s >= least and s > best.get(key, (0.0,))[0]:
                best[key] = (s, int(place[first[row] + a]), len(window))
        for (row, item), (s, at, size) in sorted(best.items()):
            yield row, item, s, at, size


def shingles_of(items: DataFrame) -> DataFrame:
    """(part, code): every distinct shingle of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, n, _, _ = shingles(C.as_array(b.column(1)))
            distinct = [np.unique(own) for own in np.split(codes, np.cumsum(n)[:-1])] if len(n) else []
            flat = np.concatenate(distinct) if distinct else np.zeros(0, np.uint64)
            part = np.repeat(b.column(0).to_numpy(zero_copy_only=False), [len(d) for d in distinct])
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(flat.view(np.int64))], ["part", "code"])

    return items.select("part", "text").mapInArrow(run, "part long, code long")


def indexes(benchmark: DataFrame, least: float = SIMILARITY) -> Iterator[Index]:
    """One index per part of the items: parts hold `ITEMS` items and `PART_CHARS` characters on average, dealt by a hash.

    How many items hold a shingle is counted over all items, in Spark, so the parts never change a similarity.
    """
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    parts = max(1, -(-size["n"] // ITEMS), -(-size["chars"] // PART_CHARS))
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    held = C.staged(shingles_of(items), "benchmark-shingles")
    shared = held.groupBy("code").agg(F.count("*").alias("holders")).where("holders > 1")
    for k in range(parts):
        rows = items.where(F.col("part") == k).orderBy("item_id", "text").collect()
        mine = held.where(F.col("part") == k).select("code").distinct().join(shared, "code").collect()  # shingles of one part
        weights = {r["code"] % (1 << 64): 1.0 / r["holders"] for r in mine}
        yield Index([(r["item_id"], r["text"]) for r in rows], weights, least)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_shingles): the best window of every contaminated document and item."""
    spark, kind, out = docs.sparkSession, docs.schema["doc_id"].dataType, None
    names = ["doc_id", "item_id", "similarity", "first_word", "n_shingles"]
    kinds = [kind, T.LongType(), T.DoubleType(), T.LongType(), T.LongType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    for index in indexes(benchmark, least):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                text = C.as_array(b.column(1))
                for i, j in C.slices(text, 2 << 20):
                    found = list(shared.value.matches(text.slice(i, j - i), least))
                    ids = b.column(0).take(pa.array([i + f[0] for f in found], pa.int64()))
                    rest = [pa.array([f[k] for f in found], t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.int64()), (4, pa.int64()))]
                    yield pa.RecordBatch.from_arrays([ids, *rest], names)

        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    best = F.max_by(F.struct("first_word", "n_shingles"), F.struct("similarity", -F.col("first_word")))
    grouped = out.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), best.alias("at"))
    return grouped.select("doc_id", "item_id", "similarity", "at.first_word", "at.n_shingles")


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` without a benchmark item in their text; no shuffle."""
    spark, out = docs.sparkSession, docs
    place = docs.columns.index("text")
    for index in indexes(benchmark, least):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                text, clean = C.as_array(b.column(place)), np.ones(b.num_rows, bool)
                for i, j in C.slices(text, 2 << 20):
                    for found in shared.value.matches(text.slice(i, j - i), least):
                        clean[i + found[0]] = False
                yield b.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out
