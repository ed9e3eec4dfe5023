"""LM scoring (5): online logistic mixing of hashed-context bit predictors, giving total bits per byte.

A text is its UTF-8 bytes in lower case plus an end mark. Every symbol is spelled in a prefix code built from the corpus
(frequent symbols take few bits), and each code bit is predicted: hashed contexts (the last bytes, and the word so far)
give log-odds from counts over the whole training part; a mixer adds them with weights that a gate chooses by
how much evidence the predictors have and that are corrected after every bit; a scale and an offset on the mixed log-odds,
adapting as well, refine the result. The code is complete and every prediction uses earlier bytes only, so probabilities
over all texts sum to one.

Mixer and refinement start afresh every `SEGMENT` code bits of a document, contexts do not. So a text of any length is a row of
equal segments that numpy advances side by side, bit by bit, in bounded memory.

What is gathered from the corpus: symbol counts, word counts (a table as large as the vocabulary, never on the driver) and
context counts, pre-summed by every task into slots, whose blocks are then added up, packed. The context tables have a fixed number of slots (`TABLES`), so the
model that travels to the tasks is bounded while its counts cover every training row. The mixer's starting weights are fitted on
every bit of every training row, each without itself in the counts: a second pass counts how often each combination of gate,
rounded log-odds (`LEVELS`) and bit occurs, a table of fixed size, and logistic regression runs on that table.

The base score needs the count of every token. The most frequent words (`COMMON`, a documented bound) travel with the tasks;
all others meet the word counts in a join, whose largest key is no more frequent than the last common word.

Defined cases: NULL counts as empty text, whose only token is its end; rows without an id are scored and learned from;
repeated rows count as often as they occur. If nothing can be learned from, all counts are 0: every word is unknown and all
bits are equally likely.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm import common as C

#: Predictors: context length in bytes (0: the word so far), and logarithm of the number of slots.
TABLES = ((3, 18), (4, 20), (0, 21))
#: Predictors whose evidence (bits seen in the slot, in these classes) chooses the mixing weights.
GATED, EVIDENCE = (1, 2), (1, 3, 10, 30, 200)
GATES = (len(EVIDENCE) + 1) ** len(GATED)
#: Slots of all predictors, and how many of them travel as one packed row.
SLOTS, BLOCK = sum(1 << log for _, log in TABLES), 1 << 12
COMMON = 200_000
#: Bits of a segment, bytes of a slice.
SEGMENT, SLICE = 1024, 1 << 19
#: Log-odds are rounded to this many whole numbers around 0 where starting weights are fitted.
LEVELS = 19
END = 256
PRIOR, RATE, REFINE_RATE = 0.4, 0.01, 0.002


def prefix_code(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per symbol the (inner node, bit) steps of a code whose frequent symbols are short; unseen symbols count as one."""
    heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    children, n = {}, len(counts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children[n] = (a[2], b[2])
        heapq.heappush(heap, (a[0] + b[0], n, n))
        n += 1
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    todo = [(heap[0][2], [])]
    while todo:
        node, path = todo.pop()
        if node < len(counts):
            paths[node] = path
        else:
            todo += [(child, [*path, (node - len(counts), bit)]) for bit, child in enumerate(children[node])]
    return paths


class Code:
    """The prefix code as arrays."""

    def __init__(self, counts: np.ndarray) -> None:
        paths = prefix_code(counts)
        self.length = np.array([len(p) for p in paths])
        self.first = np.cumsum(self.length) - self.length
        self.node = np.array([n for p in paths for n, _ in p], np.uint32)
        self.bit = np.array([b for p in paths for _, b in p], np.uint8)


@dataclass
class Bits:
    """All code bits of a slice of texts, in order."""

    bit: np.ndarray
    slots: list[np.ndarray]  # per predictor
    each: np.ndarray  # bits of every row


def word_so_far(sym: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the bytes since the last blank or the start of the text, at every symbol."""
    blank = np.zeros(END + 1, bool)
    blank[[9, 10, 11, 12, 13, 32, END]] = True
    after = np.concatenate([[True], blank[sym[:-1]]])
    begin = np.maximum(np.maximum.accumulate(np.where(after, np.arange(len(sym)), 0)), first)
    place = np.arange(len(sym)) - begin
    powers = np.full(int(place.max(initial=0)) + 1, 0x100000001B3, np.uint64).cumprod()
    total = np.concatenate([[np.uint64(0)], np.cumsum((sym.astype(np.uint64) + np.uint64(1)) * powers[place])])
    return (C.mix64(total[:-1] - total[begin]) >> np.uint64(32)).astype(np.uint32)


def spelled(code: Code, text: pa.Array) -> Bits:
    """Bits and context slots of every row of a lower-cased text array."""
    data, offsets = C.raw_bytes(text)
    rows = np.diff(offsets)
    ends = offsets[1:] + np.arange(len(rows))
    sym = np.full(len(data) + len(rows), END, np.int64)
    inside = np.ones(len(sym), bool)
    inside[ends] = False
    sym[inside] = data
    first = np.repeat(ends - rows, rows + 1)
    place = np.arange(len(sym)) - first
    per = code.length[sym]
    starts = np.cumsum(per) - per
    of = np.repeat(np.arange(len(sym), dtype=np.int32), per)
    at = np.arange(len(of), dtype=np.int32)
    at += (code.first[sym] - starts).astype(np.int32)[of]
    mixed = code.node.take(at) * np.uint32(0x85EBCA6B)
    slots = []
    for order, log in TABLES:
        h = np.zeros(len(sym), np.uint32) if order else word_so_far(sym, first)
        for k in range(1, order + 1):  # contexts never reach over the start of their text
            before = np.zeros(len(sym), np.uint32)
            before[k:] = sym[:-k]
            before[place < k] = END
            h = (h + before + np.uint32(1)) * np.uint32(0x9E3779B1) ^ (h >> np.uint32(15))
        slots.append(((h.take(of) ^ mixed) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - log))
    each = np.add.reduceat(per, ends - rows) if len(rows) else np.zeros(0, np.int64)
    return Bits(code.bit.take(at), slots, each)


@dataclass
class Model:
    """Log-odds and evidence class of every slot, per predictor, and the starting weights of every gate."""

    code: Code
    odds: list[np.ndarray]
    evidence: list[np.ndarray]
    weights: np.ndarray


def evidence_of(seen: np.ndarray) -> np.ndarray:
    return np.searchsorted(EVIDENCE, seen, side="right").astype(np.uint8)


def log_odds(seen: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + PRIOR) / (seen - ones + PRIOR)).astype(np.float32)


def gate_of(classes: list[np.ndarray]) -> np.ndarray:
    gate = np.zeros(classes[0].shape, np.int32)
    for c in classes:
        gate = gate * (len(EVIDENCE) + 1) + c
    return gate


def combination_codes(seen: list[np.ndarray], ones: list[np.ndarray]) -> list[np.ndarray]:
    """Per predictor, at 2 * slot + bit: its share of the number of a combination (gate, rounded log-odds, bit), where the bit
    itself is taken out of the slot's counts. The shares of all predictors add up to the number."""
    codes, gate_step = [], GATES
    for k, (n, o) in enumerate(zip(seen, ones, strict=True)):
        less = np.maximum(n - 1, 0)
        code = np.empty(2 * len(n), np.int32)
        if k in GATED:
            gate_step //= len(EVIDENCE) + 1
        for bit in (0, 1):
            odds = log_odds(less, np.clip(o - bit, 0, less))
            level = np.rint(np.clip(odds, -(LEVELS // 2), LEVELS // 2)).astype(np.int32) + LEVELS // 2
            code[bit::2] = level * (2 * LEVELS**k) + (bit if k == 0 else 0)
            if k in GATED:
                code[bit::2] += evidence_of(less).astype(np.int32) * (gate_step * 2 * LEVELS ** len(TABLES))
        codes.append(code)
    return codes


def combination_counts(code: Code, codes: list[np.ndarray], text: pa.Array) -> np.ndarray:
    """How often every combination occurs in a lower-cased text array."""
    b = spelled(code, text)
    number = np.zeros(len(b.bit), np.int32)
    for own, slots in zip(codes, b.slots, strict=True):
        number += own.take(slots * np.uint32(2) + b.bit)
    return np.bincount(number, minlength=GATES * 2 * LEVELS ** len(TABLES))


def fitted_weights(counts: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weights of every gate by Newton steps on the logistic loss over counted combinations. Each gate is drawn to equal
    weights as by 50 bits, so that one without evidence keeps them."""
    weights = prior = np.full((GATES, len(TABLES)), 1 / len(TABLES))
    number = np.flatnonzero(counts)
    n, rest = counts[number].astype(float), number // 2
    x = np.empty((len(number), len(TABLES)))
    for k in range(len(TABLES)):
        x[:, k] = rest % LEVELS - LEVELS // 2
        rest = rest // LEVELS
    by_gate = lambda v: np.bincount(rest, weights=v, minlength=GATES)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip((weights[rest] * x).sum(axis=1), -30, 30)))
        miss, spread = n * (number % 2 - p), n * np.maximum(p * (1 - p), 1e-6)
        slope = np.stack([by_gate(miss * x[:, k]) for k in range(len(TABLES))], axis=1) - 50 * (weights - prior)
        bend = np.stack([by_gate(spread * x[:, i] * x[:, j]) for i in range(len(TABLES)) for j in range(len(TABLES))], axis=1)
        step = np.linalg.solve(bend.reshape(GATES, len(TABLES), len(TABLES)) + 50 * np.eye(len(TABLES)), slope[:, :, None])[:, :, 0]
        weights = weights + np.clip(step, -0.3, 0.3)
    return weights


def starting_weights(code: Code, seen: list[np.ndarray], ones: list[np.ndarray], texts: list[str]) -> np.ndarray:
    """The weights fitted on texts at hand."""
    text = pc.ascii_lower(C.as_array(pa.array(texts, pa.large_string())))
    return fitted_weights(combination_counts(code, combination_codes(seen, ones), text))


def mixed_bits(model: Model, text: pa.Array) -> np.ndarray:
    """Total bits of every row of a lower-cased text array, under the online mixer."""
    b = spelled(model.code, text)
    # every text is filled up to whole segments, which are advanced side by side; what they need is looked up 64 bits at a time
    lanes = -(-b.each // SEGMENT)
    ends, starts = np.cumsum(b.each), (np.cumsum(lanes) - lanes) * SEGMENT
    row = np.repeat(np.arange(len(lanes)), lanes)
    begins = (ends - b.each)[row] + np.arange(len(row)) * SEGMENT - starts[row]
    weights = model.weights.T.astype(np.float32)
    cost = np.empty((len(row), SEGMENT), np.float32)
    shift = np.zeros((len(TABLES), len(row)), np.float32)  # what every segment has added to the gates' weights
    scale, bias = np.ones(len(row), np.float32), np.zeros(len(row), np.float32)  # refinement of the mixed log-odds
    one, rate, slow, most = np.float32(1), np.float32(RATE), np.float32(REFINE_RATE), np.float32(11)
    step, p = np.empty_like(shift), np.empty(len(row), np.float32)
    for begin in range(0, SEGMENT, 64):
        at = begins[:, None] + np.arange(begin, begin + 64)
        filler = at >= ends[row][:, None]
        np.minimum(at, len(b.bit) - 1, out=at)
        slots = [s.take(at) for s in b.slots]
        odds = [t.take(s) for t, s in zip(model.odds, slots, strict=True)]
        for v in odds:
            v[filler] = 0
        bits = b.bit.take(at).astype(np.float32)
        bits[filler] = 0.5  # a filler, sure of neither, teaches nothing
        gate = gate_of([model.evidence[k].take(slots[k]) for k in GATED])
        dots = np.ascontiguousarray(sum(w.take(gate) * v for w, v in zip(weights, odds, strict=True)).T)
        xs, ys = np.stack(odds).transpose(2, 0, 1).copy(), np.ascontiguousarray(bits.T)
        del at, filler, slots, odds, bits, gate
        for x, dot, bit in zip(xs, dots, ys, strict=True):
            np.multiply(shift, x, out=step)
            for d in step:
                dot += d
            np.multiply(scale, dot, out=p)
            p += bias
            np.minimum(p, most, out=p)
            np.maximum(p, -most, out=p)
            np.negative(p, out=p)
            np.exp(p, out=p)
            p += one
            np.divide(one, p, out=p)
            miss = bit - p
            np.abs(miss, out=bit)  # one less the chance of the bit
            miss *= slow
            bias += miss
            scale += miss * dot
            miss *= rate / slow
            np.multiply(x, miss, out=step)
            shift += step
        cost[:, begin : begin + 64] = ys.T
    np.subtract(one, cost, out=cost)
    cost = np.log2(cost, out=cost).ravel()
    return np.array([-cost[at : at + n].sum(dtype=np.float64) for at, n in zip(starts.tolist(), b.each.tolist(), strict=True)])


# --- what is gathered from the corpus ------------------------------------------
def token_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all lower-cased words and, under a NULL word, (symbol, n) of all bytes; symbol 256 counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = np.zeros(END + 1, np.int64)
        for b in batches:
            text = pc.ascii_lower(C.as_array(b.column(0)))
            symbols[END] += len(text)
            for i, j in C.slices(text, 8 << 20):
                part = text.slice(i, j - i)
                symbols[:END] += np.bincount(C.raw_bytes(part)[0], minlength=END)
                ids, _, distinct = C.words(part)
                n = np.bincount(ids, minlength=len(distinct)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([distinct.cast(pa.string()), pa.nulls(len(n), pa.int32()), pa.array(n)], ["word", "symbol", "n"])
        yield pa.RecordBatch.from_arrays([pa.nulls(END + 1, pa.string()), pa.array(np.arange(END + 1, dtype=np.int32)), pa.array(symbols)], ["word", "symbol", "n"])

    parts = docs.select("text").mapInArrow(run, "word string, symbol int, n bigint")
    return parts.groupBy("word", "symbol").agg(F.sum("n").alias("n")).where("n > 0")


def packed(counts: np.ndarray) -> bytes:
    """Counts as their bytes by significance, compressed: mostly small numbers take about a byte each."""
    return pa.compress(np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 8).T), codec="lz4_raw", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="lz4_raw"), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.int64).ravel()


def context_counts(docs: DataFrame, code: Code) -> DataFrame:
    """(block, counts): per `BLOCK` neighbouring slots of all predictors in turn, how often each was met with bit 0 and bit 1, summed
    over all texts. Each task sends a block once, packed, and a block is summed as it streams in, so that neither side holds
    the slots as rows."""
    cells, kind = 2 * BLOCK, "block int, counts binary"

    def batch(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([packed(c) for _, c in found], pa.binary())], ["block", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * SLOTS, np.int64)
        own = np.split(counts, np.cumsum([2 << log for _, log in TABLES])[:-1])
        for b in batches:
            text = pc.ascii_lower(C.as_array(b.column(0)))
            for i, j in C.slices(text, SLICE):
                bits = spelled(code, text.slice(i, j - i))
                for c, slots, (_, log) in zip(own, bits.slots, TABLES, strict=True):
                    c += np.bincount(slots * np.uint32(2) + bits.bit, minlength=2 << log)
        for k in range(0, len(counts) // cells, 64):
            found = [(i, c) for i, c in enumerate(counts[k * cells : (k + 64) * cells].reshape(-1, cells), k) if c.any()]
            if found:
                yield batch(found)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                one = unpacked(data.as_py(), cells)
                sums[k] = sums[k] + one if k in sums else one
        if sums:
            yield batch(sorted(sums.items()))

    return docs.select("text").mapInArrow(run, kind).repartition("block").mapInArrow(total, kind)


def combinations(docs: DataFrame, code: Code, codes: list[np.ndarray]) -> np.ndarray:
    """Counts of every combination over all texts; each task sends a combination once."""
    shared = docs.sparkSession.sparkContext.broadcast((code, codes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, codes = shared.value
        counts = np.zeros(GATES * 2 * LEVELS ** len(TABLES), np.int64)
        for b in batches:
            text = pc.ascii_lower(C.as_array(b.column(0)))
            for i, j in C.slices(text, SLICE):
                counts += combination_counts(code, codes, text.slice(i, j - i))
        number = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(counts[number])], ["number", "n"])

    got = docs.select("text").mapInArrow(run, "number bigint, n bigint").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(GATES * 2 * LEVELS ** len(TABLES), np.int64)
    counts[got["number"].to_numpy()] = got["n"].to_numpy()
    shared.destroy()
    return counts


@dataclass
class Corpus:
    """Counts of the training rows: the vocabulary stays a table."""

    words: DataFrame
    texts: int
    tokens: int
    distinct: int
    common: pa.Table
    model: Model


def learned(docs: DataFrame) -> Corpus:
    tokens = C.staged(token_counts(docs), "token-counts")
    symbols = np.zeros(END + 1, np.int64)
    for r in tokens.where("word IS NULL").select("symbol", "n").collect():
        symbols[r["symbol"]] = r["n"]
    words = tokens.where("word IS NOT NULL").select("word", "n")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = words.orderBy(F.col("n").desc(), "word").limit(COMMON).toArrow()
    code = Code(symbols)
    counts = np.zeros(2 * SLOTS, np.int64)
    for block, data in context_counts(docs, code).collect():
        counts[2 * BLOCK * block : 2 * BLOCK * (block + 1)] = unpacked(data, 2 * BLOCK)
    own = np.split(counts, np.cumsum([2 << log for _, log in TABLES])[:-1])
    seen, ones = [c[::2] + c[1::2] for c in own], [c[1::2].copy() for c in own]
    del counts, own
    weights = fitted_weights(combinations(docs, code, combination_codes(seen, ones)))
    model = Model(code, [log_odds(n, o) for n, o in zip(seen, ones, strict=True)], [evidence_of(n) for n in seen], weights)
    ends = int(symbols[END])
    return Corpus(words, ends, int(total[0]) + ends, int(total[1]) + (ends > 0), common, model)


def scored(docs: DataFrame, corpus: Corpus, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte of every row."""
    spark = docs.sparkSession
    floor = float(np.log10(corpus.tokens + 0.1 * (corpus.distinct + 1)))
    shared = spark.sparkContext.broadcast((corpus.common["word"].combine_chunks(), corpus.common["n"].to_numpy(), corpus.model))
    n_ends = corpus.texts
    long, real = T.LongType(), T.DoubleType()
    rare_type = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", long)]))
    names = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "n_bytes", "rare"]
    kinds = [long, docs.schema["doc_id"].dataType, T.BooleanType(), long, long, real, real, long, rare_type]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, counts, model = shared.value
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            whole = pc.ascii_lower(C.as_array(b.column(2)))
            for i, j in C.slices(whole, SLICE):
                text = whole.slice(i, j - i)
                ids, each, distinct = C.words(text)
                where = pc.index_in(distinct.cast(vocabulary.type), value_set=vocabulary)
                found = pc.fill_null(where, -1).to_numpy(zero_copy_only=False)
                value = np.where(found >= 0, np.log10(counts[found] + 0.1) if len(counts) else 0.0, 0.0)
                owner = np.repeat(np.arange(len(each)), each)
                known = np.bincount(owner, weights=found[ids] >= 0, minlength=len(each)).astype(np.int64) + (n_ends > 0)
                base = np.bincount(owner, weights=value[ids], minlength=len(each)) + np.log10(n_ends + 0.1)
                # the other words of every row, with their counts
                other = found[ids] < 0
                pairs, times = np.unique(owner[other] * np.int64(max(1, len(distinct))) + ids[other], return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(len(each) + 1) * np.int64(max(1, len(distinct))))
                listed = pa.StructArray.from_arrays(
                    [distinct.take(pa.array(pairs % max(1, len(distinct)))).cast(pa.string()), pa.array(times.astype(np.int64))], ["word", "n"]
                )
                bits = mixed_bits(model, text)
                size = pc.binary_length(text).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(text))), b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                        pa.array(each + 1), pa.array(known), pa.array(base), pa.array(-bits * np.log10(2)), size,
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), listed),
                    ],
                    names,
                )
                row += len(text)

    rows = C.staged(docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, schema), "lm-rows")
    rare = rows.select("row", F.inline("rare")).withColumnRenamed("n", "times")
    met = rare.join(corpus.words, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 0.1)).alias("rare_base"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    return rows.drop("rare").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") / F.lit(float(np.log10(2))) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
