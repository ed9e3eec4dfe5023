"""Trained operators: held-out accuracy, exactness of the fast forms, defined edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import common as C
from bazaarlens.llm import context_mixing, quality_model, queries, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled():
    import os

    import duckdb

    if not os.path.isdir(SF):
        pytest.skip("no larger tables")
    return duckdb.sql(f"SELECT d.doc_id, text, quality, toxic FROM '{SF}/documents.parquet' d JOIN '{SF}/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()


def folds(rows, modulus, value, column):
    held = [zlib.crc32(str(r[0]).encode()) % modulus == value for r in rows]
    pick = lambda want: [(r[1], r[column]) for r, h in zip(rows, held, strict=True) if h == want]
    return pick(False), pick(True)


def test_toxicity_held_out(labelled):
    learn, test = folds(labelled, 5, 0, 3)
    toxic, clean = [r for r in learn if r[1] and len(r[0]) < 8000], [r for r in learn if not r[1] and len(r[0]) < 8000][:600]
    net = toxicity.fit(toxic + clean, rounds=3)
    test = test[:300]
    score = toxicity.document_scores(net, C.as_array(pa.array([t for t, _ in test])))
    assert np.mean((score >= 0.5) == [y == 1 for _, y in test]) > 0.93


def test_toxicity_is_fitted_in_a_task(spark, monkeypatch):
    """The driver's own process sees neither the sample nor the fit; the weights are those of a fit on the same rows."""
    docs = spark.createDataFrame([(i, f"{'awful nasty' if i % 3 == 0 else 'kind calm'} word{i} text") for i in range(60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) AS toxic")
    want = toxicity.fit(C.labelled_sample(docs, labels, "toxic", F.lit(True), toxicity.PER_CLASS, toxicity.MAX_CHARS))
    monkeypatch.setattr(C, "labelled_sample", None)
    net = toxicity.train(docs, labels, F.lit(True))
    assert all(np.array_equal(net.p[k], want.p[k]) for k in want.p)


def test_toxicity_gradients_are_right():
    net = toxicity.Network(3)
    text = C.as_array(pa.array(["a bad day for you", "good"]))
    ids, counts, distinct = C.words(text)
    feats, seen = toxicity.features(distinct), toxicity.Windows(ids, counts)[:]
    y, weight = np.array([1.0, 0.0], np.float32), np.ones(2, np.float32)

    def loss():
        z = net.forward(net.gates(net.vectors(feats)), seen).astype(float)
        return float(np.sum(np.logaddexp(0, z) - y * z) / 2)

    class Catch:
        def apply(self, p, g):
            self.g = {k: v.copy() for k, v in g.items()}

    catch = Catch()
    net.step(feats, seen, y, weight, catch)
    for name, at in (("wh", (0, 1, 2)), ("wh", (1, 0, 30)), ("wx", (1, 3, 4)), ("att", (1, 2)), ("out", (0, 1)), ("char", (feats[1][0], 1)), ("word", (feats[0][0], 2))):
        old, eps = float(net.p[name][at]), 1e-2
        net.p[name][at] = old + eps
        up = loss()
        net.p[name][at] = old - eps
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / (2 * eps) - catch.g[name][at]) < 2e-3


def test_windows_cover_every_token():
    for n in (0, 1, 31, 32, 33, 100, 333):
        seen = toxicity.Windows(np.arange(n, dtype=np.int32), np.array([n]))
        ids = seen[:]
        assert sorted(set(ids[ids >= 0].tolist())) == list(range(n)) and len(seen) >= 1
        assert (seen[len(seen) - 1 :] == ids[-1]).all()


def test_quality_held_out_and_linear_form(labelled):
    learn, test = folds(labelled, 3, 1, 2)
    bad, good = [r for r in learn if not r[1] and len(r[0]) < 8000], [r for r in learn if r[1] and len(r[0]) < 8000][:500]
    model = quality_model.fit(bad + good)
    test = test[:300]
    score = quality_model.document_scores(model.frozen(), C.as_array(pa.array([t for t, _ in test])))
    assert np.mean((score >= 0.5) == [y == 1 for _, y in test]) > 0.95
    for (text, _), s in list(zip(test, score, strict=True))[:10]:
        slots, share = quality_model.document_features(text)
        assert abs(model.probabilities(share @ model.vectors[slots])[1] - s) < 1e-4


@pytest.mark.parametrize("operator", [toxicity, quality_model])
def test_edge_rows(spark, messy, nothing, no_labels, operator):
    assert operator.train(messy, no_labels, queries.held_out(5, 0)) is None
    model = operator.fit([("good fine text here", 1), ("bad bad awful words", 0)] * 4)
    rows = operator.score(messy, model).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert operator.score(messy, model, "verdict").columns == [*messy.columns, "verdict"]
    same = [r["score"] for r in rows if r["doc_id"] == 1]
    assert same[0] == same[1]
    assert operator.score(nothing, model).count() == 0 and operator.score(messy, None).count() == messy.count()


def test_sample_is_bounded_and_deterministic(spark, messy):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1), (7, 0), (8, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    got = C.labelled_sample(messy, labels, "toxic", F.lit(True), (2, 1), 1000)
    assert got == C.labelled_sample(messy, labels, "toxic", F.lit(True), (2, 1), 1000) and len(got) <= 3


def test_code_is_complete_and_model_is_a_distribution():
    texts = ["the cat", "the dog", "a cat, the end", ""] * 5
    array = C.as_array(pa.array(texts))
    symbols = np.zeros(257, np.int64)
    data, _ = C.raw_bytes(array)
    symbols[:256], symbols[256] = np.bincount(data, minlength=256), len(texts)
    code = context_mixing.Code(symbols)
    assert abs(sum(2.0 ** -code.length) - 1) < 1e-12
    seen = [np.zeros(1 << log, np.int64) for _, log in context_mixing.TABLES]
    ones = [np.zeros(1 << log, np.int64) for _, log in context_mixing.TABLES]
    bits = context_mixing.spelled(code, array)
    for k, slots in enumerate(bits.slots):
        np.add.at(seen[k], slots, 1)
        np.add.at(ones[k], slots[bits.bit > 0], 1)
    M = context_mixing
    model = M.Model(code, [M.log_odds(n, o) for n, o in zip(seen, ones, strict=True)], [M.evidence_of(n) for n in seen], M.starting_weights(code, seen, ones, texts))
    # after any start, the chances of the next symbol (byte or end) sum to one
    start = "the c"
    longer = [pa.array([start.encode() + bytes([b])]).cast(pa.binary()) for b in range(256)]
    raw = pa.concat_arrays(longer)
    large = pa.LargeStringArray.from_buffers(len(raw), pa.py_buffer((np.arange(len(raw) + 1) * 6).astype(np.int64)), raw.buffers()[2])
    with_next = 2.0 ** -M.mixed_bits(model, large)  # each includes its end mark, so the sum is below that of the prefix
    ended = 2.0 ** -M.mixed_bits(model, C.as_array(pa.array([start])))[0]
    assert 0 < with_next.sum() + ended < 1
    assert M.mixed_bits(model, C.as_array(pa.array(["the cat"])))[0] < M.mixed_bits(model, C.as_array(pa.array(["zq xjw#"])))[0]


def test_token_scores_match_brute_force(spark, root, tables):
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_context_mixing"](spark, root).collect()}
    docs = tables.sql("SELECT doc_id, text FROM documents").fetchall()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    import re

    split = lambda t: re.findall(C.WORD, (t or "").translate(lower))
    counts, ends = Counter(), 0
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(split(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    floor = math.log10(n + 0.1 * (v + 1))
    for i, t in docs:
        words, r = split(t), got[i]
        base = sum(math.log10(counts[w] + 0.1) - floor for w in words) + math.log10(ends + 0.1) - floor
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] < 0
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)


def test_rare_words_are_joined_exactly(spark, messy, nothing, monkeypatch):
    from pyspark.sql import functions as F

    whole = {(r["doc_id"], r["n_tokens"]): r["base_score"] for r in context_mixing.scored(messy, context_mixing.learned(messy), F.lit(False)).collect()}
    monkeypatch.setattr(context_mixing, "COMMON", 2)
    few = {(r["doc_id"], r["n_tokens"]): r["base_score"] for r in context_mixing.scored(messy, context_mixing.learned(messy), F.lit(False)).collect()}
    assert whole.keys() == few.keys() and all(abs(whole[k] - few[k]) < 1e-9 * abs(whole[k]) for k in whole)
    empty = context_mixing.learned(nothing)
    assert context_mixing.scored(nothing, empty, F.lit(False)).count() == 0
    assert context_mixing.scored(messy, empty, F.lit(False)).count() == messy.count()


def test_context_counts_travel_as_packed_blocks(spark):
    """A row per block of slots instead of a row per slot, with the counts of all texts."""
    M = context_mixing
    texts = [f"row {i} says so and {i * i}" for i in range(200)] + ["ab " * 4000, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    array = pc.ascii_lower(C.as_array(pa.array(texts, pa.large_string())))
    code = M.Code(np.append(np.bincount(C.raw_bytes(array)[0], minlength=M.END), len(texts)))
    bits = M.spelled(code, array)
    want = np.concatenate([np.bincount(s * np.uint32(2) + bits.bit, minlength=2 << log) for s, (_, log) in zip(bits.slots, M.TABLES, strict=True)])
    got, rows = np.zeros(2 * M.SLOTS, np.int64), M.context_counts(docs, code).collect()
    for r in rows:
        got[2 * M.BLOCK * r["block"] : 2 * M.BLOCK * (r["block"] + 1)] = M.unpacked(r["counts"], 2 * M.BLOCK)
    assert np.array_equal(got, want) and len(rows) == len({r["block"] for r in rows}) <= M.SLOTS // M.BLOCK
    large = np.array([0, 1, 255, 256, 2**40, 2**62] * 4)
    assert np.array_equal(M.unpacked(M.packed(large), len(large)), large)


def test_start_weights_are_fitted_on_every_row(spark):
    """More rows than the old sample held, and texts longer than it took: all their bits are counted, each without itself."""
    M = context_mixing
    texts = [f"row {i} says so" for i in range(300)] + ["ab " * 4000, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    array = pc.ascii_lower(C.as_array(pa.array(texts, pa.large_string())))
    code = M.Code(np.append(np.bincount(C.raw_bytes(array)[0], minlength=M.END), len(texts)))
    bits = M.spelled(code, array)
    seen = [np.bincount(s, minlength=1 << log) for s, (_, log) in zip(bits.slots, M.TABLES, strict=True)]
    ones = [np.bincount(s, weights=bits.bit, minlength=1 << log).astype(np.int64) for s, (_, log) in zip(bits.slots, M.TABLES, strict=True)]
    codes = M.combination_codes(seen, ones)
    counts = M.combinations(docs, code, codes)
    assert counts.sum() == len(bits.bit) and counts[1::2].sum() == bits.bit.sum()
    assert np.array_equal(counts, M.combination_counts(code, codes, array))
    # the gate and the bit's own log-odds, counted without it, can be read back from the number
    less = [seen[k][bits.slots[k]] - 1 for k in range(3)]
    gates = M.gate_of([M.evidence_of(less[k]) for k in M.GATED])
    assert np.array_equal(np.bincount(gates, minlength=M.GATES), counts.reshape(M.GATES, -1).sum(axis=1))
    learned = M.learned(docs).model.weights
    assert np.allclose(learned, M.fitted_weights(counts)) and np.isfinite(learned).all()


@pytest.mark.parametrize("text", ["", "a", "A.", "Re.", "é", "abcd"])
def test_quality_takes_texts_shorter_than_a_gram(text):
    """A text alone in its slice, or in the training sample, may be shorter than the longest n-gram."""
    slots, share = quality_model.document_features(text)
    assert len(slots) == len(share)
    model = quality_model.fit([("good fine text here", 1), (text, 0)])
    score = quality_model.document_scores(model.frozen(), pa.array([text], pa.large_string()))
    assert len(score) == 1 and 0 <= score[0] <= 1
    assert abs(model.probabilities(share @ model.vectors[slots])[1] - score[0]) < 1e-4 or not len(slots)
