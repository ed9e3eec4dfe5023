"""Toxicity (1): a bidirectional gated recurrent network with attention pooling over word and character inputs.

Every token enters as the vector of its hashed word beside the mean vector of its hashed character triples. Two gated
recurrent units read a window of tokens from both ends, attention pools their states, and a logistic output gives the
window's probability. All overlapping windows of the whole text are scored; a document's score is its highest window.

Fitting runs in numpy, in one task, on a bounded sample of labelled rows (`PER_CLASS`, `MAX_CHARS`): one pass in which every window
carries its document's label, then passes on the highest window of each document. Scoring is one scan without a shuffle;
the weights, under 1 MB whatever the data, travel with the task.

Defined cases: NULL, empty and blank texts get the empty window's score, at most 0.5; without labelled rows of both kinds
every score is 0. Repeated rows are scored alike; an empty table gives an empty result. Texts of any length are scored whole;
memory follows the longest one. Columns besides `text` are carried along untouched, but one named like the score is replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bazaarlens.llm import common as C

#: Bounds of the training sample: clean and toxic rows, and characters of a text.
PER_CLASS, MAX_CHARS = (3000, 1500), 12_000
WIDTH, STEP = 32, 24
WORD_SLOTS, CHAR_SLOTS, WORD_DIM, CHAR_DIM, HIDDEN = 1 << 14, 1 << 12, 8, 8, 12
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def features(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word slot per word, character-triple slot per byte, byte offsets), of lower-cased words without edge punctuation."""
    folded = pc.utf8_lower(distinct)
    bare = pc.utf8_trim(folded, characters=EDGE)
    kept = pc.if_else(pc.equal(pc.binary_length(bare), 0), folded, bare)
    data, offsets = C.raw_bytes(kept.cast(pa.large_string()))
    now = data.astype(np.uint32)
    before, after = np.roll(now, 1), np.roll(now, -1)
    before[offsets[:-1]], after[offsets[1:] - 1] = 2, 3
    triple = ((before * np.uint32(0x01000193) ^ now) * np.uint32(0x01000193) ^ after) * np.uint32(0x9E3779B1)
    return (C.hash_rows(kept) % np.uint64(WORD_SLOTS)).astype(np.int64), (triple >> np.uint32(20)).astype(np.int64) % CHAR_SLOTS, offsets


class Network:
    """Weights, forward pass and gradients. Sizes: V words, B windows, W tokens, H hidden units, two directions."""

    def __init__(self, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        wide = WORD_DIM + CHAR_DIM
        draw = lambda *s, scale: r.normal(0, scale, s).astype(np.float32)
        self.p = {
            "word": draw(WORD_SLOTS, WORD_DIM, scale=0.1),
            "char": draw(CHAR_SLOTS, CHAR_DIM, scale=0.3),
            "wx": draw(2, wide, 3 * HIDDEN, scale=wide**-0.5),
            "wh": draw(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "att": draw(2, HIDDEN, scale=0.3),
            "out": draw(2, HIDDEN, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }

    def vectors(self, feats) -> np.ndarray:
        """Input vector of every distinct word [V, word and character part]."""
        slot, triple, offsets = feats
        if not len(slot):
            return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        mean = np.add.reduceat(self.p["char"][triple], offsets[:-1], axis=0) / np.diff(offsets)[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][slot], mean], axis=1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What every word adds to the gates [2, V + 1, 3H]; the last row, for padding, is never used: the state is held there."""
        proj = np.zeros((2, len(x) + 1, 3 * HIDDEN), np.float32)
        np.matmul(x, self.p["wx"], out=proj[:, :-1])
        proj[:, :-1] += self.p["b"]
        return proj

    def forward(self, proj: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows from the words' gates; ids [B, W] number the words, -1 past the end of a short text."""
        p, (n, w) = self.p, ids.shape
        h = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((w, 2, n, HIDDEN), np.float32)
        padded = bool((ids < 0).any())
        kept = []
        for t in range(w):
            a, c = ids[:, t], ids[:, w - 1 - t]
            g = np.stack([proj[0].take(a, axis=0, mode="wrap"), proj[1].take(c, axis=0, mode="wrap")])
            rec = np.matmul(h, p["wh"])
            zr = sigmoid(g[..., : 2 * HIDDEN] + rec[..., : 2 * HIDDEN])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            cand = np.tanh(g[..., 2 * HIDDEN :] + r * rec[..., 2 * HIDDEN :])
            new = cand + z * (h - cand)
            live = np.stack([a, c])[..., None] >= 0 if padded else None
            if padded:
                new = np.where(live, new, h)
            if keep:
                kept.append((h, z, r, cand, rec[..., 2 * HIDDEN :], live))
            h = new
            states[t, 0], states[w - 1 - t, 1] = h[0], h[1]
        e = np.einsum("wdbh,dh->wb", states, p["att"], optimize=True)
        if padded:
            e = np.where(ids.T >= 0, e, -30)
        e = np.exp(e - e.max(axis=0))
        share = e / e.sum(axis=0)
        if padded:
            share = share * (ids[:, 0] >= 0)  # an empty window pools nothing
        pooled = np.einsum("wb,wdbh->dbh", share, states, optimize=True)
        logit = np.einsum("dbh,dh->b", pooled, p["out"]) + p["bias"]
        return (logit, (states, share, pooled, kept)) if keep else logit

    def step(self, feats, ids: np.ndarray, y: np.ndarray, weight: np.ndarray, opt: "Adam") -> None:
        """One gradient step on the weighted log loss of the windows."""
        p, (_, w) = self.p, ids.shape
        slot, triple, offsets = feats
        x = self.vectors(feats)
        logit, (states, share, pooled, kept) = self.forward(self.gates(x), ids, keep=True)
        d = ((sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g = {"bias": d.sum(keepdims=True), "out": np.einsum("b,dbh->dh", d, pooled)}
        dpool = d[None, :, None] * p["out"][:, None, :]
        ds = np.einsum("wdbh,dbh->wb", states, dpool, optimize=True)
        de = share * (ds - (share * ds).sum(axis=0))
        g["att"] = np.einsum("wb,wdbh->dh", de, states, optimize=True)
        dstate = share[:, None, :, None] * dpool + de[:, None, :, None] * p["att"][:, None, :]
        dh = np.zeros_like(dpool)
        dproj = np.zeros((2, len(x), 3 * HIDDEN), np.float32)
        g["wh"] = np.zeros_like(p["wh"])
        for t in reversed(range(w)):
            h, z, r, cand, rec, live = kept[t]
            dh = dh + np.stack([dstate[t, 0], dstate[w - 1 - t, 1]])
            dnew = dh if live is None else dh * live
            dc = dnew * (1 - z) * (1 - cand * cand)
            dz = dnew * (h - cand) * z * (1 - z)
            dr = dc * rec * r * (1 - r)
            into = np.concatenate([dz, dr, dc * r], axis=-1)
            g["wh"] += np.matmul(h.transpose(0, 2, 1), into)
            dh = dnew * z + np.matmul(into, p["wh"].transpose(0, 2, 1)) + (0 if live is None else dh * ~live)
            gates = np.concatenate([dz, dr, dc], axis=-1)
            for k, col in ((0, t), (1, w - 1 - t)):
                ok = ids[:, col] >= 0
                np.add.at(dproj[k], ids[ok, col], gates[k][ok])
        g["b"] = dproj.sum(axis=1, keepdims=True)
        g["wx"] = np.matmul(x.T, dproj)
        dx = np.matmul(dproj, p["wx"].transpose(0, 2, 1)).sum(axis=0)
        dword = np.zeros_like(p["word"])
        np.add.at(dword, slot, dx[:, :WORD_DIM])
        lengths = np.diff(offsets)
        dchar = np.zeros_like(p["char"])
        np.add.at(dchar, triple, np.repeat(dx[:, WORD_DIM:] / lengths[:, None].astype(np.float32), lengths, axis=0))
        opt.apply(p, g | {"word": dword, "char": dchar})


class Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def apply(self, p: dict, g: dict) -> None:
        self.t += 1
        for k, d in g.items():
            m = self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * d
            v = self.v[k] = 0.99 * self.v.get(k, 0) + 0.01 * d * d
            p[k] -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-6)


class Windows:
    """All windows of a batch of texts as places, of which only blocks are ever spelled out: they start every STEP tokens,
    the last one flush with the end. `owner` is the document of each."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray) -> None:
        each = np.maximum(1, 1 + -(-(counts - WIDTH) // STEP))
        self.owner = np.repeat(np.arange(len(counts), dtype=np.int32), each)
        number = np.arange(len(self.owner)) - np.repeat(np.cumsum(each) - each, each)
        start = np.minimum(number * STEP, np.maximum(counts[self.owner] - WIDTH, 0))
        self.live = np.minimum(counts[self.owner] - start, WIDTH).astype(np.int32)
        self.first = start + (np.cumsum(counts) - counts)[self.owner]
        self.ids = ids if len(ids) else np.full(1, -1, np.int32)

    def __len__(self) -> int:
        return len(self.owner)

    def __getitem__(self, chosen) -> np.ndarray:
        """Word numbers [chosen, WIDTH]; -1 past the end of a short text."""
        place = np.arange(WIDTH)
        inside = place < self.live[chosen][:, None]
        return np.where(inside, self.ids[np.where(inside, self.first[chosen][:, None] + place, 0)], -1)


def compact(feats, ids: np.ndarray):
    """Restrict word features to the words that occur in `ids`, renumbered."""
    used, back = np.unique(ids[ids >= 0], return_inverse=True)
    out = np.full(ids.shape, -1, np.int64)
    out[ids >= 0] = back
    slot, triple, offsets = feats
    lengths = np.diff(offsets)[used]
    place = np.repeat(offsets[:-1][used] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return (slot[used], triple[place], np.concatenate([[0], np.cumsum(lengths)])), out


def document_scores(net: Network, text: pa.Array, block: int = 2048) -> np.ndarray:
    """Highest window probability of every row of a text array without nulls."""
    ids, counts, distinct = C.words(text)
    proj = net.gates(net.vectors(features(distinct)))
    best = np.full(len(text), -np.inf, np.float32)
    seen = Windows(ids, counts)
    for i in range(0, len(seen), block):
        np.maximum.at(best, seen.owner[i : i + block], net.forward(proj, seen[i : i + block]))
    return sigmoid(best.astype(np.float64))


def fit(rows: list[tuple[str, int]], seed: int = 7, rounds: int = 6, batch: int = 256) -> Network | None:
    """Train on (text, label) rows; None unless both labels occur. The list is emptied once its words are numbered.

    The first pass takes all windows of toxic rows and at most twice as many, drawn at random, of clean rows.
    """
    y = np.array([label for _, label in rows], np.float32)
    if not len(y) or y.min() == y.max():
        return None
    ids, counts, distinct = C.words(C.as_array(pa.array([t for t, _ in rows], pa.large_string())))
    rows.clear()  # the sample lives on as word numbers
    feats = features(distinct)
    seen = Windows(ids, counts)
    owner = seen.owner
    net, rng = Network(seed), np.random.default_rng(seed)
    opt = Adam(0.01)

    def logits(block: int = 2048) -> np.ndarray:
        parts = []
        for i in range(0, len(seen), block):  # block by block with its own words, so that memory follows the block
            small, local = compact(feats, seen[i : i + block])
            parts.append(net.forward(net.gates(net.vectors(small)), local))
        return np.concatenate(parts)

    def learn(chosen: np.ndarray, times: int) -> None:
        truth = y[owner[chosen]]
        share = max(truth.mean(), 1e-6)
        weight = np.where(truth > 0, 0.5 / share, 0.5 / max(1 - share, 1e-6)).astype(np.float32)
        for _ in range(times):
            for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // batch)):
                small, local = compact(feats, seen[chosen[part]])
                net.step(small, local, truth[part], weight[part], opt)

    # every window carries its document's label; of the windows of clean rows about as many as of the others
    positive = np.flatnonzero(y[owner] > 0)
    negative = rng.permutation(np.flatnonzero(y[owner] == 0))[: max(2 * len(positive), batch)]
    learn(np.concatenate([positive, negative]), 1)
    for k in range(rounds):
        opt.rate = 0.005 / (1 + k)
        order = np.lexsort((-logits(), owner))
        top = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
        learn(top, 2)
    return net


def score(docs: DataFrame, net: Network | None, out: str = "score", slice_bytes: int = 2 << 20) -> DataFrame:
    """`docs` with a double column `out` (0 to 1) from the whole of `text`; an input column of that name is replaced."""
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = C.as_array(b.column(b.schema.names.index("text")))
            found = np.zeros(len(text))
            if net is not None:
                for i, j in C.slices(text, slice_bytes):
                    part = text.slice(i, j - i)
                    found[i:j] = document_scores(net, part)
                empty = min(0.5 - 1e-9, float(sigmoid(net.p["bias"][0])))
                blank = pc.equal(pc.binary_length(pc.ascii_trim_whitespace(text)), 0).to_numpy(zero_copy_only=False)
                found[blank] = empty
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], [*b.schema.names, out])

    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic") -> Network | None:
    """Fit on the bounded sample of labelled rows for which the column expression `learn` holds. One task fits, so that neither
    the sample nor the work is the driver's; only the weights get there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = fit([row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)])
        yield pa.RecordBatch.from_arrays([pa.array([] if net is None else [pickle.dumps(net)], pa.binary())], ["net"])

    got = C.sample_rows(docs, labels, label, learn, PER_CLASS, MAX_CHARS).mapInArrow(run, "net binary").collect()
    return pickle.loads(got[0]["net"]) if got else None
