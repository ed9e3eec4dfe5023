"""Quality classifier (2): supervised subword embeddings with a softmax output, trained by stochastic gradient descent.

A document is the average of the learned vectors of its hashed features: words, word pairs, and character n-grams of
three to five bytes, case kept. A softmax over two classes reads that average. Fitting runs in numpy on a bounded sample
of labelled rows (`PER_CLASS`, `MAX_CHARS`).

Scoring is one scan without a shuffle. As the output is linear in the average, every slot's vector is multiplied by the
output weights once, so a feature costs one lookup; the result is the network's own. The weights travel with the task.

Defined cases: NULL, empty and blank texts get the score of the zero vector; without labelled rows of both kinds every
score is 0.5. Repeated rows are scored alike; an empty table gives an empty result. Texts of any length are scored whole;
memory follows the longest one. Other columns are carried along untouched, but one named like the score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bazaarlens.llm import common as C

#: Bounds of the training sample: rows labelled 0 and 1, and characters of a text.
PER_CLASS, MAX_CHARS = (2500, 2500), 20_000
SLOTS_LOG, DIM, GRAMS = 17, 8, (3, 4, 5)
SHIFT = np.uint32(32 - SLOTS_LOG)


def gram_slots(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, slot of the n-gram that starts at each byte) for every n in GRAMS."""
    h, now = np.zeros(len(data), np.uint32), data.astype(np.uint32)
    for j in range(max(GRAMS)):
        h[: max(0, len(data) - j)] += (now[j:] + np.uint32(7)) * np.uint32((0x01000193 ** (j + 1)) & 0xFFFFFFFF)
        if j + 1 in GRAMS:
            yield j + 1, (h ^ np.uint32(j * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1) >> SHIFT


def word_slots(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of every word, slot of the pair that starts there, words per row)."""
    ids, counts, distinct = C.words(text)
    h = C.hash_rows(distinct.cast(pa.large_string()))[ids]
    pair = C.mix64(h[:-1] * np.uint64(0x100000001B3) + h[1:]) if len(h) else h
    pair = np.where(h[:-1] == h[1:], np.uint64(0x5555555555555555), pair) if len(h) else pair  # a word said twice is one feature
    top = np.uint64(64 - SLOTS_LOG)
    return (h >> top).astype(np.int64), np.append(pair >> top, [0] * (len(h) > 0)).astype(np.int64), counts


def spans(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of values in [first, last) of every row."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    last = np.maximum(first, last)
    return total[last] - total[first], last - first


class Model:
    """Slot vectors, output weights and bias. `margin` is what a slot adds to the logit of class 1 over class 0."""

    def __init__(self, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        self.vectors = r.uniform(-1 / DIM, 1 / DIM, (1 << SLOTS_LOG, DIM)).astype(np.float32)
        self.out, self.bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        z = np.exp((s := mean @ self.out + self.bias) - s.max())
        return z / z.sum()

    def frozen(self) -> tuple[np.ndarray, float]:
        return self.vectors @ (self.out[:, 1] - self.out[:, 0]), float(self.bias[1] - self.bias[0])


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of one document and their shares of all its features."""
    row = C.as_array(pa.array([text], pa.large_string()))
    data, _ = C.raw_bytes(row)
    w, pair, _ = word_slots(row)
    slots = [w, pair[:-1], *(s[: max(0, len(data) - n + 1)].astype(np.int64) for n, s in gram_slots(data))]
    found, times = np.unique(np.concatenate(slots), return_counts=True)
    return found, (times / max(1, times.sum())).astype(np.float32)


def fit(rows: list[tuple[str, int]], epochs: int = 6, rate: float = 0.5, lift: float = 200.0, seed: int = 11) -> Model | None:
    """Plain SGD over single documents; `lift` scales the steps of the slot vectors, whose gradients carry the 1/n of the average."""
    labels = np.array([y for _, y in rows])
    if not len(labels) or labels.min() == labels.max():
        return None
    model, rng = Model(seed), np.random.default_rng(seed)
    docs = [document_features(t) for t, _ in rows]
    weight = len(labels) / (2 * np.bincount(labels, minlength=2))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(docs)):
            slots, share = docs[i]
            own = model.vectors[slots]
            mean = share @ own
            err = model.probabilities(mean)
            err[labels[i]] -= 1
            err *= step * weight[labels[i]]
            back = model.out @ err
            model.out -= np.outer(mean, err)
            model.bias -= err
            model.vectors[slots] = own - np.minimum(lift * share, 1)[:, None] * back
    return model


def document_scores(frozen: tuple[np.ndarray, float], text: pa.Array) -> np.ndarray:
    """Probability of class 1 for every row of a text array without nulls."""
    margin, bias = frozen
    data, offsets = C.raw_bytes(text)
    w, pair, counts = word_slots(text)
    first = np.cumsum(counts) - counts
    parts = [spans(margin[w], first, first + counts), spans(margin[pair], first, first + counts - 1)]
    parts += [spans(margin[s], offsets[:-1], offsets[1:] - n + 1) for n, s in gram_slots(data)]
    total, number = sum(p[0] for p in parts), sum(p[1] for p in parts)
    return 1 / (1 + np.exp(-(total / np.maximum(number, 1) + bias)))


def score(docs: DataFrame, model: Model | None, out: str = "score", slice_bytes: int = 2 << 20) -> DataFrame:
    """`docs` with a double column `out` (0 to 1) from the whole of `text`; an input column of that name is replaced."""
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    frozen = model.frozen() if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = C.as_array(b.column(b.schema.names.index("text")))
            found = np.full(len(text), 0.5)
            if frozen is not None:
                for i, j in C.slices(text, slice_bytes):
                    found[i:j] = document_scores(frozen, text.slice(i, j - i))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], [*b.schema.names, out])

    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "quality") -> Model | None:
    """Fit on the bounded sample of labelled rows for which the column expression `learn` holds."""
    return fit(C.labelled_sample(docs, labels, label, learn, PER_CLASS, MAX_CHARS))
