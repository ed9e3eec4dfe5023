"""Embedding whitening (12): leading eigenpairs of the covariance by spectrum slicing, and rows projected on them.

Entries c become whole numbers x = floor(64 * c) + 1,000,000. The mean and covariance are taken over the distinct x-vectors
(the fit list): sums first, then the centred second moments, added up per task and then per cell, so that only d * d numbers
reach the driver. There the matrix is sliced: the pivots' signs of a symmetric factorisation L D L^T of V - s*I count the
eigenvalues above s (inertia). Halving intervals by these counts isolates every leading eigenvalue, Rayleigh quotient
iteration then converges cubically inside the interval, and two more counts right below and above the found value certify
its number; a value that fails is sliced further. Rows are projected in a second scan, batch by batch.

Bounds: matrices of d * d numbers, d the length of the vectors; nothing else grows in a task or the driver.

Defined cases: rows whose vector is NULL, empty, or holds NULL, NaN, infinite or huge entries (beyond 2**40, which no whole
number here could hold exactly) are dropped, as are rows whose length is not the most frequent one (ties: the longest).
Repeated rows count once in the fit and are all returned. Directions without variance (below rounding: d * 2**-52 of the
largest eigenvalue) cannot be whitened and are left out, so equal rows or a single one give no rows, and so does an empty
table. `deviation` is NULL where the exact sum does not fit a long. Equal eigenvalues are numbered in any order. Further
columns are carried along; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm import common as C

COMPONENTS = 16
SCALE, SHIFT, HUGE = 64, 1_000_000, float(2**40)
EPS = 2.0**-52


# --- rows as whole numbers -------------------------------------------------------
def usable(vectors: pa.ListArray, length: int | None = None) -> np.ndarray:
    """Rows whose vector has finite entries only (and `length` of them, at least one)."""
    flat = pc.cast(vectors.flatten(), pa.float64())
    fine = pc.fill_null(pc.less(pc.abs(flat), HUGE), False).to_numpy(zero_copy_only=False)  # NULL and NaN are not less
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    bad = np.concatenate([[0], np.cumsum(~fine)])
    stop = np.cumsum(sizes)
    clean = bad[stop] == bad[stop - sizes]
    return clean & (sizes > 0 if length is None else sizes == length)


def whole_numbers(vectors: pa.ListArray, keep: np.ndarray, length: int) -> np.ndarray:
    """x-vectors of the kept rows [rows, length]."""
    flat = pc.cast(vectors.filter(pa.array(keep)).flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat.reshape(-1, length)).astype(np.int64) + SHIFT


def vector_length(rows: DataFrame, column: str) -> int | None:
    """The most frequent length among usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = pc.list_value_length(b.column(0)).filter(pa.array(usable(b.column(0))))
            counted = kept.value_counts()
            yield pa.RecordBatch.from_arrays([counted.field("values").cast(pa.int32()), counted.field("counts")], ["length", "n"])

    counts = rows.select(column).mapInArrow(run, "length int, n long").groupBy("length").agg(F.sum("n").alias("n"))
    best = counts.orderBy(F.desc("n"), F.desc("length")).first()
    return best and best["length"]


def fit_list(rows: DataFrame, column: str, length: int) -> DataFrame:
    """Every distinct x-vector once, as bytes; equal rows meet in the task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = whole_numbers(b.column(0), usable(b.column(0), length), length)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x], pa.binary())], ["x"])

    return rows.select(column).mapInArrow(run, "x binary").distinct()


def unpacked(column: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, length)


def added_up(table: DataFrame, per_batch, cells: int) -> np.ndarray:
    """Sum over all rows of the array of `cells` numbers that `per_batch` makes of a batch: per task, then per cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for b in batches:
            total = total + per_batch(b.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total, pa.float64())], ["cell", "v"])

    rows = table.mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(cells)
    out[[r["cell"] for r in rows]] = [r["v"] for r in rows]
    return out


# --- spectrum slicing -------------------------------------------------------------
def above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of a symmetric matrix above `shift`: positive pivots of L D L^T of (matrix - shift * I).

    Pivots are chosen among the whole rest, single or in pairs, so that no step divides by a small number; a pair stands for
    one positive and one negative eigenvalue. Pivots that vanish count as not above.
    """
    a = matrix - shift * np.eye(len(matrix))
    tiny = EPS * max(np.abs(a).max(initial=0.0), 1e-300)
    turn = (1 + 17**0.5) / 8
    positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        i = int(diagonal.argmax())
        beside = np.abs(a) - np.diag(diagonal)
        p, q = np.unravel_index(int(beside.argmax()), a.shape)
        if max(diagonal[i], beside[p, q]) <= tiny:
            break
        if diagonal[i] >= turn * beside[p, q]:
            positive += a[i, i] > 0
            chosen = [i]
        else:
            positive += 1
            chosen = [p, q]
        rest = np.delete(np.arange(len(a)), chosen)
        block = a[np.ix_(rest, chosen)]
        a = a[np.ix_(rest, rest)] - block @ np.linalg.solve(a[np.ix_(chosen, chosen)], block.T)
        a = (a + a.T) / 2
    return int(positive)


def rayleigh(matrix: np.ndarray, low: float, high: float, found: np.ndarray, rng: np.random.Generator) -> tuple[float, np.ndarray, float]:
    """(value, unit vector, residual) by Rayleigh quotient iteration, started by inverse iteration in the middle of the
    interval and kept orthogonal to the vectors already found."""
    d, norm = len(matrix), np.abs(matrix).sum(axis=1).max()
    v, shift = rng.normal(size=d), (low + high) / 2
    best = (shift, v, np.inf)
    for step in range(40):
        v = v - found.T @ (found @ v)
        v = v / np.linalg.norm(v)
        if step > 2:  # the first steps stay at the middle, so that the nearest value is met
            shift = float(v @ matrix @ v)
            residual = float(np.linalg.norm(matrix @ v - shift * v))
            if residual < best[2]:
                best = (shift, v, residual)
            if residual <= 2 * d * EPS * norm or (residual >= best[2] and step > 12):
                break
        try:
            v = np.linalg.solve(matrix - shift * np.eye(d), v)
        except np.linalg.LinAlgError:
            v = np.linalg.solve(matrix - (shift + EPS * norm) * np.eye(d), v)
        v = v - found.T @ (found @ v)  # twice is enough
        v = v / np.linalg.norm(v)
    return best


def leading_pairs(matrix: np.ndarray, components: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(values in falling order, unit vectors as rows) of the leading positive eigenvalues, each certified by counts.

    An interval that holds values number a+1 to b is halved until it holds one, or several that differ by rounding only.
    """
    d = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    floor = d * EPS * norm
    values, vectors = [], np.zeros((0, d))
    rng = np.random.default_rng(seed)
    wanted = min(components, above(matrix, floor)) if norm else 0
    pending = [(floor, norm * (1 + 4 * d * EPS), above(matrix, floor) if norm else 0, 0)]  # low, high, count above low, above high
    while len(values) < wanted:
        low, high, more, fewer = pending.pop()
        if more == fewer:
            continue
        middle = (low + high) / 2
        narrow = high - low <= 8 * d * EPS * norm
        if more - fewer > 1 and not narrow:
            n = above(matrix, middle)
            pending += [(low, middle, more, n), (middle, high, n, fewer)]
            continue
        pairs, basis = [], vectors
        for _ in range(more - fewer):
            value, vector, residual = rayleigh(matrix, low, high, basis, rng)
            pairs.append((value, vector, residual))
            basis = np.vstack([basis, vector])
        pairs.sort(key=lambda p: -p[0])
        slack = max(4 * max(p[2] for p in pairs), 4 * d * EPS * norm)
        certified = all(above(matrix, v + slack) <= fewer + k and above(matrix, v - slack) >= fewer + k + 1 for k, (v, _, _) in enumerate(pairs))
        if not certified:
            if narrow:
                raise ArithmeticError(f"eigenvalues {fewer + 1} to {more} near {middle} could not be certified")
            n = above(matrix, middle)
            pending += [(low, middle, more, n), (middle, high, n, fewer)]
            continue
        values += [p[0] for p in pairs]
        vectors = np.vstack([vectors, *(p[1] for p in pairs)])
    return np.array(values[:wanted]), vectors[:wanted]


# --- fit and projection -------------------------------------------------------------
@dataclass
class Whitening:
    """A fitted model: n vectors with sums S, leading values and unit vectors, shares of the trace, and the largest entry by
    which the covariance of the whitened fit list differs from the identity."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.sums / self.n) @ self.vectors.T) / np.sqrt(self.values)


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """None where no usable vector is there."""
    d = vector_length(rows, column)
    if d is None:
        return None
    listed = C.staged(fit_list(rows, column, d), "whitening-fit")
    # sums of x - SHIFT stay exact in doubles: below 2**53 for any table that files can hold
    first = added_up(listed, lambda c: np.concatenate([[len(c)], (unpacked(c, d) - SHIFT).sum(axis=0)]), d + 1)
    n = int(first[0])
    sums = first[1:].astype(np.int64) + n * SHIFT
    mean = sums / n

    def scatter(c: pa.Array) -> np.ndarray:
        centred = unpacked(c, d) - mean
        return (centred.T @ centred).ravel()

    covariance = added_up(listed, scatter, d * d).reshape(d, d) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_pairs(covariance, components)
    model = Whitening(n, sums, values, vectors, values / np.trace(covariance) if len(values) else values, 0.0)
    k = len(values)
    if k:  # measured on the fit list itself, centred before multiplying
        middle = added_up(listed, lambda c: model.project(unpacked(c, d)).sum(axis=0), k) / n

        def white(c: pa.Array) -> np.ndarray:
            w = model.project(unpacked(c, d)) - middle
            return (w.T @ w).ravel()

        model.identity_error = float(np.abs(added_up(listed, white, k * k).reshape(k, k) / n - np.eye(k)).max())
    return model


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sum of (n * x - S)^2 per row; whole numbers of any size where 64 bits could overflow."""
    rough = ((x * float(n) - sums) ** 2).sum(axis=1)
    if len(x) and rough.max() < 2.0**62 and n * float(np.abs(x).max()) < 2.0**62:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [v if v < 2**63 else None for v in exact]


def whitened(rows: DataFrame, model: Whitening | None, column: str = "embedding") -> DataFrame:
    """Usable rows with `deviation` and the array `whitened` (one entry per component); without a model, none."""
    schema = T.StructType([*rows.drop("deviation", "whitened").schema.fields, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    rows = rows.drop("deviation", "whitened")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(b.schema.names.index(column))
            keep = usable(vectors, len(model.sums)) if model is not None else np.zeros(len(vectors), bool)
            kept = [c.filter(pa.array(keep)) for c in b.columns]
            d, w = [], np.zeros((0, 0))
            if keep.any():
                x = whole_numbers(vectors, keep, len(model.sums))
                d, w = deviations(x, model.n, model.sums), model.project(x)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(d, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], [*b.schema.names, "deviation", "whitened"])

    return rows.mapInArrow(run, schema)


def components(rows: DataFrame, column: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: the input columns without the vector, component, n, deviation, whitened,
    explained and identity_error."""
    rows = rows.drop("component", "n", "explained", "identity_error")
    model = fit(rows, column, k)
    known = model is not None
    shares = F.array(*(F.lit(float(e)) for e in model.explained)) if known and len(model.explained) else F.array().cast("array<double>")
    opened = whitened(rows, model, column).drop(column).select("*", F.posexplode("whitened").alias("at", "value")).drop("whitened")
    return opened.withColumns(
        {
            "component": (F.col("at") + 1).cast("int"),
            "n": F.lit(model.n if known else 0).cast("long"),
            "whitened": F.col("value"),
            "explained": F.get(shares, F.col("at")),
            "identity_error": F.lit(model.identity_error if known else 0.0),
        }
    ).drop("at", "value")
