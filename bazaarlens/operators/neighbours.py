"""Exact nearest neighbours by cosine, by metric pruning: cells around pivots, triangle inequality, blocks.

Angles between vectors obey the triangle inequality. Vectors are dealt to the nearest of a bounded number of pivots; a cell
knows its pivot and its radius, the largest angle of a member. First every vector is compared with a block of its own cell,
which gives the angle t of its k-th best so far (for a search above a threshold, t is given). A cell whose pivot lies at an
angle of more than t + radius holds nothing better and is passed over; all others are compared. So the result is that of all pairs,
whatever the pivots; on vectors without any structure no cell can be passed over, on clustered ones most are (`scored_share`
tells).

Cells that lie near each other make areas of a bounded size (`AREA_BYTES` as a matrix; large cells are divided among several).
Comparisons run in pairs of areas, a matrix product at a time, so neither a large cell nor a sought-after one meets in one task,
and a vector is sent as often as there are areas with something for it, not once per cell. Equal vectors are one class and compared once; each class stands for its first
members. Rows without a vector, or with one of length zero, have no direction and take no part.

Vectors are unit vectors, dense (`v`) or sparse (places `at` below a given width, and values `v`); a class is named by its
smallest member, `head`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bazaarlens.sources.io import stage

PIVOTS, OWN_BLOCK = 1024, 2048
#: An area as a dense matrix, the least number of vectors in it, and into how many areas a small table is cut.
AREA_BYTES, LEAST_AREA, SIDES = 32 << 20, 256, 10
#: Similarities held at once, and tasks at most.
SCORES, PAIR_TASKS = 1 << 21, 4096
SLACK = 2e-6  # similarities are ranked after rounding to six digits
PAIRS = "head string, other string, similarity double"


def matrix(frame: pd.DataFrame, width: int | None) -> np.ndarray:
    if width is None:
        return np.stack(frame["v"].to_numpy())
    out = np.zeros((len(frame), width))
    sizes = frame["v"].map(len).to_numpy()
    if sizes.sum():
        out[np.repeat(np.arange(len(frame)), sizes), np.concatenate(frame["at"].to_numpy())] = np.concatenate(frame["v"].to_numpy())
    return out


def angle(similarity):
    return np.arccos(np.clip(similarity, -1.0, 1.0))


@dataclass
class Cells:
    """Pivots (a bounded number of unit vectors), members dealt to them, and per cell its size and radius."""

    pivots: np.ndarray
    members: DataFrame  # head, (at,) v, asks, cell
    sizes: np.ndarray
    radius: np.ndarray
    width: int | None


def cells_of(classes: DataFrame, width: int | None = None, asks: Column | None = None, pivots: int = PIVOTS) -> Cells:
    """Classes (head, (at,) v) in about as many cells as the square root of their number, at most `pivots`.

    Pivots are drawn by a digest of the head. `asks` marks the classes whose neighbours are wanted (default: all).
    """
    vector = [c for c in ("at", "v") if c in classes.columns]
    classes = classes.withColumn("asks", F.lit(True) if asks is None else asks).select("head", *vector, "asks")
    wanted = max(1, min(pivots, math.isqrt(classes.count())))
    drawn = classes.orderBy(F.xxhash64("head"), "head").limit(wanted).toPandas()
    chosen = matrix(drawn, width) if len(drawn) else np.zeros((1, width or 1))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not f.empty:
                near = matrix(f, width) @ chosen.T
                yield f.assign(cell=near.argmax(axis=1).astype(np.int32), apart=angle(near.max(axis=1)))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    members = stage(classes.mapInPandas(deal, f"{fields}, cell int, apart double"), "neighbour-cells")
    sizes, radius = np.zeros(len(chosen), np.int64), np.zeros(len(chosen))
    for r in members.groupBy("cell").agg(F.count("*").alias("n"), F.max("apart").alias("r")).collect():  # one row per cell
        sizes[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    return Cells(chosen, members.drop("apart"), sizes, radius, width)


def areas_of(cells: Cells, block: int | None) -> list[list[int]]:
    """Per cell the areas of its blocks. An area takes about `block` vectors of cells that lie near each other: cells are
    chained from pivot to nearest pivot; one larger than an area is divided."""
    total, near = int(cells.sizes.sum()), cells.pivots @ cells.pivots.T
    dense = AREA_BYTES // (8 * cells.pivots.shape[1])
    limit = block or max(LEAST_AREA, min(dense, -(-total // SIDES)))
    left, at = np.ones(len(near), bool), 0
    areas, area, filled = [[] for _ in near], 0, 0
    for _ in near:
        left[at] = False
        n = max(1, -(-int(cells.sizes[at]) // limit))
        for _ in range(n):
            if filled and filled + cells.sizes[at] / n > limit:
                area, filled = area + 1, 0
            areas[at].append(area)
            filled += cells.sizes[at] / n
        at = int(np.where(left, near[at], -np.inf).argmax())
    return areas


def asking_areas(cells: Cells, areas: list[list[int]], k: int | None, threshold: float | None) -> DataFrame:
    """Every asking vector with the similarity that others must reach (`bound`: the threshold, or that of its k-th best in a
    block of its own cell; none: NULL), the cells that may hold such (`asked`, bits) and their areas (`areas`)."""
    pivots, radius, sizes, width = cells.pivots, cells.radius, cells.sizes, cells.width
    holds = np.zeros((len(sizes), 1 + max(a for c in areas for a in c)), np.float32)
    for c, mine in enumerate(areas):
        holds[c, mine] = 1
    blocks = -(-np.maximum(sizes, 1) // OWN_BLOCK)

    def asks(f: pd.DataFrame) -> pd.DataFrame:
        v = matrix(f, width)
        wanted = f["asks"].to_numpy(bool)
        bound = np.full(len(f), np.nan if threshold is None else threshold)
        if threshold is None and len(f) > k:
            near = v @ v.T
            np.fill_diagonal(near, -np.inf)
            bound = np.partition(near, -k, axis=1)[:, -k]
        reach = angle(np.nan_to_num(bound, nan=-1.0) - SLACK)
        need = (angle(v @ pivots.T) - radius <= reach[:, None] + 1e-9) & (sizes > 0)
        need[:, f["cell"].iloc[0]] = True
        f = f.assign(bound=bound, asked=[r.tobytes() for r in np.packbits(need, axis=1)], areas=[np.flatnonzero(r) for r in need.astype(np.float32) @ holds > 0])
        return f[wanted].drop(columns=["asks", "own"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.members.schema.fields if f.name != "asks")
    own = F.pmod(F.xxhash64("head", F.lit(1)), F.element_at(F.lit(blocks.tolist()), F.col("cell") + 1))
    dealt = in_areas(cells, areas).withColumn("own", own).groupBy("cell", "own")
    return stage(dealt.applyInPandas(asks, f"{fields}, area int, bound double, asked binary, areas array<int>"), "neighbour-asking")


def in_areas(cells: Cells, areas: list[list[int]]) -> DataFrame:
    """The members with their area; blocks of a cell are dealt by a digest of the head."""
    spark = cells.members.sparkSession
    listed = F.broadcast(spark.createDataFrame(list(enumerate(areas)), "cell int, of_cell array<int>"))  # one row per cell
    of = F.element_at("of_cell", F.pmod(F.xxhash64("head"), F.size("of_cell")).cast("int") + 1)
    return cells.members.join(listed, "cell").withColumn("area", of).drop("of_cell")


def compared(cells: Cells, areas: list[list[int]], asking: DataFrame, k: int | None) -> DataFrame:
    """The k best (similarity falling, head rising; all for None) of at least its bound for each asking vector in each area it
    asks. Areas meet in pairs, one of askers and one of members, so a vector is sent once per pair, not per cell."""
    spark, width, n_cells = asking.sparkSession, cells.width, len(cells.sizes)
    vector = [c for c in ("at", "v") if c in cells.members.columns]
    asked = asking.withColumn("to", F.explode("areas"))
    met = sorted((r["area"], r["to"]) for r in asked.select("area", "to").distinct().collect())  # pairs of areas
    pairs = lambda: F.broadcast(spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(met)], "area int, to int, pair int"))
    parts = max(1, min(PAIR_TASKS, 2 * len(met)))
    left = asked.join(pairs(), ["area", "to"]).select("pair", "head", *vector, "cell", "bound", "asked")
    right = in_areas(cells, areas).withColumnRenamed("area", "to").join(pairs(), "to").select("pair", "head", *vector, "cell")

    def best(q: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        if q.empty or m.empty:
            return pd.DataFrame({"head": [], "other": [], "similarity": []}).astype({"head": str, "other": str, "similarity": float})
        q, m = q.sort_values("cell"), m.sort_values("cell")  # neighbours on both sides ask and hold the same cells
        heads, names = q["head"].to_numpy().astype(str), m["head"].to_numpy().astype(str)
        rank = np.argsort(np.argsort(names))
        itself = pd.Index(names).get_indexer(heads)
        need = np.unpackbits(np.frombuffer(b"".join(q["asked"]), np.uint8).reshape(len(q), -1), axis=1, count=n_cells).astype(bool)
        of, low = m["cell"].to_numpy(), q["bound"].fillna(-np.inf).to_numpy(float)
        x, y = matrix(q, width), matrix(m, width)
        found = []
        step = max(16, min(256, SCORES // len(m)))
        for i in range(0, len(q), step):
            at = np.flatnonzero(need[i : i + step].any(axis=0)[of])
            if not len(at):
                continue
            near = x[i : i + step] @ (y if len(at) == len(m) else y[at]).T
            place = np.searchsorted(at, itself[i : i + step])
            same = np.flatnonzero((itself[i : i + step] >= 0) & (at[np.minimum(place, len(at) - 1)] == itself[i : i + step]))
            near[same, place[same]] = -np.inf
            least = low[i : i + step] - SLACK
            open_ = np.flatnonzero(np.isneginf(least))
            if k is not None and len(open_) and len(at) > k:
                least[open_] = np.partition(near[open_], -k, axis=1)[:, -k] - SLACK
            row, col = np.nonzero((near >= least[:, None]) & (near > -np.inf))
            value = np.round(near[row, col], 6)
            if k is None:
                keep = value >= low[i + row]
            else:
                order = np.lexsort((rank[at[col]], -value, row))
                row, col, value = row[order], col[order], value[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            found.append((heads[i + row[keep]], names[at[col[keep]]], value[keep]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, str), np.zeros(0, str), np.zeros(0)]
        return pd.DataFrame(dict(zip(("head", "other", "similarity"), columns, strict=True)))

    dealt = lambda df: df.repartition(parts, "pair").groupBy("pair")
    return dealt(left).cogroup(dealt(right)).applyInPandas(best, PAIRS)


def class_neighbours(cells: Cells, k: int, block: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(k best classes of every asking class as head, other, similarity; the asking classes with the cells they asked)."""
    order = W.partitionBy("head").orderBy(F.desc("similarity"), "other")
    areas = areas_of(cells, block)
    asking = asking_areas(cells, areas, k, None)
    found = compared(cells, areas, asking, k)
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("head", "other", "similarity"), asking


def classes_above(cells: Cells, threshold: float, block: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All (head, other, similarity) of at least `threshold`, both ways round, and the asking classes with the cells they asked."""
    areas = areas_of(cells, block)
    asking = asking_areas(cells, areas, None, threshold)
    return compared(cells, areas, asking, None), asking


def scored_share(cells: Cells, asking: DataFrame) -> float:
    """Pairs of an asking class and a member of a cell it asks, as a share of all ordered pairs of classes, where all ask."""
    n, sizes = int(cells.sizes.sum()), cells.sizes

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"n": [int(np.unpackbits(np.frombuffer(b, np.uint8), count=len(sizes)) @ sizes) for b in f["asked"]]})

    return (asking.select("asked").mapInPandas(pairs, "n bigint").agg(F.sum("n")).first()[0] or 0) / max(1, n * n)


def unit_classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members product_id -> class, classes with head and unit vector); a class is a digest of equal vectors."""
    entries = F.transform("embedding", lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    known = df.select("product_id", entries.alias("v")).withColumn("length", length).where("length > 0 AND length < double('Infinity')")
    digest = F.sha2(F.array_join(F.transform("v", lambda x: x.cast("string")), ","), 256)
    known = stage(known.select("product_id", digest.alias("class"), F.transform("v", lambda x: x / F.col("length")).alias("v")), "neighbour-vectors")
    classes = known.groupBy("class").agg(F.min("product_id").alias("head"), F.first("v").alias("v"))
    return known.select("product_id", "class"), stage(classes, "neighbour-classes")


def nearest_products(df: DataFrame, k: int = 10, pivots: int = PIVOTS, block: int | None = None) -> DataFrame:
    """(product_id, partner_id, similarity, place): the k products of largest cosine for every product; ties by product id.

    A partner's class has less than k classes before it in the order (similarity, first member), and within a class members
    come by id, so the k best classes with their first members hold all partners.
    """
    members, classes = unit_classes(df)
    found, _ = class_neighbours(cells_of(classes, pivots=pivots), k, block)
    heads = classes.select("class", "head")
    numbered = members.withColumn("nth", F.row_number().over(W.partitionBy("class").orderBy("product_id"))).where(F.col("nth") <= k + 1)
    first = numbered.join(heads, "class").select(F.col("head").alias("other"), F.col("product_id").alias("partner_id"))
    near = found.unionByName(heads.select("head", F.col("head").alias("other"), F.lit(1.0).alias("similarity"))).join(first, "other")
    best = W.partitionBy("head").orderBy(F.desc("similarity"), "partner_id")
    few = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).select("head", "partner_id", "similarity")
    own = members.join(heads, "class").select("product_id", "head")
    place = F.row_number().over(W.partitionBy("product_id").orderBy(F.desc("similarity"), "partner_id"))
    ranked = own.join(few, "head").where("product_id <> partner_id")
    return ranked.withColumn("place", place).where(F.col("place") <= k).select("product_id", "partner_id", "similarity", "place")
