"""Target-distribution importance resampling (11): array-scored weights, ranked by parallel sorting by regular sampling.

Words (runs of a-z, 0-9 and all characters beyond ASCII, after A-Z are lowered) form features, the runs of 1 to `runs`
consecutive words; a feature's bucket is its crc32. A bucket's gain compares its share of the target table's features with its
share of the documents' (both smoothed). The gains are one array of `buckets` numbers, so a document's weight is a sum of
array look-ups in one scan. Fixed noise per id (Gumbel, from a digest) turns the highest scores into a draw without
replacement, and the draw needs exact ranks.

Ranks by regular sampling: the scored table is written as sorted runs (one file each). Every run gives the keys at regular
distances, their order gives the splitters, rows go to the segment between their splitters, and segments are sorted on their
own. The counts before a segment, summed over the small table of segments, are added to the places inside. Only segments that
begin above the cut are exchanged; texts never are. The key is (score falling, doc_id rising, row number), so rows equal in
score and id are told apart and no repeated row can fill a segment.

Bounds: the gains (`buckets` numbers) and at most `SAMPLES` sampled keys come to the driver, whatever the table. More rows make
the distances longer, which only makes segments less even, never a rank wrong.

Defined cases: NULL, empty and wordless texts have no features and weight 0. Rows below `least` words are scored but never
drawn. A NULL id is hashed as the empty text and comes last among equal scores. Repeated rows are ranked one after the other.
Texts of any length are scored whole, batch by batch; memory follows the longest text. Empty tables give an empty result; an
empty target leaves the gains of an all-zero target. Columns besides `doc_id` and `text` are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm import common as C

BUCKETS, RUNS, SEED, LEAST, PERCENT = 10_000, 1, 2024, 20, 10
#: Bound of the sampled keys, and rows that a segment should hold.
SAMPLES, SEGMENT = 1 << 16, 250_000
SLICE_BYTES = 4 << 20

#: Byte by byte: A-Z lowered, every other ASCII character that is no word character a blank.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)]] = 32


def folded(text: pa.Array) -> pa.Array:
    """The texts with words separated by blanks, as described above."""
    data, offsets = C.raw_bytes(text)
    return pa.Array.from_buffers(pa.large_string(), len(text), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(_FOLD[data].tobytes())])


def feature_buckets(text: pa.Array, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, its row, words per row) of a text array without nulls."""
    ids, counts, distinct = C.words(folded(text))
    spelled = [w.as_py() for w in distinct.cast(pa.large_binary())]
    owner = np.repeat(np.arange(len(counts)), counts)
    found, rows = [], []
    for n in range(1, runs + 1):
        start = np.arange(max(0, len(ids) - n + 1))
        start = start[owner[start] == owner[start + n - 1]]
        kinds, which = (np.arange(len(spelled))[:, None], ids[start]) if n == 1 else np.unique(ids[start[:, None] + np.arange(n)], axis=0, return_inverse=True)
        hashed = np.fromiter((zlib.crc32(b" ".join(spelled[i] for i in kind)) % buckets for kind in kinds.tolist()), np.int64, len(kinds))
        found.append(hashed[which.reshape(-1)] if len(start) else np.zeros(0, np.int64))
        rows.append(owner[start])
    return np.concatenate(found), np.concatenate(rows), counts


def bucket_counts(texts: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features per bucket over all texts; every task sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            text = C.as_array(b.column(0))
            for i, j in C.slices(text, SLICE_BYTES):
                found, _, _ = feature_buckets(text.slice(i, j - i), runs, buckets)
                total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths of a natural logarithm: an array of `buckets` whole numbers."""
    ours, theirs = bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets)
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(ours.withColumnRenamed("n", "s"), "bucket", "left").join(theirs.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"])
    sums = Window.partitionBy()  # over `buckets` rows
    smooth = lambda c: (F.sum(c).over(sums) + F.lit(buckets)).cast("double")
    ratio = ((F.col("t") + 1).cast("double") * smooth("s")) / ((F.col("s") + 1).cast("double") * smooth("t"))
    rows = both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    out[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    return out


def weighed(docs: DataFrame, gain: np.ndarray, runs: int = RUNS) -> DataFrame:
    """doc_id, n_words, n_features and weight (the sum of gains over the features) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = C.as_array(b.column(1))
            words, features, weight = (np.zeros(len(text), np.int64) for _ in range(3))
            for i, j in C.slices(text, SLICE_BYTES):
                found, rows, counts = feature_buckets(text.slice(i, j - i), runs, len(gain))
                words[i:j] = counts
                features[i:j] = np.bincount(rows, minlength=j - i)
                np.add.at(weight[i:j], rows, gain[found])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


# --- ranks by regular sampling --------------------------------------------------
KEY = ["down", "missing", "id", "row"]


def sort_keys(columns: list[np.ndarray]) -> np.ndarray:
    """Rows of whole numbers as byte strings that sort in the same order (sign bit turned, big end first)."""
    wide = [(c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8) for c in columns]
    joined = np.ascontiguousarray(np.concatenate(wide, axis=1)) if len(columns[0]) else np.zeros((0, 8 * len(columns)), np.uint8)
    return joined.view(f"S{8 * len(columns)}").reshape(-1)


def keyed(scored: DataFrame) -> DataFrame:
    """Adds the sort key: score falling, ids rising with NULL last, then the row number."""
    return scored.withColumns({"down": -F.col("score"), "missing": F.col("doc_id").isNull().cast("long"), "id": F.coalesce("doc_id", F.lit(0).cast("long"))})


def splitters(runs: DataFrame, n_rows: int, segments: int, samples: int) -> np.ndarray:
    """Keys that cut the eligible rows into segments: regular samples of every sorted run, sorted, taken at regular distances.

    The first place in a run follows from its file name, so that runs shorter than the distance are sampled in proportion.
    """
    distance = max(1, -(-n_rows // samples))
    place = F.pmod(F.col("_metadata.row_index") + F.xxhash64("_metadata.file_path"), F.lit(distance)) == 0
    taken = runs.where(place).where("eligible").select(*KEY).limit(2 * samples).toPandas()
    keys = np.sort(sort_keys([taken[c].to_numpy() for c in KEY]))
    return keys[np.unique((np.arange(1, segments) * len(keys)) // segments)] if len(keys) else keys


def with_segment(rows: DataFrame, cuts: np.ndarray) -> DataFrame:
    """Adds `segment`: how many splitters are not above the row's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = sort_keys([b.column(b.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in KEY])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.searchsorted(cuts, key, side="right").astype(np.int32))], [*b.schema.names, "segment"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("segment", T.IntegerType())]))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST, seed: int = SEED, runs: int = RUNS, buckets: int = BUCKETS, segment: int = SEGMENT, samples: int = SAMPLES) -> DataFrame:
    """Every row's doc_id, n_words, n_features, weight, score and rank: 1, 2, ... for the floor(percent * N / 100) highest
    scores among the N rows with at least `least` words (ties: smaller id), NULL for all others."""
    scored = weighed(docs, gains(docs, target, runs, buckets), runs)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("eligible", F.col("n_words") >= least)
    scored = keyed(scored.withColumn("row", F.monotonically_increasing_id()))
    sorted_runs = C.staged(scored.sortWithinPartitions(*KEY), "resampling-runs")
    known = sorted_runs.agg(F.count("*").alias("n"), F.count_if("eligible").alias("eligible")).first()
    wanted = percent * known["eligible"] // 100
    cuts = splitters(sorted_runs, known["n"], max(1, -(-known["eligible"] // segment)), samples)
    placed = with_segment(sorted_runs, cuts)
    per_segment = placed.where("eligible").groupBy("segment").agg(F.count("*").alias("size"))
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)  # one row per segment
    before = per_segment.select("segment", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    first = [tuple(r) for r in before.where(F.col("before") < wanted).collect()]  # at most as many as sampled keys
    kept = F.col("eligible") & (F.col("segment") <= max((s for s, _ in first), default=-1))
    starts = F.broadcast(docs.sparkSession.createDataFrame(first, "segment int, before long"))
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    inside = F.row_number().over(Window.partitionBy("segment").orderBy(*KEY))
    drawn = placed.where(kept).withColumn("inside", inside).join(starts, "segment").withColumn("rank", F.col("before") + F.col("inside"))
    drawn = drawn.select(*out, F.when(F.col("rank") <= wanted, F.col("rank")).cast("long").alias("rank"))
    return drawn.unionAll(placed.where(~kept).select(*out, F.lit(None).cast("long").alias("rank")))
