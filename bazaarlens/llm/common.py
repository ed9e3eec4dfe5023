"""Helpers shared by the operators: shared-folder tables, training splits, and Arrow text turned into numpy arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for local sessions without that setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="llm-"))
    return _LOCAL[0]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to a fresh shared folder and read it back; the lineage ends at the files."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (NULL id: NULL)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: tuple[int, int], max_chars: int) -> DataFrame:
    """(text, _y) in a fixed order, in one partition: at most `per_class` texts with label 0 and with label 1, picked by a hash of the id among the rows where `learn` holds.

    This bounded sample (rows, and texts up to `max_chars`) is the only thing a classifier is fitted on.
    An id that carries both labels counts as 1; NULL labels and ids are left out.
    """
    known = (
        labels.where(learn & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(label).cast("int").alias("_y"))
    )
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = [known.where(F.col("_y") == k).orderBy(*order).limit(n) for k, n in enumerate(per_class)]
    chosen = picked[0].unionAll(picked[1])
    return (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .select("_id", "text", "_y")
        .orderBy(*order, "text")
        .limit(sum(per_class))
        .select("text", "_y")
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: tuple[int, int], max_chars: int) -> list[tuple[str, int]]:
    """The rows of `sample_rows` on the driver."""
    return [(r["text"], r["_y"]) for r in sample_rows(docs, labels, label, learn, per_class, max_chars).collect()]


# --- Arrow text as numpy ------------------------------------------------------
def slices(text: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes each; a row is never divided."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def as_array(column) -> pa.Array:
    """One string array without nulls (NULL counts as empty)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the row offsets into them."""
    buffers = text.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word number of every token, tokens per row, distinct words) of a text array without nulls."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(text))
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    flat = lists.flatten()
    keep = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not keep.all():  # blank rows give one empty word
        rows = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(rows[keep], minlength=len(counts))
        flat = flat.filter(pa.array(keep))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), counts, coded.dictionary


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (multiply, shift, xor)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def hash_rows(text: pa.Array) -> np.ndarray:
    """64-bit hash of every row of a string array, from its bytes."""
    data, offsets = raw_bytes(text)
    lengths = np.diff(offsets)
    out = np.zeros(len(lengths), np.uint64)
    if not len(data):
        return out
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    powers = np.full(int(lengths.max()), 0x100000001B3, np.uint64).cumprod()
    full = lengths > 0
    out[full] = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[place], offsets[:-1][full])
    return mix64(out)
