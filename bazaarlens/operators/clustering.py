"""Clustered tables: rows laid out along a space-filling curve over several columns, with statistics per file.

Every clustering column (numbers, dates or times) is cut into 2**BITS ranges by quantiles of its rows, from one mergeable
sketch per column, so that skewed values fill the ranges evenly; the bits of the range numbers are interleaved to a place on
the Z-curve. Files are ranges of that
place, rows equal in it are spread by a digest of a further column, so a hot customer or day fills several files. Neighbours on
the curve are near in every column, so a range of either column meets few files.

A table of the least and largest value per file and column is written beside the files. A reader states ranges per column and
opens the files that can hold them; the same filter is applied to the rows read, so results never depend on the layout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators.ranges import search

BITS = 6
ROWS_PER_FILE = 1_000_000


def curve_place(numbers: list[Column], bits: int = BITS) -> Column:
    """Place on the Z-curve: the bits of the numbers taken in turn, highest first."""
    one = lambda c, i: F.shiftright(c.cast("bigint"), i).bitwiseAND(F.lit(1))
    n = len(numbers)
    return reduce(lambda a, b: a + b, [F.shiftleft(one(c, i), i * n + (n - 1 - k)) for i in range(bits) for k, c in enumerate(numbers)])


def on_curve(df: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """Adds `_place`; NULL counts as the highest range."""
    top = 2**bits - 1
    shares = [(i + 1) / (top + 1) for i in range(top)]
    bounds = df.select(F.struct(*(F.percentile_approx(c, shares, 10_000).alias(f"b{k}") for k, c in enumerate(columns)))).scalar()
    range_of = lambda k, c: F.when(F.col(c).isNull(), F.lit(top)).otherwise(F.coalesce(search(F.col(c), F.col(f"_bounds.b{k}"), bits), F.lit(0)))
    numbers = [range_of(k, c).alias(f"_range{k}") for k, c in enumerate(columns)]
    marked = df.withColumn("_bounds", bounds).select("*", *numbers)
    place = curve_place([F.col(f"_range{k}") for k in range(len(columns))], bits)
    return marked.withColumn("_place", place).drop("_bounds", *(f"_range{k}" for k in range(len(columns))))


def write_clustered(df: DataFrame, path: str, columns: list[str], spread: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write `df` clustered by `columns` to `path`/rows and its statistics to `path`/stats; returns the statistics.

    As many files as the row count asks for, all by one shuffle in ranges of the curve.
    """
    files = max(1, -(-df.count() // rows_per_file))
    placed = on_curve(df, columns).withColumn("_spread", F.xxhash64(spread))
    dealt = placed.repartitionByRange(files, "_place", "_spread").sortWithinPartitions("_place", *columns)
    dealt.select(*df.columns).write.mode("overwrite").parquet(f"{path}/rows")
    spark = df.sparkSession
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows")
    name = F.col("_metadata.file_name").alias("file")
    ends = [f(c).alias(f"{k}_{c}") for c in columns for k, f in (("least", F.min), ("most", F.max))]
    missing = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
    rows.groupBy(name).agg(F.count("*").alias("n_rows"), *ends, *missing).write.mode("overwrite").parquet(f"{path}/stats")
    return spark.read.parquet(f"{path}/stats")


def files_within(spark: SparkSession, path: str, wanted: dict[str, tuple]) -> list[str]:
    """Files that can hold rows with every column inside its closed range (None: no end)."""
    stats = spark.read.parquet(f"{path}/stats")
    keep = F.lit(True)
    for c, (low, high) in wanted.items():
        keep &= F.lit(True) if low is None else F.col(f"most_{c}") >= F.lit(low)
        keep &= F.lit(True) if high is None else F.col(f"least_{c}") <= F.lit(high)
    return sorted(r["file"] for r in stats.where(keep).select("file").collect())  # names of files only


def read_clustered(spark: SparkSession, path: str, schema, wanted: dict[str, tuple]) -> DataFrame:
    """Rows with every column inside its closed range, from the files that can hold them."""
    files = files_within(spark, path, wanted)
    rows = spark.read.schema(schema).parquet(*(f"{path}/rows/{f}" for f in files)) if files else spark.createDataFrame([], schema)
    for c, (low, high) in wanted.items():
        rows = rows if low is None else rows.where(F.col(c) >= F.lit(low))
        rows = rows if high is None else rows.where(F.col(c) <= F.lit(high))
    return rows
