"""Global order without a one-task window: running totals and exact quantiles over value ranges.

A window without PARTITION BY moves every row to one task. Here the key space is cut into as many
ranges as the row count asks for (about `ROWS_PER_RANGE` rows each), by bounds taken from a sample of
keys. The sample holds the keys whose digest falls below a threshold: one pass, the same on every
cluster, and samples of parts of a table together are the sample of the whole. `PER_RANGE` sampled
keys make a range, so sizes scatter by a quarter around their mean and none comes near four times it.
The bounds only balance the work; they never change a result. Range totals are a small table, one
row per range, so only that table needs a global order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ROWS_PER_RANGE = 100_000
PER_RANGE = 16
#: Steps of the search among bounds: 2**20 ranges of 100,000 rows are 10**11 rows; beyond, ranges grow.
STEPS = 20


def _key_struct(keys: list[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def _place(key: Column, bounds: Column, low: int, high: int) -> Column:
    """Number of bounds <= key by binary search; `get` beyond the last bound is NULL and goes left."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    right = key >= F.get(bounds, F.lit(middle))
    return F.when(right, _place(key, bounds, middle + 1, high)).otherwise(_place(key, bounds, low, middle))


def search(key: Column, bounds: Column, steps: int = STEPS) -> Column:
    """Number of bounds <= key, of at most 2**steps - 1 bounds, halving the step each time."""
    steps = F.array(*(F.lit(2**k) for k in reversed(range(steps))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(key >= F.get(bounds, at + step - 1), at + step).otherwise(at))


def key_bounds(df: DataFrame, key: Column, rows_per_range: int) -> DataFrame:
    """One row with the sorted bounds of ranges of about `rows_per_range` rows; lazily, in one pass over the keys."""
    known = df.select(key.alias("s")).where(F.col("s").isNotNull())
    n = known.select(F.greatest(F.count("*"), F.lit(1))).scalar()
    wanted = F.least(F.ceil(n / F.lit(rows_per_range)), F.lit(2**STEPS - 1)) * PER_RANGE
    sample = known.where(F.pmod(F.xxhash64("s"), F.lit(1 << 40)) < wanted / n * F.lit(float(1 << 40)))
    every = lambda _, i: i % PER_RANGE == PER_RANGE - 1
    return sample.select(F.filter(F.array_sort(F.collect_list("s")), every).alias("b"))


def with_range(df: DataFrame, keys: list[str], ranges: int | None = None, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add `_range`, a number that grows with the key, by comparing with sampled bounds.

    Without `ranges`, as many as the row count asks for; with it, just about so many.
    """
    key = F.col(keys[0]) if len(keys) == 1 else _key_struct(keys)
    if ranges is None:
        bounds, placed, last = key_bounds(df, key, rows_per_range), search(key, F.col("_bounds")), 2**STEPS
    else:
        sample = df.select(key.alias("s")).orderBy(F.xxhash64("s"), "s").limit(ranges * PER_RANGE)
        every = lambda _, i: i % PER_RANGE == PER_RANGE - 1
        bounds = sample.select(F.filter(F.array_sort(F.collect_list("s")), every).alias("b"))
        placed, last = _place(key, F.col("_bounds"), 0, ranges), ranges
    placed = F.when(key.isNull(), F.lit(last)).otherwise(placed)
    return df.withColumn("_bounds", bounds.scalar()).withColumn("_range", placed).drop("_bounds")


def running_total(
    df: DataFrame, keys: list[str], weight: Column | None = None, name: str = "before", ranges: int | None = None
) -> DataFrame:
    """Add `name`: the sum of `weight` (default 1 per row) over all rows with a smaller key.

    Keys must be unique; use a table already grouped by key for repeated values.
    """
    weight = F.lit(1) if weight is None else weight
    cut = with_range(df.withColumn("_w", weight.cast("bigint")), keys, ranges)
    totals = cut.groupBy("_range").agg(F.sum("_w").alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_range").orderBy(*[F.col(k).asc_nulls_last() for k in keys]).rowsBetween(W.unboundedPreceding, -1)
    # one row per range, at most 2**STEPS + 1 of them: a proven size bound for the broadcast
    return (
        cut.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.coalesce(F.sum("_w").over(inside), F.lit(0)) + F.col("_offset"))
        .drop("_range", "_offset", "_w")
    )


def surrogate_key(df: DataFrame, name: str, keys: list[str], ranges: int | None = None) -> DataFrame:
    """Dense key 1..n in the order of unique natural keys, as the first column."""
    ranked = running_total(df, keys, name=name, ranges=ranges)
    return ranked.select((F.col(name) + 1).cast("bigint").alias(name), *df.columns)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def exact_quantiles(df: DataFrame, column: str, probs: dict[str, float], ranges: int | None = None) -> DataFrame:
    """One row with linearly interpolated quantiles of `column` (NULL ignored), one column per name.

    Values are counted first, so repeated values cost one row, and no task sees the whole column.
    """
    hist = value_counts(df.select(F.col(column).cast("double").alias("v")), "v")
    total = hist.select(F.sum("n")).scalar()
    placed = running_total(hist, ["v"], F.col("n"), "lo", ranges).withColumn("hi", F.col("lo") + F.col("n") - 1)
    aggs = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("total") - 1)
        at = lambda r: F.max(F.when((F.col("lo") <= r) & (F.col("hi") >= r), F.col("v")))
        aggs += [at(F.floor(pos)).alias(f"{name}_0"), at(F.ceil(pos)).alias(f"{name}_1")]
    row = placed.withColumn("total", total).agg(F.max("total").alias("total"), *aggs)
    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("total") - 1)
        low, high = F.col(f"{name}_0"), F.col(f"{name}_1")
        out.append((low + (high - low) * (pos - F.floor(pos))).alias(name))
    return row.select(*out)


def percent_ranks(df: DataFrame, specs: dict[str, tuple[str, bool]]) -> DataFrame:
    """Add percent_rank columns `{name: (column, descending)}`; NULL is the highest value.

    rank - 1 is the number of rows with a smaller value, read from the value histogram, so equal
    values share one histogram row and no global window over the rows is needed.
    """
    n_rows = df.select(F.count("*")).scalar()
    out = df.withColumn("_rows", n_rows)
    for name, (column, descending) in specs.items():
        value = F.col(column).cast("double")
        hist = df.groupBy(F.coalesce(value, F.lit(float("inf"))).alias("_v")).agg(F.count("*").alias("_c"))
        placed = running_total(hist, ["_v"], F.col("_c"), "_lo")
        below = placed.select(F.col("_v"), F.col("_lo").alias(f"_lo_{name}"), F.col("_c").alias(f"_c_{name}"))
        smaller = F.col(f"_lo_{name}")
        if descending:
            smaller = F.col("_rows") - smaller - F.col(f"_c_{name}")
        rank = F.when(F.col("_rows") > 1, smaller / (F.col("_rows") - 1)).otherwise(F.lit(0.0))
        out = (
            out.withColumn("_v", F.coalesce(F.col(column).cast("double"), F.lit(float("inf"))))
            .join(below, "_v")
            .withColumn(name, rank)
            .drop("_v", f"_lo_{name}", f"_c_{name}")
        )
    return out.drop("_rows")
