"""A store of table statistics: one recorded run after the other, with sketches that can be merged.

A run is a name and a time; it records, per table and column, rows, missing values, least and largest value, a sketch of the
distinct values and one of the quantiles. Each run has a folder of its own, written in one commit: recording it again replaces
it, a failed attempt leaves nothing behind, and runs never touch each other. A run may be recorded in parts (days, files, shards
of a table); parts are merged when they are read: counts are added, sketches united. Drift compares two runs, trends follow a
number over all runs, and neither looks at the tables again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.functions import scalars as S

COLUMNS = (
    "at timestamp_ntz, table_name string, column_name string, column_type string, n_rows bigint, n_nulls bigint, least string, largest string, "
    "distinct_sketch binary, quantile_sketch binary"
)
LG_K = 12  # 4,096 registers a column


def profile(name: str, df: DataFrame) -> DataFrame:
    """One row per column, from one pass over the table."""
    aggs, rows = [F.count("*").alias("n_rows")], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        number = isinstance(f.dataType, T.NumericType)
        plain = number or isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
        text = c.cast("string") if plain else F.to_json(F.struct(c))
        aggs += [
            F.count_if(c.isNull()).alias(f"nulls{i}"),
            (F.min(c) if plain else F.min(text)).cast("string").alias(f"least{i}"),
            (F.max(c) if plain else F.max(text)).cast("string").alias(f"largest{i}"),
            F.hll_sketch_agg(text, LG_K).alias(f"distinct{i}"),
            (F.kll_sketch_agg_double(c.cast("double")) if number else F.lit(None).cast("binary")).alias(f"quantiles{i}"),
        ]
        about = {"table_name": F.lit(name), "column_name": F.lit(f.name), "column_type": F.lit(f.dataType.simpleString()), "n_rows": F.col("n_rows"),
                 "n_nulls": F.col(f"nulls{i}"), "least": F.col(f"least{i}"), "largest": F.col(f"largest{i}"),
                 "distinct_sketch": F.col(f"distinct{i}"), "quantile_sketch": F.col(f"quantiles{i}")}
        rows.append(F.struct(*(v.alias(k) for k, v in about.items())))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


class StatsStore:
    """Recorded runs under `path`."""

    def __init__(self, path: str) -> None:
        self.path = path

    def record(self, run_id: str, at: Column, tables: dict[str, DataFrame], part: str = "all") -> None:
        """Record a run, or one part of it; the same run and part again replaces what is there."""
        found = reduce(DataFrame.unionByName, [profile(n, df) for n, df in tables.items()])
        names = [f.name for f in T.StructType.fromDDL(COLUMNS).fields]
        found.withColumn("at", at.cast("timestamp_ntz")).select(*names).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={run_id}/part={part}")

    def rows(self, spark: SparkSession) -> DataFrame:
        schema = f"{COLUMNS}, run string, part string"
        try:
            return spark.read.schema(schema).option("basePath", self.path).parquet(self.path)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return spark.createDataFrame([], schema)

    def runs(self, spark: SparkSession) -> DataFrame:
        """One row per run, table and column, merged over parts."""
        by = self.rows(spark).groupBy("run", "table_name", "column_name")
        return by.agg(
            F.max("at").alias("at"), F.max("column_type").alias("column_type"), F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
            F.kll_merge_agg_double("quantile_sketch").alias("quantiles"),
        )

    def drift(self, spark: SparkSession, before: str, now: str) -> DataFrame:
        """Columns of two runs side by side, with what changed."""
        both = self.runs(spark)
        side = lambda run, tag: both.where(F.col("run") == run).select("table_name", "column_name", *(F.col(c).alias(f"{c}_{tag}") for c in ("column_type", "n_rows", "n_nulls", "n_distinct")))
        a, b = side(before, "before"), side(now, "now")
        share = lambda tag: S.ratio(f"n_nulls_{tag}", f"n_rows_{tag}", 4)
        change = (
            F.when(F.col("column_type_before").isNull(), "added")
            .when(F.col("column_type_now").isNull(), "removed")
            .when(F.col("column_type_before") != F.col("column_type_now"), "type_changed")
            .when(share("before") != share("now"), "nulls_changed")
            .when(F.col("n_rows_before") != F.col("n_rows_now"), "rows_changed")
            .otherwise("same")
        )
        return a.join(b, ["table_name", "column_name"], "full").withColumns({"null_share_before": share("before"), "null_share_now": share("now"), "drift": change})

    def trend(self, spark: SparkSession) -> DataFrame:
        """Completeness per run and table, with the change against the run before."""
        scores = self.runs(spark).groupBy("run", "table_name").agg(F.max("at").alias("at"), F.max("n_rows").alias("n_rows"), S.ratio(F.sum(F.col("n_rows") - F.col("n_nulls")), F.sum("n_rows"), 4).alias("score"))
        before = F.lag("score").over(W.partitionBy("table_name").orderBy("at", "run"))  # one row per run
        return scores.withColumn("score_before", before).withColumn("change", (F.col("score") - F.col("score_before")).cast("decimal(18,4)"))
