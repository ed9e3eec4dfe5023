"""Reading landing files and writing tables, reports and models."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.functions import scalars as S
from bazaarlens.operators.clustering import on_curve

_LOCAL_SCRATCH: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """Shared folder for tables written between stages, from spark.checkpoint.dir.

    Only where the setting is absent and the session is local (tests) a temporary folder is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return f"{named.rstrip('/')}/bazaarlens-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if not _LOCAL_SCRATCH:
        _LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="bazaarlens-"))
    return _LOCAL_SCRATCH[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder of the shared work folder that no other call uses, so that returned tables stay readable."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table to a fresh shared folder and read it back: the lineage ends at the files."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the time of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- readers -----------------------------------------------------------------
def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, timestamps: list[str], multi_line: bool = False) -> DataFrame:
    """Read text columns under an explicit schema; named timestamp columns are parsed safely.

    `multi_line` allows line ends inside quoted fields; files are then read whole, one task each.
    """
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name in timestamps else f.dataType, True) for f in schema.fields])
    df = spark.read.schema(text).option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    return df.withColumns({c: S.safe_timestamp(c) for c in timestamps if c in df.columns})


def read_available(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> tuple[dict[str, DataFrame], DataFrame]:
    """Load the paths that exist; second result lists every table as loaded or missing."""
    loaded, rows = {}, []
    for name, path in paths.items():
        try:
            reader = spark.read.format(fmt)
            loaded[name] = (reader.option("header", True) if fmt == "csv" else reader).load(path)
            rows.append((name, "loaded", len(loaded[name].columns)))
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            rows.append((name, "missing", None))
    status = spark.createDataFrame(rows, "table string, status string, n_columns int")
    counts = [df.agg(F.lit(n).alias("table"), F.count("*").alias("n_rows")) for n, df in loaded.items()]
    if not counts:
        return loaded, status.withColumn("n_rows", F.lit(None).cast("bigint"))
    return loaded, status.join(reduce(DataFrame.unionByName, counts), "table", "left")


def read_landing(spark: SparkSession, path: str, columns: list[str], batch_id: str, at: Column | None = None) -> DataFrame:
    """All-text landing table with ingestion time, source file and batch number."""
    text = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = spark.read.schema(text).option("header", True).csv(path)
    return df.select(
        *columns,
        (F.current_timestamp() if at is None else at).alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
    )


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that each hold one JSON array of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def load_verify(tables: dict[str, DataFrame], minimum: int = 100_000) -> DataFrame:
    """Rows and columns per table, total, and whether the total reaches the volume gate."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()
    ]
    listed = reduce(DataFrame.unionByName, counts)
    total = listed.select(F.sum("n_rows")).scalar()
    return listed.withColumn("total_rows", total).withColumn("meets_minimum", F.col("total_rows") >= minimum)


def table_inventory(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Status table of loaded tables: label, rows, columns, readiness."""
    rows = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.lit(label).alias("label"),
            F.count("*").alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
        )
        for name, (df, label) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows).withColumn("status", F.when(F.col("n_rows") > 0, "ok").otherwise("empty"))


# --- sinks -------------------------------------------------------------------
def write_star(refined, root: str) -> dict[str, str]:
    """Parquet files per refined table; facts are partitioned by purchase month for pruning."""
    paths = {}
    for name in ["dim_customer", "dim_product", "dim_seller", "dim_date", "fact_reviews"]:
        paths[name] = f"{root}/{name}"
        getattr(refined, name).write.mode("overwrite").parquet(paths[name])
    paths["fact_orders"] = f"{root}/fact_orders"
    fact = refined.fact_orders.withColumn("year_month", F.date_format("order_purchase_timestamp", "yyyy-MM"))
    # one shuffle in ranges of (month, place on the curve of day and customer): a hot month becomes several files, each near
    # in both columns, and no task holds many months
    placed = on_curve(fact, ["date_key", "customer_sk"]).withColumn("_spread", F.xxhash64("order_id"))
    dealt = placed.repartitionByRange("year_month", "_place", "_spread").sortWithinPartitions("year_month", "_place")
    dealt.drop("_place", "_spread").write.mode("overwrite").partitionBy("year_month").parquet(paths["fact_orders"])
    return paths


def write_csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS SELECT, with its files in a fresh shared folder; returns the table."""
    spark = df.sparkSession
    df.write.mode("overwrite").format("parquet").option("path", fresh_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def insert_rows(df: DataFrame, rows: DataFrame, path: str) -> None:
    """INSERT: appends rows to the table at `path`, in the columns and types of `df`; only the new rows are written."""
    given = set(rows.columns)
    cast = [F.col(f.name).cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    rows.select(*cast).write.mode("append").parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
