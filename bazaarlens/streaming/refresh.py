"""Micro-batch refresh of a trusted table from landing files.

Each batch cleans its new rows, merges them by key into the current version and writes the next
version; readers always see one whole version. The result equals one batch run over all files.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators import cleaning as C
from bazaarlens.sources import io

BUCKETS = 64


def landing_stream(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


class Upsert:
    """foreachBatch target: keeps the best row per key in hash buckets of a Parquet table.

    Only buckets that hold a key of the batch are read and rewritten. A batch of many keys touches all
    of the 64 buckets and then costs as much as the table; `views` keeps tables by date parts instead. Batch n writes its buckets to its own folder and lists them in an index
    table. State lives in the files alone: a restarted driver reads the index, and a repeated batch
    sees only older batches and overwrites its own folder.
    """

    def __init__(self, root: str, clean, keys: list[str], order):
        self.root, self.clean, self.keys, self.order = root, clean, keys, order

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def current(self, spark: SparkSession, before: int | None = None) -> dict[int, str]:
        """Folder of the newest version per bucket; at most BUCKETS entries."""
        try:
            index = spark.read.schema("bucket int, batch bigint").parquet(f"{self.root}/index")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return {}
        if before is not None:
            index = index.where(F.col("batch") < before)
        newest = index.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()
        return {r["bucket"]: f"{self.root}/data/batch={r['batch']}/_bucket={r['bucket']}" for r in newest}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = self.clean(batch).withColumn("_bucket", self.bucket())
        touched = [r[0] for r in new.select("_bucket").distinct().collect()]  # at most BUCKETS values
        if not touched:
            return
        known = self.current(spark, before=batch_id)
        old_paths = [known[b] for b in touched if b in known]
        merged = new
        if old_paths:
            old = spark.read.schema(new.drop("_bucket").schema).parquet(*old_paths)
            merged = new.unionByName(old.withColumn("_bucket", self.bucket()))
        best = C.first_per_key(merged, self.keys, self.order(merged.drop("_bucket")))
        best.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/data/batch={batch_id}")
        rows = spark.createDataFrame([(b,) for b in touched], "bucket int")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/index/batch={batch_id}")

    def table(self, spark: SparkSession, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(*self.current(spark).values())


def run_refresh(stream: DataFrame, sink: Upsert, checkpoint: str, every: str | None = None) -> None:
    """`every` (for example "5 minutes") keeps the query running; None drains what has landed."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    writer.start().awaitTermination()


def refresh_orders(m) -> DataFrame:
    """Land the raw orders in files, drain them as a stream, return the refreshed trusted table."""
    root = f"{io.work_dir(m.spark)}/refresh-{uuid.uuid4().hex}"
    m.landing_orders.repartition(4, "order_id").write.parquet(f"{root}/landing")
    order = lambda df: C.total_order(df, F.col("order_purchase_timestamp").desc_nulls_first())
    sink = Upsert(f"{root}/table", C.trusted_orders, ["order_id"], order)
    stream = landing_stream(m.spark, f"{root}/landing", m.landing_orders.schema, max_files=2)
    run_refresh(stream, sink, f"{root}/checkpoint")
    return sink.table(m.spark, C.trusted_orders(m.landing_orders).schema)
