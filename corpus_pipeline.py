"""A corpus pipeline over `documents`: toxicity, near duplicates, benchmark decontamination, personal data, source mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's `docs`. Stages before the last return the columns of `documents`; the last returns the mix itself, every document as
often as it is taken, with its copy number.

Defined cases, for all stages: an empty table stays empty; rows with NULL in any column pass like others (a NULL text is neither
toxic nor a copy, holds no benchmark item and no personal data, and counts no words); texts of any length are read whole;
repeated rows are judged alike, and of those with words one stays after the second stage. Further columns are kept, unless they
are named `__row`, `__mark`, `__new` or `copy`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import common as C
from bazaarlens.llm import decontamination, jaccard, mixing, surrogates, toxicity

#: Near-duplicate stage: five-word shingles, similarity of 80 per cent or more.
SHINGLE, SHARE = 5, 80
#: Score from which a document is rejected as toxic.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the network, fitted on all labelled rows' bounded sample, scores 0.5 or more."""
    net = toxicity.train(docs, C.table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(docs, net, "_toxic").where(F.col("_toxic") < TOXIC).drop("_toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of near duplicates: the one with the smallest id (rows without an id last, then the first
    row). Rows are told apart by a number of their own, so an id that stands on unrelated texts loses neither, and near copies
    without an id are one group like all others. Documents without words, NULL texts among them, are no copies and stay.
    """
    numbered = C.staged(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    groups = jaccard.near_components(numbered.select(F.col("__row").alias("doc_id"), "text"), SHARE, SHINGLE)
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "__row")
    placed = groups.select(F.col("doc_id").alias("__row"), "component_id").join(numbered.select("__row", "doc_id"), "__row")
    kept = placed.groupBy("component_id").agg(F.min(rank).alias("best")).select(F.col("best.__row").alias("__row"))
    return numbered.join(kept, "__row", "left_semi").select(*docs.columns)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, C.table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces entities; n_chars follows the new text."""
    return surrogates.replaced(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
]

#: SQL cannot express the trained network; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
