"""Extraction as a job that can be stopped and continued: answer log, paced calls, growing pauses after errors.

Answers are kept in a log, a Parquet table keyed by a digest of title and description. A run asks only for texts without an
answer in the log (anti join), each text once however many products have it, in waves of a bounded number of texts; a wave's
answers are appended in one commit, so a run that is stopped loses at most the wave it was in. Calls are spread over a fixed
number of lanes, one task each; a lane waits so long between calls that all lanes together keep the agreed rate, whether or
not they run at once. Errors of a service are met with pauses that grow by a power of the attempt.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.sources.io import stage

LOG = "digest string, extraction_status string, attempts int, answer string, input_tokens bigint, output_tokens bigint, wave bigint"
WAVE_ROWS = 50_000


class RateLimited(Exception):
    """The service asks for fewer calls."""


class TimedOut(Exception):
    """The service did not answer in time."""


class ServiceFault(Exception):
    """The service failed for another reason that may pass."""


@dataclass(frozen=True)
class Policy:
    """Calls a second over all lanes (None: no limit), tries per text, and the base of the pauses in seconds."""

    rate: float | None = None
    retries: int = 3
    base: float = 2.0
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep

    def pause(self, error: Exception, attempt: int) -> float | None:
        """Seconds to wait after the failed `attempt` (1, 2, ...); None: do not try again."""
        if isinstance(error, (RateLimited, TimedOut)):
            return self.base**attempt
        if isinstance(error, ServiceFault):
            return self.base if attempt < self.retries else None
        return 0.0 if isinstance(error, json.JSONDecodeError) and attempt < self.retries else None


class Lane:
    """Calls of one task: no two closer together than the lane's share of the rate allows."""

    def __init__(self, extractor: Callable[[str, str], str], policy: Policy, lanes: int) -> None:
        self.extractor, self.policy = extractor, policy
        self.gap = lanes / policy.rate if policy.rate else 0.0
        self.next = policy.clock()

    def call(self, title: str, description: str) -> str:
        now = self.policy.clock()
        if now < self.next:
            self.policy.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap
        return self.extractor(title, description)

    def ask(self, title: str, description: str) -> tuple[str, int, str | None]:
        """(status, tries, answer): an answer is a JSON text."""
        for attempt in range(1, self.policy.retries + 1):
            try:
                answer = self.call(title, description)
                json.loads(answer)
                return "SUCCESS", attempt, answer
            except Exception as error:  # noqa: BLE001 - any failure of the caller's function ends in a status
                pause = self.policy.pause(error, attempt)
                if pause is None:
                    return "FAILED", attempt, None
                if pause:
                    self.policy.sleep(pause)
        return "FAILED", self.policy.retries, None


def digest(title: Column, description: Column) -> Column:
    """NULL counts as empty; lengths keep title and description apart."""
    t, d = (F.coalesce(c, F.lit("")) for c in (title, description))
    return F.sha2(F.concat(F.length(t).cast("string"), F.lit(":"), t, d), 256)


class ExtractionJob:
    """Answers of `extractor` for texts, kept under `path`."""

    def __init__(self, path: str, extractor: Callable[[str, str], str], policy: Policy = Policy(), lanes: int | None = None, wave_rows: int = WAVE_ROWS) -> None:
        self.path, self.extractor, self.policy, self.lanes, self.wave_rows = path, extractor, policy, lanes, wave_rows

    def log(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(LOG).parquet(self.path)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return spark.createDataFrame([], LOG)

    def pending(self, texts: DataFrame) -> DataFrame:
        """Distinct texts without an answer; failed ones are asked again."""
        answered = self.log(texts.sparkSession).where("extraction_status = 'SUCCESS'").select("digest")
        asked = texts.select(digest(F.col("title"), F.col("description")).alias("digest"), "title", "description")
        left = asked.join(answered, "digest", "left_anti")
        return left.groupBy("digest").agg(F.first("title").alias("title"), F.first("description").alias("description"))

    def run(self, texts: DataFrame, max_waves: int | None = None) -> int:
        """Ask for what is pending; returns the number of waves. `max_waves` stops early, as a lost driver would."""
        spark = texts.sparkSession
        lanes = self.lanes or spark.sparkContext.defaultParallelism
        extractor, policy = self.extractor, self.policy

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            lane = Lane(extractor, policy, lanes)
            for pdf in batches:
                title, text = pdf["title"].fillna(""), pdf["description"].fillna("")
                out = pd.DataFrame([lane.ask(a, b) for a, b in zip(title, text, strict=True)], columns=["extraction_status", "attempts", "answer"])
                out["digest"], out["wave"] = pdf["digest"].to_numpy(), pdf["wave"].to_numpy()
                out["input_tokens"] = ((title.str.len() + text.str.len()) // 4).to_numpy()
                out["output_tokens"] = out["answer"].fillna("").str.len() // 4
                yield out[["digest", "extraction_status", "attempts", "answer", "input_tokens", "output_tokens", "wave"]]

        # written once: the texts are joined and grouped once a run, not again for the count and for every wave
        waiting = stage(self.pending(texts), "waiting-texts")
        n = waiting.count()
        waves = -(-n // self.wave_rows)
        first = self.log(spark).agg(F.max("wave")).first()[0]
        first = 0 if first is None else first + 1
        number = F.pmod(F.xxhash64("digest"), F.lit(max(1, waves)))
        done = 0
        for w in range(waves if max_waves is None else min(waves, max_waves)):
            # answered texts leave `waiting` only at the next run, so a wave is one slice of the same digests
            slice_ = waiting.where(number == w).withColumn("wave", F.lit(first + w).cast("bigint"))
            slice_.repartition(lanes, "digest").mapInPandas(ask, LOG).write.mode("append").parquet(self.path)
            done += 1
        return done

    def answers(self, texts: DataFrame) -> DataFrame:
        """Every product with the answer to its text; the newest if one was asked for again."""
        entry = F.struct((F.col("extraction_status") == "SUCCESS").alias("ok"), "wave", "extraction_status", "attempts", "answer", "input_tokens", "output_tokens")
        newest = self.log(texts.sparkSession).groupBy("digest").agg(F.max(entry).alias("v")).select("digest", "v.extraction_status", "v.attempts", "v.answer", "v.input_tokens", "v.output_tokens")
        keyed = texts.select("product_id", "title", digest(F.col("title"), F.col("description")).alias("digest"))
        return keyed.join(newest, "digest").drop("digest")
