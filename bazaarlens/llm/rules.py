"""Quality rules (4), DataFrame functions only: cutoffs chosen on labelled rows under a guaranteed false-rejection risk.

Each rule has a measure that is higher for worse texts (shares of symbols, repeated lines, repeated words and capitals;
mean word length) and a grid of cutoffs from loose to strict. On the labelled good rows of a stratum (a language), a cutoff
is admissible if its chance to reject a good row is proven below `risk / number of rules`: the exact binomial probability of
seeing so few rejections must not exceed `error / (strata * rules)`. Cutoffs are tried from loose to strict and the walk
ends at the first that fails, so the walk itself needs no further correction; the division by strata and rules corrects for
testing them all. A stratum with too few labelled rows gets no cutoffs, and its rows are judged by the base rule alone.

The measures take one scan and are written once (numbers only). Holdout counts are grouped by (stratum, rule, level), at
most strata * rules * grid rows; the cutoffs are one row per stratum.

Within a text, three-word windows are compared by 64-bit hashes: they are sorted with their positions packed into the low
bits, and neighbours count as equal only if their full hashes agree.

Defined cases: NULL texts have no words; they and all texts under 50 words fail the base rule. A NULL language is a stratum
of its own. Repeated rows are judged alike; an id with both labels counts as good. Texts
of any length are measured whole; an empty table gives an empty result, empty labels no cutoffs. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm import common as C

RISK, ERROR = 0.05, 0.05
RULES = {
    "symbol_share": [0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.015, 0.01],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1],
    "repeat_share": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06],
    "upper_share": [0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1],
    "mean_word": [40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0],
}
BLANK_CHARS = " \t\n\x0b\x0c\r"


def repeated_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words from `_words`: words inside three-word windows that occur twice or more.

    Every array gets a projection of its own and is used more than once in the next, so the planner evaluates it once a row.
    """
    n = F.col("n_words")
    low = F.when(n <= 1 << 10, F.lit((1 << 10) - 1)).when(n <= 1 << 16, F.lit((1 << 16) - 1)).otherwise(F.lit((1 << 31) - 1)).cast("long")
    own, top = F.col("_low"), lambda v: v.bitwiseAND(F.bitwise_not(F.col("_low")))
    step = docs.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w))).withColumn("_low", low)
    places = F.when(n >= 3, F.sequence(F.lit(0), (n - 3).cast("int"))).otherwise(F.array().cast("array<int>"))
    step = step.withColumn("_windows", F.transform(places, lambda i: F.xxhash64(F.get("_hash", i), F.get("_hash", i + 1), F.get("_hash", i + 2))))
    step = step.withColumn("_sorted", F.sort_array(F.transform("_windows", lambda w, i: top(w).bitwiseOR(i.cast("long")))))

    def same(v: Column, other: Column) -> Column:
        window = lambda x: F.get("_windows", x.bitwiseAND(own).cast("int"))
        return (top(v) == top(other)) & (window(v) == window(other))

    twin = lambda v, j: F.coalesce(same(v, F.get("_sorted", j + 1)), F.lit(False)) | F.coalesce(same(v, F.get("_sorted", j - 1)), F.lit(False))
    step = step.withColumn("_twins", F.sort_array(F.transform(F.filter("_sorted", twin), lambda v: v.bitwiseAND(own))))
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum"))
    grow = lambda s, x: F.struct((x + 3).alias("end"), (s["sum"] + F.least(F.lit(3).cast("long"), x + 3 - s["end"])).alias("sum"))
    covered = F.aggregate("_twins", start, grow, lambda s: s["sum"])
    return step.withColumn("n_repeat_words", covered).drop("_hash", "_low", "_windows", "_sorted", "_twins")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, the base counts and the five measures of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(BLANK_CHARS))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    only = lambda kept: F.length(F.regexp_replace(text, kept, "")).cast("long")
    step = docs.select("doc_id", F.col("lang").cast("string").alias("stratum"), text.alias("_text"), F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, C.BLANKS)).alias("_words"), lines.alias("_lines"))
    text = F.col("_text")
    step = step.select(
        "doc_id",
        "stratum",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda s, w: s + F.length(w)).alias("word_chars"),
        only(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").alias("_n_lines"),
        only(r"[^\p{Lu}]+").alias("_n_upper"),
    )
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)).cast("double")
    return repeated_words(step).select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "_n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("_n_upper", "word_chars").alias("upper_share"),
        share("word_chars", "n_words").alias("mean_word"),
    )


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1, by Stirling's series eight steps up."""
    y = x + 8
    series = (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    for i in range(8):
        series = series - F.ln(x + i)
    return series


def binomial_at_most(k: Column, n: Column, p: float, terms: int = 400) -> Column:
    """P(X <= k) for X ~ Binomial(n, p): 1 where k >= n * p; else exact up to a remainder that is bounded from above."""
    k, n = k.cast("double"), n.cast("double")
    top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    ratio = lambda t: (k - t) * (1 - p) / ((n - k + t + 1) * p)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(s: Column, t: Column) -> Column:
        term = s["term"] * ratio(t)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    steps = F.when(k >= 1, F.sequence(F.lit(0), F.least(k, F.lit(float(terms))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    rest = lambda s: s["sum"] + F.when(k > terms, s["term"] * ratio(F.lit(terms)) / (1 - ratio(F.lit(terms)))).otherwise(F.lit(0.0))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * F.aggregate(steps, start, add, rest)))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum: the strictest proven cutoff of every rule, NULL where none is proven."""
    good = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = measured.join(good, "doc_id")
    level = lambda name: F.size(F.filter(F.array(*(F.lit(c) for c in RULES[name])), lambda c: F.col(name) > c))
    long = held.select("stratum", F.inline(F.array(*(F.struct(F.lit(r).alias("rule"), level(r).alias("level")) for r in RULES))))
    counted = long.groupBy("stratum", "rule", "level").agg(F.count("*").alias("rows"))
    n_good = counted.groupBy("stratum", "rule").agg(F.sum("rows").alias("n"))
    # the loosest cutoff rejects only the rows that exceed all of them, the strictest those that exceed any
    grid = measured.sparkSession.createDataFrame([(r, i + 1, len(cs) - i, c) for r, cs in RULES.items() for i, c in enumerate(cs)], "rule string, number int, least int, cutoff double")
    tried = n_good.join(F.broadcast(grid), "rule")
    met = tried.alias("t").join(
        counted.alias("c"),
        F.col("t.stratum").eqNullSafe(F.col("c.stratum")) & (F.col("t.rule") == F.col("c.rule")) & (F.col("c.level") >= F.col("t.least")),
        "left",
    )
    rejected = met.groupBy("t.stratum", "t.rule", "t.number", "t.cutoff", "t.n").agg(F.coalesce(F.sum("c.rows"), F.lit(0)).alias("k"))
    tests = max(1, n_good.count())
    proven = rejected.withColumn("p", binomial_at_most(F.col("k"), F.col("n"), risk / len(RULES)))
    so_far = Window.partitionBy("stratum", "rule").orderBy("number")
    passed = proven.withColumn("ok", F.min(F.col("p") <= error / tests).over(so_far)).where("ok")
    return passed.groupBy("stratum").agg(*(F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES))


def verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Measures of every row with base_failed and kept."""
    measured = C.staged(measures(docs), "measures")
    cuts = C.staged(cutoffs(measured, labels, risk, error), "cutoffs").withColumnRenamed("stratum", "_stratum")
    few = cuts.count() <= 10_000  # one small row per language; more are joined by a shuffle
    joined = measured.join(F.broadcast(cuts) if few else cuts, F.col("stratum").eqNullSafe(F.col("_stratum")), "left").drop("_stratum")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    return joined.withColumn("base_failed", base).withColumn("kept", ~base & ~rejected)
