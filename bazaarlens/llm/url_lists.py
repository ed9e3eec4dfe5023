"""URL filters (9), DataFrame functions only: dated list entries as validity intervals, joined as of the fetch time.

A list log has rows (kind, pattern, action, at, category): kind `domain` holds for a host and everything under it, kind
`prefix` for a host and path up to a path segment; action `add` or `remove`; `at` in epoch seconds. The entry in force at a
time is the latest one not after it; of entries of one second, removals count last. So an `add` is valid from its time to
the next entry of its pattern.

A capture meets every pattern that can cover it: the suffixes of its host and the path prefixes of its URL, as deep as the
deepest pattern of the log, so that a URL of many thousand steps costs no more than the list asks for. Intervals are cut
at the ends of periods of `PERIOD` seconds and joined on (kind, pattern, period), so a pattern with a long history, or a host
with a third of all captures, meets a few rows per capture, and Spark may split a hot side. Of the intervals that hold, the
longest pattern decides.

Defined cases: URLs that are NULL or have no host match nothing; NULL fetch times match nothing; log rows with NULLs in
pattern, action or time are left out; repeated log rows count once; repeated captures are judged alike. An empty log blocks
nothing, an empty table of captures gives an empty result, URLs of any length are judged whole. Extra columns of
captures are kept; of the log they are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 30 * 86_400
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def pattern_key(kind: Column, pattern: Column) -> Column:
    """Lower-case domain without leading wildcard and closing dot; prefix with lower-case host, without scheme and closing slash."""
    domain = F.rtrim(F.regexp_replace(F.lower(pattern), r"^\*?\.", ""), F.lit("."))
    bare = F.regexp_replace(pattern, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    prefix = F.concat(F.lower(F.substring_index(bare, "/", 1)), F.rtrim(F.regexp_replace(bare, "^[^/]*", ""), F.lit("/")))
    return F.when(kind == "domain", domain).when(kind == "prefix", prefix)


def intervals(log: DataFrame) -> DataFrame:
    """(kind, key, category, since, until): when every added pattern is in force; `until` is NULL for an open end."""
    entries = (
        log.select("kind", pattern_key(F.col("kind"), F.col("pattern")).alias("key"), "action", F.col("at").cast("long").alias("at"), "category")
        .where("key <> '' AND action IN ('add', 'remove') AND at IS NOT NULL")
        .distinct()
        .withColumn("period", F.floor(F.col("at") / PERIOD))
    )
    # the next entry within the period, else the first entry of the next period that has one
    inside = Window.partitionBy("kind", "key", "period").orderBy("at", "action", "category")
    firsts = entries.groupBy("kind", "key", "period").agg(F.min("at").alias("first"))
    later = firsts.withColumn("following", F.lead("first").over(Window.partitionBy("kind", "key").orderBy("period"))).drop("first")
    chained = entries.withColumn("next", F.lead("at").over(inside)).join(later, ["kind", "key", "period"])
    until = F.coalesce("next", "following")
    return (
        chained.where("action = 'add'")
        .select("kind", "key", "category", F.col("at").alias("since"), until.alias("until"))
        .where("until IS NULL OR until > since")
    )


def keys_of(url: Column, most_labels: int, most_steps: int) -> Column:
    """Every (kind, key) of at most so many host labels, or path steps with the host, that can cover a URL."""
    host, path = host_of(url), path_of(url)
    labels, steps = F.split(host, r"\."), F.split(F.rtrim(path, F.lit("/")), "/")
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - most_labels + 1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.size(steps), F.lit(max(1, most_steps)))), lambda i: F.concat(host, F.array_join(F.slice(steps, F.lit(1), i), "/")))
    entry = lambda kind: lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key"))
    both = F.concat(F.transform(suffixes, entry("domain")), F.transform(prefixes, entry("prefix")))
    return F.when(F.coalesce(host, F.lit("")) != "", F.array_distinct(both))


def judged(captures: DataFrame, log: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """`captures` with blocked, and kind, key, category and start of the entry that decides (NULL where nothing holds)."""
    names = ["blocked", "list_kind", "list_key", "list_category", "listed_since"]
    captures = captures.drop(*names)
    last = captures.agg(F.max(F.col(at))).first()[0]
    if last is None:
        last = 0
    valid = intervals(log).where(F.col("since") <= last)
    span = F.sequence(F.floor(F.col("since") / PERIOD), F.floor(F.least(F.coalesce(F.col("until") - 1, F.lit(last)), F.lit(last)) / PERIOD))
    cut = valid.withColumn("period", F.explode(span))
    parts = lambda kind, sign: F.max(F.when(F.col("kind") == kind, F.size(F.split("key", sign))))
    labels, steps = valid.agg(parts("domain", r"\."), parts("prefix", "/")).first()
    asked = captures.select(F.col(url).alias("__url"), F.col(at).cast("long").alias("__at")).where("__url IS NOT NULL AND __at IS NOT NULL").distinct()
    met = asked.select("__url", "__at", F.floor(F.col("__at") / PERIOD).alias("period"), F.inline(keys_of(F.col("__url"), labels or 1, steps or 1))).join(cut, ["kind", "key", "period"])
    holds = met.where("since <= __at AND (until IS NULL OR __at < until)")
    best = F.struct(F.length("key").alias("n"), F.col("kind").alias("kind"), F.col("key").alias("key"), F.col("since").alias("since"), F.col("category").alias("category"))
    decided = holds.groupBy("__url", "__at").agg(F.max(best).alias("__by"))
    joined = captures.join(decided, (captures[url] == F.col("__url")) & (captures[at].cast("long") == F.col("__at")), "left")
    shown = [F.col("__by").isNotNull(), F.col("__by.kind"), F.col("__by.key"), F.col("__by.category"), F.col("__by.since")]
    return joined.select(*(captures[c] for c in captures.columns), *(c.alias(n) for c, n in zip(shown, names, strict=True)))
