"""Declarative data-quality rules compiled into few passes.

All row rules of one table become one aggregate (one scan); key rules need one grouping each and
reference rules one anti join each. Every rule ends as one row of the result schema
(table, rule, column, dimension, total, unexpected, score, threshold, passed).
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.sources.io import stage

ROW_KINDS = {"not_null", "in_set", "between", "regex", "length", "check"}


@dataclass(frozen=True)
class Rule:
    """`kind` decides what `args` mean: set values, (low, high), (pattern,), (condition text,) for a
    check, (parent table, parent column) for a reference. `strict` counts NULL results as faults."""

    table: str
    kind: str
    column: str
    dimension: str
    args: tuple = ()
    threshold: float = 1.0
    strict: bool = False

    @property
    def columns(self) -> list[str]:
        return [c.strip() for c in self.column.split(",")]

    @property
    def label(self) -> str:
        return f"check: {self.args[0]}" if self.kind == "check" else self.kind


def row_test(rule: Rule) -> Column:
    """True where the row meets the rule, NULL where the rule does not apply."""
    c = F.col(rule.columns[0])
    if rule.kind == "not_null":
        test = c.isNotNull()
    elif rule.kind == "in_set":
        test = c.isin(list(rule.args))
    elif rule.kind == "between":
        test = c.between(*rule.args)
    elif rule.kind == "regex":
        test = F.rlike(c, F.lit(rule.args[0]))
    elif rule.kind == "length":
        test = F.length(c).between(*rule.args)
    elif rule.kind == "check":
        test = F.expr(rule.args[0])
    else:
        raise ValueError(rule.kind)
    return F.coalesce(test, F.lit(False)) if rule.strict else test


def _result(rule: Rule, total: Column, unexpected: Column) -> Column:
    t, u = F.coalesce(total, F.lit(0)).cast("bigint"), F.coalesce(unexpected, F.lit(0)).cast("bigint")
    share = F.when(t == 0, F.lit(1.0)).otherwise((t - u) / t)
    return F.struct(
        F.lit(rule.table).alias("table"),
        F.lit(rule.label).alias("rule"),
        F.lit(rule.column).alias("column"),
        F.lit(rule.dimension).alias("dimension"),
        t.alias("total"),
        u.alias("unexpected"),
        F.round(share, 4).alias("score"),
        F.lit(float(rule.threshold)).alias("threshold"),
        (share >= rule.threshold).alias("passed"),
    )


def _row_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    aggs = [F.count("*").alias("n")]
    for i, r in enumerate(rules):
        if r.kind in ROW_KINDS:
            test = row_test(r)
            aggs += [F.count(test).alias(f"t{i}"), F.count_if(~test).alias(f"u{i}")]
    out = []
    for i, r in enumerate(rules):
        if r.kind == "row_count":
            inside = F.col("n").between(*r.args)
            out.append(_result(r, F.col("n"), F.when(inside, 0).otherwise(F.col("n"))))
        else:
            out.append(_result(r, F.col(f"t{i}"), F.col(f"u{i}")))
    return df.agg(*aggs).select(F.explode(F.array(*out)).alias("r")).select("r.*")


def _key_rule(df: DataFrame, rule: Rule) -> DataFrame:
    """All rows of a repeated key are unexpected; keys with a NULL part are left out."""
    keys = df.select(*rule.columns).dropna()
    groups = keys.groupBy(*rule.columns).agg(F.count("*").alias("n"))
    row = groups.agg(F.sum("n").alias("t"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("u"))
    return row.select(_result(rule, F.col("t"), F.col("u")).alias("r")).select("r.*")


def child_keys(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null child keys with their row count and whether the parent has them."""
    keys = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_column).alias("key")).distinct().withColumn("known", F.lit(True))
    return keys.join(parents, "key", "left")


def _reference_rule(tables: dict[str, DataFrame], rule: Rule) -> DataFrame:
    keys = child_keys(tables[rule.table], rule.columns[0], tables[rule.args[0]], rule.args[1])
    row = keys.agg(F.count("*").alias("t"), F.count_if(F.col("known").isNull()).alias("u"))
    return row.select(_result(rule, F.col("t"), F.col("u")).alias("r")).select("r.*")


def run_rules(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    by_table: dict[str, list[Rule]] = defaultdict(list)
    parts = []
    for r in rules:
        if r.kind in ROW_KINDS or r.kind == "row_count":
            by_table[r.table].append(r)
        elif r.kind == "unique":
            parts.append(_key_rule(tables[r.table], r))
        elif r.kind == "refers":
            parts.append(_reference_rule(tables, r))
        else:
            raise ValueError(r.kind)
    parts += [_row_rules(tables[t], rs) for t, rs in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


def suite_scores(results: DataFrame) -> DataFrame:
    failed = F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), F.concat_ws(":", "rule", "column")))), "; ")
    return results.groupBy("table").agg(
        F.count("*").alias("total_expectations"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        S.ratio(F.count_if("passed"), F.count("*"), 4).alias("score"),
        failed.alias("failed_details"),
    )


def score_band(score: Column) -> Column:
    return F.when(score >= 0.95, "PASSOU").when(score >= 0.80, "ATENCAO").otherwise("FALHOU")


def report(suites: DataFrame, checks: DataFrame, gate: float = 0.95) -> DataFrame:
    """Global result: the plain mean of the table scores and of the mean consistency score."""
    per_suite = suites.agg(
        F.count("*").alias("tables_validated"),
        F.sum("total_expectations").alias("expectations_total"),
        F.sum("passed").alias("expectations_passed"),
        F.sum("failed").alias("expectations_failed"),
        F.sum(F.col("score").cast("double")).alias("score_sum"),
    )
    per_check = checks.agg(
        F.count("*").alias("checks_total"),
        F.count_if("passed").alias("checks_passed"),
        F.avg("score").alias("consistency"),
    )
    per_check = stage(per_check, "check_totals")  # one row, read once per column
    row = per_suite.withColumns({c: per_check.select(c).scalar() for c in per_check.columns})
    overall = (F.col("score_sum") + F.col("consistency")) / (F.col("tables_validated") + 1)
    return row.select(
        F.round(overall, 4).alias("global_score"),
        F.when(overall >= gate, "APROVADO").otherwise("REPROVADO").alias("global_status"),
        "tables_validated",
        "expectations_total",
        "expectations_passed",
        "expectations_failed",
        "checks_total",
        "checks_passed",
        (F.col("checks_total") - F.col("checks_passed")).alias("checks_failed"),
        F.round("consistency", 4).alias("consistency_score"),
    )


def masked_failures(df: DataFrame, rule: Rule, secret: list[str], partial: list[str]) -> DataFrame:
    """Rows that break a row rule, with secret columns hashed and partial ones half hidden."""
    bad = df.where(~row_test(rule))
    return bad.withColumns(
        {
            **{c: F.sha2(F.col(c).cast("string"), 256) for c in secret},
            **{c: F.concat(F.substring(c, 1, 2), F.lit("***")) for c in partial},
        }
    )


def checksum(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Row count and an order-free sum of row digests, to compare two stages."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.lit(name).alias("stage"), F.count("*").alias("n_rows"), F.sum(digest).alias("checksum"))
