"""Data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bazaarlens.functions import fixed
from bazaarlens.functions import scalars as S
from bazaarlens.operators import aggregates as A
from bazaarlens.operators import cleaning as C
from bazaarlens.operators import quality as Q
from bazaarlens.operators.ranges import exact_quantiles
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.quality_sql import SOURCES, rules_sql, test_sql
from bazaarlens.oracle.registry import query
from bazaarlens.plans import explore
from bazaarlens.plans import quality_suites as R
from bazaarlens.queries.q03_star import Warehouse
from bazaarlens.queries.q07_explore import COLUMNS, PROFILE_SQL


def tables(m) -> dict[str, DataFrame]:
    return {
        "orders": m.orders, "order_items": m.order_items, "order_payments": m.order_payments, "order_reviews": m.order_reviews,
        "customers": m.customers, "products": C.fix_column_typos(m.products), "sellers": m.sellers, "geolocation": m.geolocation,
        "category_translation": m.translation,
    }


def _rules(key: str, rules: list[Q.Rule]) -> None:
    query(key, rules_sql(rules))(lambda m: Q.run_rules(tables(m), rules))


_rules("dq_not_null", R.of_kind("not_null"))
_rules("dq_unique", [r for r in R.of_kind("unique") if len(r.columns) == 1])
_rules("dq_compound_unique", [r for r in R.of_kind("unique") if len(r.columns) > 1])
_rules("dq_in_set", R.of_kind("in_set"))
_rules("dq_between", R.of_kind("between"))
_rules("dq_regex", R.of_kind("regex"))
_rules("dq_length_between", R.of_kind("length"))
_rules("dq_row_count_between", R.of_kind("row_count"))
_rules("dq_date_order", R.DATE_ORDERS)
_rules("dq_rule_catalog", R.CATALOG)
_rules("dq_expectations", R.EXPECTATIONS)

# references: distinct values and rows, with up to five sample orphans; the orphaned side is the trusted customer table too
_pairs = [(r.table, r.column, r.args[0], r.args[1]) for r in R.REFERENCES] + [("orders", "customer_id", "people", "customer_id")]
_src = {**SOURCES, "people": "t_customers"}
query(
    "dq_referential",
    " UNION ALL ".join(
        f"""SELECT '{t}.{c} -> {p}.{pc}' AS "check", count(*) AS total_values, count(*) FILTER (WHERE orphan) AS orphan_count, CAST(coalesce(sum(n) FILTER (WHERE orphan), 0) AS BIGINT) AS orphan_rows,
        {q.rdiv('count(*) FILTER (WHERE NOT orphan)', 'count(*)', 4)} AS score, count(*) FILTER (WHERE orphan) = 0 AS passed,
        coalesce((SELECT string_agg(key, ',' ORDER BY key) FROM (SELECT key FROM (SELECT DISTINCT {c} AS key FROM {_src[t]}) WHERE key NOT IN (SELECT {pc} FROM {_src[p]}) ORDER BY key LIMIT 5)), '') AS sample_orphans
        FROM (SELECT {c} AS key, count(*) AS n, {c} NOT IN (SELECT {pc} FROM {_src[p]}) AS orphan FROM {_src[t]} WHERE {c} IS NOT NULL GROUP BY 1)"""
        for t, c, p, pc in _pairs
    ),
)(lambda m: _referential(m))


def _referential(m) -> DataFrame:
    src = {**tables(m), "people": Warehouse(m).customers}
    out = []
    for t, c, p, pc in _pairs:
        keys = Q.child_keys(src[t], c, src[p], pc)
        orphan = F.col("known").isNull()
        # the five smallest orphans: a bounded top-k, not the list of all
        sample = keys.where(orphan).orderBy("key").limit(5).agg(F.array_join(F.array_sort(F.collect_list("key")), ","))
        out.append(
            keys.agg(
                F.lit(f"{t}.{c} -> {p}.{pc}").alias("check"),
                F.count("*").alias("total_values"),
                F.count_if(orphan).alias("orphan_count"),
                F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
                S.ratio(F.count_if(~orphan), F.count("*"), 4).alias("score"),
                (F.count_if(orphan) == 0).alias("passed"),
            ).withColumn("sample_orphans", sample.scalar())
        )
    return reduce(DataFrame.unionByName, out)


_suite = f"""SELECT "table", count(*) AS total_expectations, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed, {q.rdiv('count(*) FILTER (WHERE passed)', 'count(*)', 4)} AS score,
  coalesce(string_agg(CASE WHEN NOT passed THEN rule || ':' || "column" END, '; ' ORDER BY rule || ':' || "column"), '') AS failed_details FROM ({rules_sql(R.EXPECTATIONS)}) GROUP BY 1"""
query("dq_run_suite", _suite)(lambda m: Q.suite_scores(Q.run_rules(tables(m), R.EXPECTATIONS)))
_checks = rules_sql(R.REFERENCES + R.DATE_ORDERS)
query(
    "dq_report",
    f"""WITH s AS ({_suite}), k AS ({_checks}), a AS (SELECT count(*) AS tables_validated, CAST(sum(total_expectations) AS BIGINT) AS expectations_total, CAST(sum(passed) AS BIGINT) AS expectations_passed,
      CAST(sum(failed) AS BIGINT) AS expectations_failed, sum(CAST(score AS DOUBLE)) AS ss FROM s), b AS (SELECT count(*) AS checks_total, count(*) FILTER (WHERE passed) AS checks_passed, avg(score) AS c FROM k)
    SELECT round((ss + c) / (tables_validated + 1), 4) AS global_score, CASE WHEN (ss + c) / (tables_validated + 1) >= 0.95 THEN 'APROVADO' ELSE 'REPROVADO' END AS global_status, tables_validated, expectations_total, expectations_passed,
      expectations_failed, checks_total, checks_passed, checks_total - checks_passed AS checks_failed, round(c, 4) AS consistency_score FROM a, b""",
)(lambda m: Q.report(Q.suite_scores(Q.run_rules(tables(m), R.EXPECTATIONS)), Q.run_rules(tables(m), R.REFERENCES + R.DATE_ORDERS)))
query("dq_score_band", f"""SELECT "table", score, CASE WHEN score >= 0.95 THEN 'PASSOU' WHEN score >= 0.80 THEN 'ATENCAO' ELSE 'FALHOU' END AS band FROM ({_suite})""")(
    lambda m: Q.suite_scores(Q.run_rules(tables(m), R.EXPECTATIONS)).select("table", "score", Q.score_band(F.col("score")).alias("band"))
)

_with_nulls = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "product_category_name", "product_photos_qty", "review_comment_message", "review_comment_title", "geolocation_lat"]
query(
    "dq_null_matrix",
    "SELECT table_name, " + ", ".join(f"coalesce(max(CASE WHEN column_name = '{c}' THEN pct_nulls END), 0) AS {c}" for c in _with_nulls) + f" FROM ({PROFILE_SQL}) GROUP BY 1",
)(
    lambda m: explore.profiles({t: getattr(m, t) for t in COLUMNS}).groupBy("table_name").pivot("column_name", _with_nulls).agg(F.max("pct_nulls")).fillna(0)
)
_dims = [d for d in fixed.DQ_DIMENSION_WEIGHTS if d != "timeliness"]
_all_rules = R.EXPECTATIONS + R.REFERENCES + R.DATE_ORDERS
_fresh = "CASE WHEN max(order_purchase_timestamp) < TIMESTAMP '2021-08-02 06:30:00' - INTERVAL 24 HOUR THEN 0.0 ELSE 1.0 END"
_weights = fixed.DQ_DIMENSION_WEIGHTS


@query(
    "dq_weighted_score",
    f"""WITH d AS (SELECT dimension, avg(score) AS score FROM ({rules_sql(_all_rules)}) WHERE dimension IN {q.in_list(_dims)} GROUP BY 1 UNION ALL SELECT 'timeliness', {_fresh} FROM m_orders)
    SELECT round({' + '.join(f"{w} * max(CASE WHEN dimension = '{d}' THEN score END)" for d, w in _weights.items())}, 4) AS weighted_score, {', '.join(f"round(max(CASE WHEN dimension = '{d}' THEN score END), 4) AS {d}" for d in _weights)} FROM d""",
)
def _(m):
    scores = Q.run_rules(tables(m), _all_rules).where(F.col("dimension").isin(_dims)).groupBy("dimension").agg(F.avg("score").alias("score"))
    as_of = F.lit("2021-08-02 06:30:00").cast("timestamp_ntz")
    fresh = m.orders.agg(
        F.lit("timeliness").alias("dimension"),
        F.when(F.max("order_purchase_timestamp") < as_of - F.expr("interval 24 hours"), 0.0).otherwise(1.0).alias("score"),
    )
    pick = {d: F.max(F.when(F.col("dimension") == d, F.col("score"))) for d in _weights}
    total = sum((F.lit(w) * pick[d] for d, w in _weights.items()), F.lit(0.0))
    return scores.unionByName(fresh).agg(F.round(total, 4).alias("weighted_score"), *[F.round(pick[d], 4).alias(d) for d in _weights])


query(
    "dq_completeness_rate",
    f"SELECT table_name, column_name, {q.rdiv('n_rows - n_nulls', 'n_rows', 4)} AS completeness FROM ({PROFILE_SQL})",
)(lambda m: explore.profiles({t: getattr(m, t) for t in COLUMNS}).select("table_name", "column_name", S.ratio(F.col("n_rows") - F.col("n_nulls"), "n_rows", 4).alias("completeness")))
query("dq_duplicate_count", "SELECT count(*) AS n_rows, count(DISTINCT review_id) AS n_distinct, count(*) - count(DISTINCT review_id) AS n_duplicates FROM m_reviews")(
    lambda m: A.duplicate_count(m.order_reviews, ["review_id"])
)
query(
    "dq_freshness",
    """SELECT 'orders' AS "table", max(order_purchase_timestamp) AS last_ingested, CAST(floor((epoch(TIMESTAMP '2021-08-02 06:30:00') - epoch(max(order_purchase_timestamp))) / 3600) AS BIGINT) AS hours_since,
    CASE WHEN max(order_purchase_timestamp) < TIMESTAMP '2021-08-02 06:30:00' - INTERVAL 24 HOUR THEN 'ATRASADO' ELSE 'OK' END AS status, floor((epoch(TIMESTAMP '2021-08-02 06:30:00') - epoch(max(order_purchase_timestamp))) / 3600) > 25 AS alert FROM m_orders""",
)(
    lambda m: m.orders.agg(F.lit("orders").alias("table"), F.max("order_purchase_timestamp").alias("last_ingested")).select(
        "table",
        "last_ingested",
        S.hours_since("last_ingested", F.lit("2021-08-02 06:30:00").cast("timestamp_ntz")).alias("hours_since"),
        F.when(F.col("last_ingested") < F.lit("2021-08-02 06:30:00").cast("timestamp_ntz") - F.expr("interval 24 hours"), "ATRASADO").otherwise("OK").alias("status"),
        (S.hours_since("last_ingested", F.lit("2021-08-02 06:30:00").cast("timestamp_ntz")) > 25).alias("alert"),
    )
)
query(
    "dq_price_distribution",
    f"SELECT min(price) AS preco_minimo, max(price) AS preco_maximo, {q.avg('price')} AS preco_medio, round(stddev_samp(CAST(price AS DOUBLE)), 4) AS desvio_padrao, round(quantile_cont(CAST(price AS DOUBLE), 0.5), 4) AS mediana, round(quantile_cont(CAST(price AS DOUBLE), 0.99), 4) AS p99 FROM m_items",
)(
    lambda m: (
        lambda quantiles: m.order_items.agg(
            F.min("price").alias("preco_minimo"),
            F.max("price").alias("preco_maximo"),
            S.mean("price").alias("preco_medio"),
            F.round(F.stddev_samp(F.col("price").cast("double")), 4).alias("desvio_padrao"),
        ).withColumns({c: F.round(quantiles.select(c).scalar(), 4) for c in quantiles.columns})
    )(exact_quantiles(m.order_items, "price", {"mediana": 0.5, "p99": 0.99}))
)
query("dq_status_distribution", f"SELECT order_status, count(*) AS quantidade, {q.pct('count(*)', 'sum(count(*)) OVER ()')} AS percentual FROM m_orders GROUP BY 1")(
    lambda m: A.share_of_total(m.orders.groupBy("order_status").agg(F.count("*").alias("quantidade")), "quantidade", "percentual")
)




query(
    "dq_gate",
    " UNION ALL ".join(f"SELECT *, CASE WHEN passed THEN 'promote' ELSE '{g.action}' END AS action FROM ({rules_sql([g.rule])})" for g in R.GATES),
)(lambda m: _gate(m))


def _gate(m) -> DataFrame:
    results = Q.run_rules(tables(m), [g.rule for g in R.GATES])
    action = None
    for g in R.GATES:
        same = (F.col("table") == g.rule.table) & (F.col("rule") == g.rule.label) & (F.col("column") == g.rule.column)
        action = F.when(same, g.action) if action is None else action.when(same, g.action)
    return results.withColumn("action", F.when(F.col("passed"), "promote").otherwise(action))


query("dq_star_contracts", rules_sql(R.STAR_CONTRACTS))(
    lambda m: (
        lambda w: Q.run_rules(
            {"fact_orders": w.unpaid_lines, "fact_reviews": w.fact_reviews, "dim_customer": w.dim_customer, "dim_date": w.dates_all, "dim_geography": w.dim_geography},
            R.STAR_CONTRACTS,
        )
    )(Warehouse(m))
)
query("dq_zone_asserts", rules_sql(R.ZONE_ASSERTS, {"orders": "c_orders", "order_items": "c_items", "order_reviews": "c_reviews"}))(
    lambda m: Q.run_rules(
        {"orders": C.clean_orders(m.landing_orders), "order_items": C.clean_order_items(m.order_items), "order_reviews": C.clean_order_reviews(m.order_reviews)}, R.ZONE_ASSERTS
    )
)
_state_rule = R.in_set("customers", "customer_state", fixed.STATES)
query(
    "dq_masked_failures",
    f"SELECT customer_id, sha256(customer_unique_id) AS customer_unique_id, substr(customer_zip_code_prefix, 1, 2) || '***' AS customer_zip_code_prefix, customer_city, customer_state FROM m_customers WHERE NOT {test_sql(_state_rule)}",
)(lambda m: Q.masked_failures(m.customers, _state_rule, ["customer_unique_id"], ["customer_zip_code_prefix"]))


# monitors: profile of the raw layer against the clean layer of the same table
_prof = lambda src, cols: " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{k}' AS kind, count(*) AS n FROM {src}" for c, k in cols.items())
_raw_cols = {c: "string" for c in COLUMNS["products"][1]}
_clean_cols = {"product_id": "string", "product_category_name": "string", **{c: "int" for c in C.PRODUCT_NUMBERS}, "product_volume_cm3": "bigint", "product_category_name_english": "string"}
query(
    "dq_monitors",
    f"""SELECT coalesce(a.column_name, b.column_name) AS column_name, a.kind AS type_before, b.kind AS type_now, a.n AS rows_before, b.n AS rows_now,
    CASE WHEN a.column_name IS NULL THEN 'added' WHEN b.column_name IS NULL THEN 'removed' WHEN a.kind <> b.kind THEN 'type_changed' WHEN a.n <> b.n THEN 'row_count_changed' ELSE 'same' END AS drift
    FROM ({_prof('l_products', _raw_cols)}) a FULL JOIN ({_prof('c_products', _clean_cols)}) b ON a.column_name = b.column_name""",
)(lambda m: monitors(m.landing_products, C.clean_products(m.landing_products, m.translation)))


def monitors(before: DataFrame, now: DataFrame) -> DataFrame:
    """Schema drift and row-count change between two versions of a table."""
    side = lambda df, tag: explore.table_profile(tag, df).select("column_name", F.col("column_type").alias(f"type_{tag}"), F.col("n_rows").alias(f"rows_{tag}"))
    drift = (
        F.when(F.col("type_before").isNull(), "added")
        .when(F.col("type_now").isNull(), "removed")
        .when(F.col("type_before") != F.col("type_now"), "type_changed")
        .when(F.col("rows_before") != F.col("rows_now"), "row_count_changed")
        .otherwise("same")
    )
    return side(before, "before").join(side(now, "now"), "column_name", "full").withColumn("drift", drift)


_digest = lambda src: f"SELECT '{src}' AS stage, count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', coalesce(order_id, '~'), coalesce(customer_id, '~'), coalesce(order_status, '~'))), 1, 8) AS BIGINT)) AS BIGINT) AS checksum FROM {src}"
query("dq_reconcile", f"SELECT 'raw' AS stage, n_rows, checksum FROM ({_digest('l_orders')}) UNION ALL SELECT 'trusted', n_rows, checksum FROM ({_digest('c_orders')})")(
    lambda m: Q.checksum(m.landing_orders, ["order_id", "customer_id", "order_status"], "raw").unionByName(
        Q.checksum(C.clean_orders(m.landing_orders), ["order_id", "customer_id", "order_status"], "trusted")
    )
)
query(
    "dq_score_trend",
    f"""WITH s AS (SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS run_at, {q.rdiv('count(order_approved_at)', 'count(*)', 4)} AS score FROM m_orders GROUP BY 1)
    SELECT run_at, score, lag(score) OVER (ORDER BY run_at) AS score_before, CAST(score - lag(score) OVER (ORDER BY run_at) AS DECIMAL(18,4)) AS change FROM s""",
)(
    lambda m: score_trend(
        m.orders.groupBy(S.month_start("order_purchase_timestamp").alias("run_at")).agg(S.ratio(F.count("order_approved_at"), F.count("*"), 4).alias("score"))
    )
)


def score_trend(history: DataFrame) -> DataFrame:
    """Change of a score against the run before (one row per run)."""
    before = F.lag("score").over(W.orderBy("run_at"))
    return history.withColumn("score_before", before).withColumn("change", (F.col("score") - F.col("score_before")).cast("decimal(18,4)"))
