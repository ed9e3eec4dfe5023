"""Oracle form of the rules: one SELECT per rule."""

from __future__ import annotations

from bazaarlens.operators.quality import Rule
from bazaarlens.oracle import sqlkit as q

SOURCES = {
    "orders": "m_orders", "order_items": "m_items", "order_payments": "m_payments", "order_reviews": "m_reviews",
    "customers": "m_customers", "products": "m_products", "sellers": "m_sellers", "geolocation": "m_geo",
    "category_translation": "m_translation", "fact_orders": "f_orders", "fact_reviews": "f_reviews",
    "dim_customer": "d_customer", "dim_date": "d_date_all", "dim_geography": "d_geography",
}


def test_sql(r: Rule) -> str:
    c = r.columns[0]
    if r.kind == "not_null":
        t = f"{c} IS NOT NULL"
    elif r.kind == "in_set":
        t = f"{c} IN {q.in_list(list(r.args))}"
    elif r.kind == "between":
        t = f"{c} BETWEEN {r.args[0]} AND {r.args[1]}"
    elif r.kind == "regex":
        t = f"regexp_matches({c}, '{r.args[0]}')"
    elif r.kind == "length":
        t = f"length({c}) BETWEEN {r.args[0]} AND {r.args[1]}"
    else:
        t = r.args[0]
    return f"coalesce({t}, FALSE)" if r.strict else f"({t})"


def rule_sql(r: Rule, sources: dict[str, str] = SOURCES) -> str:
    src = sources[r.table]
    if r.kind == "row_count":
        inner = f"SELECT count(*) AS t, CASE WHEN count(*) BETWEEN {r.args[0]} AND {r.args[1]} THEN 0 ELSE count(*) END AS u FROM {src}"
    elif r.kind == "unique":
        full = " AND ".join(f"{c} IS NOT NULL" for c in r.columns)
        inner = f"SELECT sum(n) AS t, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS u FROM (SELECT count(*) AS n FROM {src} WHERE {full} GROUP BY {r.column})"
    elif r.kind == "refers":
        c, parent, pc = r.columns[0], sources[r.args[0]], r.args[1]
        inner = (
            f"SELECT count(*) AS t, count(*) FILTER (WHERE {c} NOT IN (SELECT {pc} FROM {parent} WHERE {pc} IS NOT NULL)) AS u FROM (SELECT DISTINCT {c} FROM {src} WHERE {c} IS NOT NULL)"
        )
    else:
        inner = f"SELECT count({test_sql(r)}) AS t, count(*) FILTER (WHERE NOT {test_sql(r)}) AS u FROM {src}"
    label = r.label.replace("'", "''")
    share = "(CASE WHEN t = 0 THEN 1.0::DOUBLE ELSE (t - u)::DOUBLE / t END)"
    return (
        f"SELECT '{r.table}' AS \"table\", '{label}' AS rule, '{r.column}' AS \"column\", '{r.dimension}' AS dimension, CAST(t AS BIGINT) AS total, CAST(u AS BIGINT) AS unexpected, "
        f"round({share}, 4) AS score, {r.threshold}::DOUBLE AS threshold, {share} >= {r.threshold}::DOUBLE AS passed FROM ({inner})"
    )


def rules_sql(rules: list[Rule], sources: dict[str, str] = SOURCES) -> str:
    return " UNION ALL ".join(rule_sql(r, sources) for r in rules)
