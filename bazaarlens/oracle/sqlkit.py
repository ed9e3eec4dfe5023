"""SQL text helpers for the oracle: exact rounding, look-ups, and named common table expressions."""

from __future__ import annotations

import re

from bazaarlens.functions import fixed


# --- expressions -------------------------------------------------------------
def rdiv(num: str, den: str, digits: int = 2) -> str:
    """num / den rounded half away from zero with integer arithmetic; NULL when den is 0."""
    n = f"CAST(CAST({num} AS DECIMAL(28,4)) * 10000 AS HUGEINT)"
    d = f"CAST(CAST({den} AS DECIMAL(28,4)) * 10000 AS HUGEINT)"
    scale = 10**digits
    whole = f"CAST(sign({n}) * sign({d}) AS HUGEINT) * ((2 * abs({n}) * {scale} + abs({d})) // (2 * abs({d})))"
    unit = {0: "1", 1: "0.1", 2: "0.01", 3: "0.001", 4: "0.0001", 6: "0.000001"}[digits]
    value = f"CAST(CAST({whole} AS DECIMAL(24,0)) * CAST({unit} AS DECIMAL({digits + 1},{digits})) AS DECIMAL(18,{digits}))"
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE {value} END)"


def pct(num: str, den: str, digits: int = 2) -> str:
    return rdiv(f"CAST({num} AS DECIMAL(26,4)) * 100", den, digits)


def avg(x: str, digits: int = 2) -> str:
    return rdiv(f"sum({x})", f"count({x})", digits)


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def region(x: str, default: str) -> str:
    arms = " ".join(f"WHEN '{uf}' THEN '{name}'" for name, ufs in fixed.REGION_STATES.items() for uf in ufs)
    return f"(CASE {x} {arms} ELSE '{default}' END)"


def initcap(x: str) -> str:
    signs = "".join("\\" + c for c in fixed.WORD_BREAKS if c != "'")
    parts = f"regexp_extract_all({x}, '[^\\s{signs}]*[\\s{signs}]|[^\\s{signs}]+')"
    return f"array_to_string(list_transform({parts}, lambda w: upper(w[1:1]) || lower(w[2:])), '')"


def date_key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def pick(values: list[str], index: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[CAST({index} AS BIGINT) + 1]"


def days(start: str, end: str) -> str:
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


def hours(start: str, end: str) -> str:
    return f"CAST(date_diff('hour', {start}, {end}) AS BIGINT)"


def elapsed(start: str, end: str) -> str:
    return f"((epoch({end}) - epoch({start})) / 86400.0)"


def floor_days(start: str, end: str) -> str:
    return f"CAST(floor((epoch({end}) - epoch({start})) / 86400.0) AS BIGINT)"


def safe_int(x: str) -> str:
    return f"CAST(round(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


def weight_band(x: str) -> str:
    arms = " ".join(f"WHEN {x} <= {w} THEN '{label}'" for w, label in fixed.WEIGHT_BANDS)
    return f"(CASE {arms} ELSE '{fixed.WEIGHT_BAND_TOP}' END)"


def price_tier(x: str) -> str:
    arms = " ".join(f"WHEN {x} < {w} THEN '{label}'" for w, label in fixed.PRICE_TIERS)
    return f"(CASE {arms} ELSE '{fixed.PRICE_TIER_TOP}' END)"


def in_list(values: list) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def first_row(source: str, key: str, order: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


# --- named tables --------------------------------------------------------------
class Library:
    """Named CTE bodies; `with_tables` puts in front of a query just the ones it needs."""

    def __init__(self):
        self.bodies: dict[str, str] = {}

    def add(self, name: str, body: str) -> None:
        self.bodies[name] = body.strip()

    def needs(self, sql: str) -> list[str]:
        words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
        return [n for n in self.bodies if n in words]

    def with_tables(self, sql: str) -> str:
        done: list[str] = []

        def visit(text: str) -> None:
            for name in self.needs(text):
                if name not in done:
                    visit(self.bodies[name].replace(name, "")) if name in self.bodies[name] else visit(self.bodies[name])
                    if name not in done:
                        done.append(name)

        visit(sql)
        sql = sql.strip().rstrip(";")
        if not done:
            return sql
        heads = ", ".join(f"{n} AS MATERIALIZED ({self.bodies[n]})" for n in done)
        if sql[:5].upper() == "WITH ":
            return f"WITH {heads}, {sql[5:]}"
        return f"WITH {heads} {sql}"
