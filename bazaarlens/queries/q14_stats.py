"""Recorded statistics: three runs of the growing tables, one of them recorded twice and one in parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.operators.stats_store import StatsStore
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.sources import io

RUNS = {"r1": 2018, "r2": 2019, "r3": 9999}
COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]
PAYMENTS = ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]


def recorded(m) -> StatsStore:
    """Each run sees the orders up to a year, and from the second on the payments; the last one comes in two parts."""
    store = StatsStore(io.fresh_path(m.spark, "stats"))
    at = lambda year: F.lit(f"{min(year, 2022)}-01-01 00:00:00").cast("timestamp_ntz")
    upto = lambda year: m.orders.where(F.year("order_purchase_timestamp") <= year)
    store.record("r1", at(2018), {"orders": upto(2018)})
    store.record("r2", at(2019), {"orders": upto(2020)})  # a wrong run, replaced by the next
    store.record("r2", at(2019), {"orders": upto(2019), "payments": m.order_payments})
    number = F.col("order_id").cast("bigint") % 2
    for n in (0, 1):
        store.record("r3", at(9999), {"orders": m.orders.where(number == n), "payments": m.order_payments.where(number == n)}, part=f"p{n}")
    return store


_runs = " UNION ALL ".join(
    [f"SELECT '{r}' AS run, {min(y, 2022)} AS y, 'orders' AS table_name, count(*) AS n, {' + '.join(f'count({c})' for c in COLUMNS)} AS filled, {len(COLUMNS)} AS w FROM m_orders WHERE year(order_purchase_timestamp) <= {y}" for r, y in RUNS.items()]
    + [f"SELECT '{r}', {min(RUNS[r], 2022)}, 'payments', count(*), {' + '.join(f'count({c})' for c in PAYMENTS)}, {len(PAYMENTS)} FROM m_payments" for r in ("r2", "r3")]
)


@query(
    "dq_recorded_trend",
    f"""WITH s AS (SELECT run, table_name, make_timestamp(y, 1, 1, 0, 0, 0) AS "at", n AS n_rows, {q.rdiv('filled', 'n * w', 4)} AS score FROM ({_runs}))
    SELECT *, lag(score) OVER (PARTITION BY table_name ORDER BY "at") AS score_before, CAST(score - lag(score) OVER (PARTITION BY table_name ORDER BY "at") AS DECIMAL(18,4)) AS change FROM s""",
)
def _(m):
    return recorded(m).trend(m.spark)


_side = lambda year: " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS nulls FROM m_orders WHERE year(order_purchase_timestamp) <= {year}" for c in COLUMNS)
_share = lambda t: q.rdiv(f"{t}.nulls", f"{t}.n", 4)


@query(
    "dq_recorded_drift",
    f"""SELECT 'orders' AS table_name, a.column_name, a.n AS n_rows_before, b.n AS n_rows_now, {_share('a')} AS null_share_before, {_share('b')} AS null_share_now,
    CASE WHEN {_share('a')} <> {_share('b')} THEN 'nulls_changed' WHEN a.n <> b.n THEN 'rows_changed' ELSE 'same' END AS drift FROM ({_side(2018)}) a JOIN ({_side(9999)}) b ON a.column_name = b.column_name
    UNION ALL SELECT 'payments', c, NULL, (SELECT count(*) FROM m_payments), NULL, CAST(0 AS DECIMAL(18,4)), 'added' FROM (VALUES {', '.join(f"('{c}')" for c in PAYMENTS)}) v(c)""",
)
def _(m):
    kept = ["table_name", "column_name", "n_rows_before", "n_rows_now", "null_share_before", "null_share_now", "drift"]
    return recorded(m).drift(m.spark, "r1", "r3").select(*kept)
