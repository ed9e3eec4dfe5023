"""Registered queries against their oracle SQL on the smallest tables."""

import datetime
import decimal
import math

import pytest

import __spark_entry__ as entry

KEYS = [
    "src_csv_typed", "sink_insert_rows", "trusted_orders", "trusted_customers", "trusted_products", "trusted_geolocation",
    "clean_order_reviews", "clean_products", "scd2_merge", "dim_customer", "fact_orders_sql", "fact_payment_split",
    "fact_reviews_meta", "vw_satisfaction_analysis", "join_self_copurchase", "agg_box_stats", "win_percent_rank", "topk_per_key",
    "fn_json_parse", "stream_refresh_5min", "dash_category_revenue", "dash_monthly_sales", "dash_seller_ranking",
    "star_rating_by_seller_state", "eda_executive_summary", "dq_run_suite", "dq_report", "dq_reconcile", "ml_tfidf", "ml_recommend",
    "ml_delivery_features", "ml_embedding_zero_shot", "llm_flatten", "llm_quality_targets", "app_genai_kpis", "cat_merge_tags",
    "dq_monitors", "udf_batch_extractor", "ml_embedding_topk", "ml_product_similarity", "dq_recorded_trend", "dq_recorded_drift",
    "llm_extract_batch", "sink_clustered_facts", "sink_parquet_star", "stream_monthly_sales", "ddl_all_contracts",
]


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, root, duck, key):
    df = entry.queries()[key](spark, root)
    result = duck.execute(entry.oracle_sql()[key])
    wanted = table([d[0] for d in result.description], result.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == wanted


def test_entry_has_rows():
    assert set(entry.oracle_sql()) <= set(entry.queries())
