"""Text extraction jobs around a caller-supplied extractor."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.functions import fixed
from bazaarlens.functions import scalars as S
from bazaarlens.operators import cleaning as C
from bazaarlens.operators import extraction as X
from bazaarlens.operators.extraction_job import ExtractionJob
from bazaarlens.oracle import sqlkit as q
from bazaarlens.oracle.registry import query
from bazaarlens.oracle.tables import lib
from bazaarlens.sources import io

_j = "CASE WHEN json_valid(answer) THEN answer::JSON END"
_parsed = lambda answers: f"""SELECT product_id, title, answer, input_tokens, output_tokens, j, json_type(j) = 'OBJECT' AS ok, json_keys(j) AS keys, {', '.join(f"json_extract_string(j, '$.{f}') AS llm_{f}" for f in X.TEXT_FIELDS)},
    json_type(j, '$.features') AS fk, json_type(j, '$.keywords') AS kk, CASE WHEN json_type(j, '$.features') = 'OBJECT' THEN json_extract(j, '$.features') END AS fo,
    CASE WHEN json_type(j, '$.keywords') = 'ARRAY' THEN CAST(json_extract(j, '$.keywords') AS VARCHAR[]) END AS kw FROM (SELECT *, {_j} AS j FROM {answers})"""  # noqa: E731
_kind = lambda c: f"CASE {c} WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'scalar' END"
_absent = f"list_filter({list(fixed.EXTRACTED_FIELDS)}, lambda f: NOT list_contains(keys, f))"
_odd = "list_sort(list_filter(json_keys(fo), lambda k: json_type(fo, '$.' || k) <> 'BOOLEAN'))"
_issues = f"""list_filter([CASE WHEN len({_absent}) > 0 THEN 'Campos ausentes: ' || array_to_string({_absent}, ', ') END,
  CASE WHEN fk NOT IN ('NULL', 'OBJECT') THEN '''features'' deveria ser object, recebeu ' || {_kind('fk')} END,
  CASE WHEN kk NOT IN ('NULL', 'ARRAY') THEN '''keywords'' deveria ser array, recebeu ' || {_kind('kk')} END], lambda x: x IS NOT NULL)"""
_cats = q.in_list(fixed.PRODUCT_CATEGORIES)
_warn = f"""list_filter([CASE WHEN len({_odd}) > 0 THEN 'Valores nao-booleanos em features: ' || array_to_string({_odd}, ', ') END,
  CASE WHEN len(kw) < 2 THEN 'Poucas keywords: ' || CAST(len(kw) AS VARCHAR) END, CASE WHEN len(kw) > 10 THEN 'Muitas keywords: ' || CAST(len(kw) AS VARCHAR) END,
  CASE WHEN llm_category <> '' AND llm_category NOT IN {_cats} THEN 'Categoria ''' || llm_category || ''' nao esta na lista padrao' END], lambda x: x IS NOT NULL)"""
_valid = lambda parsed: f"""SELECT *, CASE WHEN coalesce(ok, FALSE) THEN 'SUCCESS' ELSE 'FAILED' END AS extraction_status, CASE WHEN ok THEN {_issues} END AS issues, CASE WHEN ok THEN {_warn} END AS warnings, coalesce(ok AND len({_issues}) = 0, FALSE) AS is_valid FROM {parsed}"""
_flat = lambda valid: f"""SELECT product_id, title, extraction_status, is_valid, CASE WHEN len(issues) > 0 THEN array_to_string(issues, '; ') END AS validation_issues, CASE WHEN len(warnings) > 0 THEN array_to_string(warnings, '; ') END AS validation_warnings,
    {', '.join('llm_' + f for f in X.TEXT_FIELDS)}, CASE WHEN ok THEN CAST(coalesce(len(json_keys(fo)), json_array_length(j, '$.features'), 0) AS INTEGER) END AS llm_feature_count,
    CASE WHEN ok THEN coalesce(CAST(json_extract(j, '$.features') AS VARCHAR), '{{}}') END AS llm_features_json, CASE WHEN ok THEN coalesce(array_to_string(kw, ', '), '') END AS llm_keywords,
    CASE WHEN ok THEN CAST(coalesce(len(kw), 0) AS INTEGER) END AS llm_keywords_count, CASE WHEN ok THEN answer END AS raw_features FROM {valid}"""  # noqa: E731
for _name, _answers in (("x", "m_answers"), ("y", "(SELECT * EXCLUDE extraction_status FROM x_answers)")):  # given answers; those of the built-in extractor
    lib.add(f"{_name}_parsed", _parsed(_answers))
    lib.add(f"{_name}_valid", _valid(f"{_name}_parsed"))
    lib.add(f"{_name}_flat", _flat(f"{_name}_valid"))


def results(m):
    return X.flatten(X.validate(m.answers))


query(
    "llm_prompt_build",
    """SELECT product_id, CAST(4 AS INTEGER) AS n_messages, 'Extract structured features from this product:' || chr(10) || chr(10) || 'Title: "' || title || '"' || chr(10) || chr(10) || 'Description: "' || coalesce(description, '') || '"' AS user_message FROM m_texts""",
)(lambda m: X.prompt_build(m.product_texts).select("product_id", F.size("messages").alias("n_messages"), F.col("messages")[3]["content"].alias("user_message")))


_said = lambda w: "regexp_matches(txt, '(?i)(^|[^\\p{L}\\p{N}])" + w.replace("'", "''").replace("&", "\\&") + "([^\\p{L}\\p{N}]|$)')"
_first = lambda ws: "CASE " + " ".join(f"WHEN {_said(w)} THEN '" + w.replace("'", "''") + "'" for w in ws) + " END"
_words = lambda c: f"regexp_extract_all(lower({c}), '\\p{{L}}{{4,}}')"
lib.add(
    "x_answers",
    f"""SELECT product_id, title, 'SUCCESS' AS extraction_status, CAST(1 AS INTEGER) AS attempts, answer, n // 4 AS input_tokens, length(answer) // 4 AS output_tokens
    FROM (SELECT product_id, title, length(a) + length(b) AS n, CAST(to_json({{'category': {_first(fixed.PRODUCT_CATEGORIES)}, 'subcategory': coalesce({_words("a")}[-1], {_words("b")}[-1]),
      'brand': nullif(regexp_extract(a, 'Brand#[0-9]+'), ''), 'material': {_first(X.MATERIALS)}, 'target_device': {_first(X.DEVICES)}, 'color': {_first(X.COLORS)},
      'features': {{{", ".join(f"'has_{w}': {_said(w)}" for w in X.PARTS)}}}, 'target_audience': {_first(X.AUDIENCES)}, 'keywords': w[:{X.KEYWORDS}]}}) AS VARCHAR) AS answer
      FROM (SELECT product_id, title, a, b, txt, list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda x: list_position(ws, x[1]) = x[2]), lambda x: x[1]) AS w
        FROM (SELECT product_id, title, coalesce(title, '') AS a, coalesce(description, '') AS b, a || ' ' || b AS txt, {_words("txt")} AS ws FROM m_texts)))""",
)


@query("llm_extract_batch", "SELECT * FROM x_answers")
def _(m):
    return X.extract_batch(m.product_texts)


@query("udf_batch_extractor", "SELECT y.product_id, y.title, y.raw_features IS NOT DISTINCT FROM a.answer AS same, y.* EXCLUDE (product_id, title) FROM y_flat y JOIN x_answers a ON y.product_id = a.product_id")
def _(m):
    """The answers of a caller's function run per batch, validated and flattened; `same` tells whether the built-in extractor
    gives the same answer."""
    texts = m.product_texts
    own = X.extract_batch(texts).select("product_id", F.col("answer").alias("built_in"))
    given = X.flatten(X.validate(X.extract_batch(texts, X.keyword_answer_of)))
    same = F.col("raw_features").eqNullSafe(F.col("built_in")).alias("same")
    rest = [c for c in given.columns if c not in ("product_id", "title")]
    return given.join(own, "product_id").select("product_id", "title", same, *rest)


@query("llm_extract_resumed", "SELECT * FROM x_answers")
def _(m):
    """The extractor as a job that is stopped after its first wave and started again."""
    texts = m.product_texts  # the job deals its waves over all cores itself
    path = io.fresh_path(m.spark, "answers")
    job = ExtractionJob(path, X.keyword_answer_of, wave_rows=max(1, texts.count() // 3))
    job.run(texts, max_waves=1)
    job.run(texts)
    return job.answers(texts)


query(
    "llm_validate",
    "SELECT product_id, extraction_status, is_valid, array_to_string(issues, '; ') AS issues, array_to_string(warnings, '; ') AS warnings FROM x_valid",
)(lambda m: X.validate(m.answers).select("product_id", "extraction_status", "is_valid", F.array_join("issues", "; ").alias("issues"), F.array_join("warnings", "; ").alias("warnings")))
query("llm_flatten", "SELECT * FROM x_flat")(results)
SUM = f"""SELECT count(*) AS n_products, count(*) FILTER (WHERE extraction_status = 'SUCCESS') AS n_success, count(*) FILTER (WHERE extraction_status = 'FAILED') AS n_failed, count(*) FILTER (WHERE is_valid) AS n_valid,
  {q.pct("count(*) FILTER (WHERE extraction_status = 'SUCCESS')", "count(*)", 1)} AS success_pct, {q.pct("count(*) FILTER (WHERE is_valid)", "count(*)", 1)} AS valid_pct FROM x_flat"""
query("llm_summary", SUM)(lambda m: X.summary(results(m)))
query(
    "llm_distributions",
    " UNION ALL ".join(
        f"SELECT '{k}' AS kind, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM x_flat WHERE extraction_status = 'SUCCESS' AND {c} IS NOT NULL GROUP BY 2"
        for k, c in [("category", "llm_category"), ("features", "llm_feature_count"), ("keywords", "llm_keywords_count")]
    ),
)(lambda m: X.distributions(results(m)))
_fill = lambda f: f"llm_{f} IS NOT NULL AND trim(llm_{f}) <> '' AND lower(llm_{f}) <> 'none'"
query(
    "llm_fill_rates",
    " UNION ALL ".join(f"SELECT '{f}' AS field, {q.pct(f'count(*) FILTER (WHERE {_fill(f)})', 'count(*)', 1)} AS fill_pct FROM x_flat WHERE extraction_status = 'SUCCESS'" for f in X.TEXT_FIELDS),
)(lambda m: X.fill_rates(results(m)))
query(
    "llm_cost",
    """WITH t AS (SELECT count(*) AS r, sum(input_tokens)::DOUBLE AS i, sum(output_tokens)::DOUBLE AS o FROM m_answers)
    SELECT CASE WHEN s IS NULL THEN 'run' ELSE 'projection' END AS kind, CAST(coalesce(s, r) AS BIGINT) AS products, CAST(round((i + o) / r * coalesce(s, r), 0) AS BIGINT) AS tokens,
    round((i / 1e6 * 0.15::DOUBLE + o / 1e6 * 0.60::DOUBLE) / r * coalesce(s, r), 6) AS cost_usd FROM t, (VALUES (NULL), (100), (1000), (10000), (100000)) v(s)""",
)(lambda m: X.cost(m.answers))
query(
    "llm_export",
    "SELECT product_id, extraction_status, llm_category, 'local-keywords' AS llm_model, TIMESTAMP '2018-09-01' AS llm_extraction_date, CAST(coalesce(CASE WHEN json_type(llm_features_json) = 'OBJECT' THEN len(json_keys(llm_features_json)) END, 0) AS INTEGER) AS n_flags FROM x_flat",
)(
    lambda m: X.export(results(m), "local-keywords", F.lit("2018-09-01").cast("timestamp_ntz")).select(
        "product_id", "extraction_status", "llm_category", "llm_model", "llm_extraction_date", F.size("llm_features").alias("n_flags")
    )
)
_ok = "extraction_status = 'SUCCESS'"
_rates = {
    "schema_compliance": q.pct("count(*) FILTER (WHERE is_valid)", "count(*)"),
    "field_extraction": q.pct("sum(CASE WHEN ok THEN " + " + ".join(f"CAST(coalesce({_fill(f)}, FALSE) AS INTEGER)" for f in X.TEXT_FIELDS) + " END)", f"count(*) FILTER (WHERE ok) * {len(X.TEXT_FIELDS)}"),
    "known_category": q.pct(f"count(*) FILTER (WHERE ok AND llm_category IN {_cats})", "count(*) FILTER (WHERE ok)"),
    "keywords_3_to_8": q.pct("count(*) FILTER (WHERE ok AND len(kw) BETWEEN 3 AND 8)", "count(*) FILTER (WHERE ok)"),
    "some_flag_true": q.pct("count(*) FILTER (WHERE ok AND len(list_filter(json_keys(fo), lambda k: json_extract_string(fo, '$.' || k) = 'true')) > 0)", "count(*) FILTER (WHERE ok)"),
    "brand_when_in_title": q.pct(f"count(*) FILTER (WHERE ok AND (NOT regexp_matches(title, 'Brand#\\d') OR ({_fill('brand')})))", "count(*) FILTER (WHERE ok)"),
}
_targets = {"schema_compliance": 99.0, "field_extraction": 85.0, "known_category": 90.0}
query(
    "llm_quality_targets",
    " UNION ALL ".join(
        f"SELECT '{k}' AS metric, {e} AS rate, {_targets.get(k, 'NULL')}::DOUBLE AS target, {e} > {_targets.get(k, 'NULL')}::DOUBLE AS met FROM x_valid" for k, e in _rates.items()
    ),
)(lambda m: X.quality_targets(X.validate(m.answers)))
lib.add("x_dim", "SELECT p.*, " + ", ".join(X.LLM_COLUMNS) + " FROM c_products p LEFT JOIN (SELECT * FROM x_flat WHERE extraction_status = 'SUCCESS') x ON p.product_id = x.product_id")


def enriched(m):
    return X.enrich_products(C.clean_products(m.landing_products, m.translation), results(m))


query("llm_dim_enrich", "SELECT * FROM x_dim")(enriched)
query(
    "txt_presentation_meta",
    """SELECT product_id, CASE WHEN ok THEN '' ELSE coalesce(answer, '') END AS formal, '' AS casual, '' AS urgent, CASE WHEN ok THEN coalesce(llm_target_audience, '') ELSE coalesce(answer, '') END AS target_audience,
    CASE WHEN ok THEN coalesce(array_to_string(kw, '|'), '') ELSE '' END AS seo_keywords FROM (SELECT * REPLACE (coalesce(ok, FALSE) AS ok) FROM x_parsed)""",
)(lambda m: X.presentation_meta(m.answers))
query(
    "llm_category_ratings",
    f"""SELECT llm_category, llm_material, count(DISTINCT r.review_id) AS total_reviews, {q.avg('r.review_score', 4)} AS avg_rating FROM f_reviews r JOIN d_product d ON r.product_key = d.product_key JOIN x_dim x ON d.product_id = x.product_id WHERE llm_category IS NOT NULL GROUP BY 1, 2""",
)(lambda m: _category_ratings(m))


def _category_ratings(m):
    from bazaarlens.queries.q03_star import Warehouse

    w = Warehouse(m)
    dim = w.dim_product.select("product_key", "product_id").join(enriched(m).where("llm_category is not null").select("product_id", "llm_category", "llm_material"), "product_id")
    return (
        w.fact_reviews.select("product_key", "review_id", "review_score").join(dim, "product_key")
        .groupBy("llm_category", "llm_material")
        .agg(F.count_distinct("review_id").alias("total_reviews"), S.mean("review_score", 4).alias("avg_rating"))
        .orderBy(F.desc("total_reviews"), "llm_category", "llm_material")
    )


query(
    "llm_material_price_tier",
    f"SELECT llm_material, {q.price_tier('CAST(t.price / 40 AS DECIMAL(12,2))')} AS price_tier, count(*) AS total FROM x_flat x JOIN m_texts t ON x.product_id = t.product_id WHERE llm_material IS NOT NULL GROUP BY 1, 2",
)(
    # catalogue prices run to about 2,000; divided by 40 they cover all three tiers
    lambda m: results(m).where("llm_material is not null").join(m.product_texts.select("product_id", (F.col("price") / 40).cast("decimal(12,2)").alias("price")), "product_id")
    .groupBy("llm_material", S.price_tier("price").alias("price_tier")).agg(F.count("*").alias("total"))
)
query(
    "llm_feature_rich_products",
    "SELECT product_id, title, llm_category, llm_feature_count FROM x_flat WHERE llm_feature_count > 5 ORDER BY llm_feature_count DESC, product_id LIMIT 20",
)(lambda m: results(m).where("llm_feature_count > 5").select("product_id", "title", "llm_category", "llm_feature_count").orderBy(F.desc("llm_feature_count"), "product_id").limit(20))
