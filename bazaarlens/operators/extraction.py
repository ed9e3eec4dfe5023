"""Batch extraction of product attributes from text: prompts, calls, validation, reports.

The extractor is any function (title, description) -> JSON text supplied by the caller. Answers are
parsed once to VARIANT, so the kind of every member can be checked by built-in functions.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import fixed
from bazaarlens.functions import scalars as S

SYSTEM = (
    "You catalogue shop products. Answer with one JSON object with the members category, subcategory, brand, material, "
    "target_device, color, features (object of booleans), target_audience and keywords (3 to 8 texts). "
    "Use null for what the text does not say."
)
EXAMPLE = (
    "Red steel bottle, keeps drinks cold",
    '{"category": "Drinkware", "subcategory": "Bottles", "brand": null, "material": "Steel", "target_device": null, "color": "Red", '
    '"features": {"is_insulated": true}, "target_audience": null, "keywords": ["bottle", "steel", "insulated"]}',
)
TEXT_FIELDS = ["category", "subcategory", "brand", "material", "target_device", "color", "target_audience"]


# --- prompts --------------------------------------------------------------------
def user_message(title: Column, description: Column) -> Column:
    return F.concat(
        F.lit('Extract structured features from this product:\n\nTitle: "'), title, F.lit('"\n\nDescription: "'), description, F.lit('"')
    )


def prompt_build(texts: DataFrame, system: str = SYSTEM, example: tuple[str, str] = EXAMPLE) -> DataFrame:
    say = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    messages = F.array(
        say("system", F.lit(system)),
        say("user", F.lit(example[0])),
        say("assistant", F.lit(example[1])),
        say("user", user_message(F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))),
    )
    return texts.select("product_id", messages.alias("messages"))


# --- calls ----------------------------------------------------------------------
ANSWER_SCHEMA = "product_id string, title string, extraction_status string, attempts int, answer string, input_tokens bigint, output_tokens bigint"


# fixed values of the default extractor: words looked for, in order of preference
MATERIALS = ["Leather", "Steel", "Cotton", "Plastic"]
DEVICES = ["Phone", "Tablet", "Laptop"]
COLORS = ["Black", "Red", "Blue", "White"]
AUDIENCES = ["Women", "Men", "Unisex"]
PARTS = ["bolt", "gear", "ring"]
KEYWORDS = 8


#: Letters of a text's head in which the first keywords are looked for; only a text whose head has too few is cut as a whole.
HEAD = 1000


def says(text: Column, folded: Column, word: str) -> Column:
    """Whether a text holds a word or phrase, whole and in any case. `folded` is the text in lower case; only a word whose
    letters occur at all is matched by a pattern."""
    if re.fullmatch(r"[A-Za-z0-9]+", word):
        whole = folded.rlike(rf"(?<![\p{{L}}\p{{N}}]){word.lower()}(?![\p{{L}}\p{{N}}])")
    else:
        plain = re.sub(r"([^\w ])", r"\\\1", word)
        whole = text.rlike(rf"(?i)(^|[^\p{{L}}\p{{N}}]){plain}([^\p{{L}}\p{{N}}]|$)")
    return F.when(F.contains(folded, F.lit(word.lower())), whole).otherwise(False)


def keyword_answers(texts: DataFrame) -> DataFrame:
    """`texts` with the answer of the default extractor in `answer`, as JSON: known words, whole, in the title and description.

    A text is lowered once per row, in a projection of its own; its words are cut only as far as the keywords need them.
    """
    words = lambda c: F.regexp_extract_all(c, F.lit(r"\p{L}{4,}"), F.lit(0))
    title, description = (F.coalesce(c, F.lit("")) for c in ("title", "description"))
    both = F.concat_ws(" ", title, description)
    lowered = texts.withColumns({"_text": both, "_folded": F.lower(both), "_first": words(F.lower(title)), "_rest": F.lower(description)})
    head = words(F.substring("_rest", 1, HEAD))
    # the last word of a head may go on behind it
    cut = lowered.withColumn("_head", F.when(F.length("_rest") <= HEAD, head).otherwise(F.slice(head, 1, F.greatest(F.size(head) - 1, F.lit(0)))))
    cut = cut.withColumn("_named", F.slice(F.array_distinct(F.concat("_first", "_head")), 1, KEYWORDS))
    whole = (F.size("_named") < KEYWORDS) | (F.size("_first") == 0)
    cut = cut.withColumn("_then", F.when(whole & (F.length("_rest") > HEAD), words(F.col("_rest"))).otherwise(F.col("_head")))
    text, folded = F.col("_text"), F.col("_folded")
    last = lambda c: F.get(c, F.size(c) - 1)
    first_of = lambda names: F.coalesce(*(F.when(says(text, folded, n), F.lit(n)) for n in names))
    members = {
        "category": first_of(fixed.PRODUCT_CATEGORIES),
        "subcategory": F.coalesce(last("_first"), last("_then")),
        "brand": F.nullif(F.regexp_extract(title, r"Brand#[0-9]+", 0), F.lit("")),
        "material": first_of(MATERIALS),
        "target_device": first_of(DEVICES),
        "color": first_of(COLORS),
        "features": F.struct(*(says(text, folded, w).alias(f"has_{w}") for w in PARTS)),
        "target_audience": first_of(AUDIENCES),
        "keywords": F.slice(F.array_distinct(F.concat("_first", "_then")), 1, KEYWORDS),
    }
    answer = F.to_json(F.struct(*(c.alias(n) for n, c in members.items())), {"ignoreNullFields": "false"})
    return cut.withColumn("answer", answer).drop("_text", "_folded", "_first", "_rest", "_head", "_named", "_then")


def _says(text: str, folded: str, word: str) -> bool:
    """`says` for one row: `folded` is searched for the letters, then their neighbours are looked at."""
    low = word.lower()
    at = folded.find(low)
    if at < 0:
        return False
    if re.fullmatch(r"[A-Za-z0-9]+", word) is None:
        return re.search(rf"(^|[\W_]){re.escape(word)}([\W_]|$)", text, re.IGNORECASE) is not None
    while at >= 0:
        end = at + len(low)
        if not (folded[at - 1 : at].isalnum() or folded[end : end + 1].isalnum()):
            return True
        at = folded.find(low, at + 1)
    return False


def keyword_answer_of(title: str, description: str) -> str:
    """The default extractor as a function of one row."""
    text = f"{title} {description}"
    folded = text.lower()
    words = lambda t: (m[0] for m in re.finditer(r"[^\W\d_]{4,}", t))
    first_of = lambda names: next((n for n in names if _says(text, folded, n)), None)
    last = lambda t: next(iter(deque(words(t.lower()), maxlen=1)), None)
    brand = re.search(r"Brand#[0-9]+", title)
    keywords: dict[str, None] = {}
    for w in words(folded):  # no further than the last keyword
        keywords[w] = None
        if len(keywords) == KEYWORDS:
            break
    members = {
        "category": first_of(fixed.PRODUCT_CATEGORIES),
        "subcategory": last(title) or last(description),
        "brand": brand and brand[0],
        "material": first_of(MATERIALS),
        "target_device": first_of(DEVICES),
        "color": first_of(COLORS),
        "features": {f"has_{w}": _says(text, folded, w) for w in PARTS},
        "target_audience": first_of(AUDIENCES),
        "keywords": list(keywords),
    }
    return json.dumps(members, ensure_ascii=False, separators=(",", ":"))


def spread(texts: DataFrame) -> DataFrame:
    """Deal the rows of a table that lies in fewer files than there are cores over all cores; others stay as they are, so a
    large table is not moved."""
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.repartition(2 * cores) if len(texts.inputFiles()) < cores else texts


def extract_batch(texts: DataFrame, extractor: Callable[[str, str], str] | None = None, retries: int = 3) -> DataFrame:
    """Answers for every text. The default extractor is built of SQL functions.

    A caller's function is run per Arrow batch; a failing row is retried and then reported as FAILED. That work is one map
    over the partitions of `texts`; `spread` deals few large files over all cores, best before texts are joined to their keys.
    """
    if extractor is None:
        quarter = lambda n, name: F.floor(n / 4).cast("long").alias(name)
        size = F.coalesce(F.length("title"), F.lit(0)) + F.coalesce(F.length("description"), F.lit(0))
        asked = keyword_answers(texts.select("product_id", "title", "description"))
        return asked.select("product_id", "title", F.lit("SUCCESS").alias("extraction_status"), F.lit(1).alias("attempts"), "answer", quarter(size, "input_tokens"), quarter(F.length("answer"), "output_tokens"))

    def attempt(title: str, description: str) -> tuple[str, int, str | None]:
        for n in range(1, retries + 1):
            try:
                answer = extractor(title, description)
                json.loads(answer)
                return "SUCCESS", n, answer
            except Exception:  # noqa: BLE001 - any extractor failure counts as one try
                continue
        return "FAILED", retries, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            title, text = pdf["title"].fillna(""), pdf["description"].fillna("")
            rows = [attempt(a, b) for a, b in zip(title, text)]
            out = pd.DataFrame(rows, columns=["extraction_status", "attempts", "answer"])
            out["product_id"], out["title"] = pdf["product_id"].to_numpy(), pdf["title"].to_numpy()
            out["input_tokens"] = ((title.str.len() + text.str.len()) // 4).to_numpy()
            out["output_tokens"] = out["answer"].fillna("").str.len() // 4
            yield out[["product_id", "title", "extraction_status", "attempts", "answer", "input_tokens", "output_tokens"]]

    return texts.select("product_id", "title", "description").mapInPandas(run, ANSWER_SCHEMA)


# --- validation --------------------------------------------------------------------
def _kind(v: Column) -> Column:
    """object, array, null or scalar; NULL when the member is missing."""
    k = F.schema_of_variant(v)
    return (
        F.when(k.startswith("OBJECT"), "object").when(k.startswith("ARRAY"), "array").when(k == "VOID", "null").when(k.isNotNull(), "scalar")
    )


def parsed(answers: DataFrame) -> DataFrame:
    """Add the members of a well-formed answer object as columns; NULL members for bad text."""
    v = F.try_parse_json("answer")
    get = lambda path, kind: F.try_variant_get(F.col("v"), path, kind)
    return (
        answers.withColumn("v", v)
        .withColumn("members", get("$", "map<string,variant>"))
        .withColumns(
            {
                **{f"llm_{f}": get(f"$.{f}", "string") for f in TEXT_FIELDS},
                "features_kind": _kind(get("$.features", "variant")),
                "flags": get("$.features", "map<string,variant>"),
                "flag_list": get("$.features", "array<variant>"),
                "keywords_kind": _kind(get("$.keywords", "variant")),
                "keywords": get("$.keywords", "array<string>"),
                "features_json": F.to_json(get("$.features", "variant")),
            }
        )
    )


def validate(answers: DataFrame) -> DataFrame:
    """Status, issues (make an answer invalid) and warnings (do not) per answer."""
    p = parsed(answers)
    absent = F.array_except(F.array(*[F.lit(f) for f in fixed.EXTRACTED_FIELDS]), F.map_keys("members"))
    odd = F.array_sort(F.map_keys(F.map_filter("flags", lambda _, x: F.schema_of_variant(x) != "BOOLEAN")))
    n_keywords = F.size("keywords")
    wrong = lambda field, want: F.when(
        F.col(f"{field}_kind").isNotNull() & ~F.col(f"{field}_kind").isin("null", want),
        F.concat(F.lit(f"'{field}' deveria ser {want}, recebeu "), f"{field}_kind"),
    )
    issues = F.array_compact(
        F.array(
            F.when(F.size(absent) > 0, F.concat(F.lit("Campos ausentes: "), F.array_join(absent, ", "))),
            wrong("features", "object"),
            wrong("keywords", "array"),
        )
    )
    category = F.col("llm_category")
    warnings = F.array_compact(
        F.array(
            F.when(F.size(odd) > 0, F.concat(F.lit("Valores nao-booleanos em features: "), F.array_join(odd, ", "))),
            F.when(n_keywords < 2, F.concat(F.lit("Poucas keywords: "), n_keywords.cast("string"))),
            F.when(n_keywords > 10, F.concat(F.lit("Muitas keywords: "), n_keywords.cast("string"))),
            F.when((category != "") & ~category.isin(fixed.PRODUCT_CATEGORIES), F.concat(F.lit("Categoria '"), category, F.lit("' nao esta na lista padrao"))),
        )
    )
    ok = F.col("members").isNotNull()
    return p.withColumns(
        {
            "extraction_status": F.when(ok, "SUCCESS").otherwise("FAILED"),
            "issues": F.when(ok, issues),
            "warnings": F.when(ok, warnings),
            "is_valid": F.coalesce(ok & (F.size(issues) == 0), F.lit(False)),
        }
    )


def flatten(validated: DataFrame) -> DataFrame:
    """The 18-column result row."""
    joined = lambda c: F.when(F.size(c) > 0, F.array_join(c, "; "))
    ok = F.col("extraction_status") == "SUCCESS"
    n_flags = F.coalesce(F.size("flags"), F.size("flag_list"), F.lit(0))
    return validated.select(
        "product_id",
        "title",
        "extraction_status",
        "is_valid",
        joined("issues").alias("validation_issues"),
        joined("warnings").alias("validation_warnings"),
        *[f"llm_{f}" for f in TEXT_FIELDS],
        F.when(ok, n_flags).alias("llm_feature_count"),
        F.when(ok, F.coalesce("features_json", F.lit("{}"))).alias("llm_features_json"),
        F.when(ok, F.coalesce(F.array_join("keywords", ", "), F.lit(""))).alias("llm_keywords"),
        F.when(ok, F.coalesce(F.size("keywords"), F.lit(0))).alias("llm_keywords_count"),
        F.when(ok, F.col("answer")).alias("raw_features"),
    )


# --- reports -------------------------------------------------------------------------
def summary(results: DataFrame) -> DataFrame:
    done = F.count_if(F.col("extraction_status") == "SUCCESS")
    return results.agg(
        F.count("*").alias("n_products"),
        done.alias("n_success"),
        (F.count("*") - done).alias("n_failed"),
        F.count_if("is_valid").alias("n_valid"),
        S.percent(done, F.count("*"), 1).alias("success_pct"),
        S.percent(F.count_if("is_valid"), F.count("*"), 1).alias("valid_pct"),
    )


def distributions(results: DataFrame) -> DataFrame:
    """Category counts, flags per product and keyword-count bins as (kind, value, n)."""
    done = results.where("extraction_status = 'SUCCESS'")
    part = lambda kind, c: done.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "value", "n")
    return reduce(DataFrame.unionByName, [part("category", "llm_category"), part("features", "llm_feature_count"), part("keywords", "llm_keywords_count")])


def filled(c: str) -> Column:
    return F.col(c).isNotNull() & (S.strip(c) != "") & (F.lower(c) != "none")


def fill_rates(results: DataFrame) -> DataFrame:
    done = results.where("extraction_status = 'SUCCESS'")
    row = done.agg(*[S.percent(F.count_if(filled(f"llm_{f}")), F.count("*"), 1).alias(f) for f in TEXT_FIELDS])
    return row.unpivot([], TEXT_FIELDS, "field", "fill_pct")


def cost(usage: DataFrame, images: int = 0) -> DataFrame:
    """Tokens and cost of the run, and both projected to larger catalogues."""
    price = fixed.TOKEN_PRICE_PER_MILLION
    total = usage.agg(F.count("*").alias("requests"), F.sum("input_tokens").alias("tin"), F.sum("output_tokens").alias("tout"))
    dollars = F.col("tin") / 1e6 * price["input"] + F.col("tout") / 1e6 * price["output"] + F.lit(images * fixed.IMAGE_PRICE)
    costed = total.withColumns({"cost": dollars, "tokens": F.col("tin") + F.col("tout")})
    scales = F.explode(F.array(F.lit(None).cast("int"), *[F.lit(s) for s in fixed.COST_SCALES]))
    products = F.coalesce(F.col("scale").cast("double"), F.col("requests").cast("double"))
    return costed.withColumn("scale", scales).select(
        F.when(F.col("scale").isNull(), "run").otherwise("projection").alias("kind"),
        products.cast("bigint").alias("products"),
        F.round(F.col("tokens") / F.col("requests") * products, 0).cast("bigint").alias("tokens"),
        F.round(F.col("cost") / F.col("requests") * products, 6).alias("cost_usd"),
    )


def export(results: DataFrame, model: str, extracted_at: Column) -> DataFrame:
    """Export form: model and time added, flags back as an object (map of text)."""
    return results.withColumns({"llm_model": F.lit(model), "llm_extraction_date": extracted_at}).withColumn(
        "llm_features", F.coalesce(F.try_variant_get(F.try_parse_json("llm_features_json"), "$", "map<string,string>"), F.create_map().cast("map<string,string>"))
    ).drop("llm_features_json")


def quality_targets(validated: DataFrame) -> DataFrame:
    """Rates against their targets, with the layer-two consistency rules."""
    ok = F.col("extraction_status") == "SUCCESS"
    fields = reduce(lambda a, b: a + b, [filled(f"llm_{f}").cast("int") for f in TEXT_FIELDS])
    any_true = F.size(F.map_filter("flags", lambda _, x: F.try_variant_get(x, "$", "boolean"))) > 0
    brand_said = F.rlike("title", F.lit(r"Brand#\d"))
    row = validated.agg(
        S.percent(F.count_if("is_valid"), F.count("*"), 2).alias("schema_compliance"),
        S.percent(F.sum(F.when(ok, fields)), F.count_if(ok) * len(TEXT_FIELDS), 2).alias("field_extraction"),
        S.percent(F.count_if(ok & F.col("llm_category").isin(fixed.PRODUCT_CATEGORIES)), F.count_if(ok), 2).alias("known_category"),
        S.percent(F.count_if(ok & F.size("keywords").between(3, 8)), F.count_if(ok), 2).alias("keywords_3_to_8"),
        S.percent(F.count_if(ok & F.coalesce(any_true, F.lit(False))), F.count_if(ok), 2).alias("some_flag_true"),
        S.percent(F.count_if(ok & (~brand_said | filled("llm_brand"))), F.count_if(ok), 2).alias("brand_when_in_title"),
    )
    targets = {"schema_compliance": 99.0, "field_extraction": 85.0, "known_category": 90.0}  # fixed values
    long = row.unpivot([], row.columns, "metric", "rate")
    target = S.lookup("metric", targets)
    return long.withColumn("target", target).withColumn("met", F.col("rate") > F.col("target"))


LLM_COLUMNS = ["llm_category", "llm_subcategory", "llm_material", "llm_target_device", "llm_color", "llm_keywords", "llm_feature_count"]


def enrich_products(products: DataFrame, results: DataFrame) -> DataFrame:
    """Left join of the inferred columns onto the product dimension."""
    return products.join(results.where("extraction_status = 'SUCCESS'").select("product_id", *LLM_COLUMNS), "product_id", "left")


def presentation_meta(df: DataFrame) -> DataFrame:
    """Copy texts and audience from an answer; a text that is no JSON object becomes the formal copy."""
    v = F.try_parse_json("answer")
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    get = lambda name: F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.lit(""))
    points = F.coalesce(F.try_variant_get(v, "$.keywords", "array<string>"), F.array().cast("array<string>"))
    return df.select(
        "product_id",
        F.when(is_object, get("formal")).otherwise(F.coalesce("answer", F.lit(""))).alias("formal"),
        F.when(is_object, get("casual")).otherwise("").alias("casual"),
        F.when(is_object, get("urgent")).otherwise("").alias("urgent"),
        F.when(is_object, get("target_audience")).otherwise(F.coalesce("answer", F.lit(""))).alias("target_audience"),
        F.when(is_object, F.array_join(points, "|")).otherwise("").alias("seo_keywords"),
    )
