"""TF-IDF vectors and cosine neighbours of product texts.

Equal texts are collapsed before they are split into terms, and equal vectors into classes before
they are compared. The neighbour search passes over whole cells of classes that cannot reach the
needed similarity (`neighbours`), so terms that all products share cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bazaarlens.operators import neighbours as N
from bazaarlens.operators.ranges import surrogate_key
from bazaarlens.sources.io import stage

TOKEN = r"[\p{L}\p{N}_]{2,}"


# --- weights ------------------------------------------------------------------
def terms(texts: DataFrame) -> DataFrame:
    """(text_id, term, tf) of one- and two-word terms."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))
    pairs = F.transform(
        F.slice(F.col("w"), 1, F.greatest(F.size("w") - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.col("w")[i + 1])
    )
    split = texts.select("text_id", words.alias("w")).select("text_id", F.explode(F.concat("w", pairs)).alias("term"))
    return split.groupBy("text_id", "term").agg(F.count("*").alias("tf"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text_id, text, copies) from (product_id, text_corpus)."""
    return docs.groupBy(F.sha2("text_corpus", 256).alias("text_id")).agg(F.first("text_corpus").alias("text"), F.count("*").alias("copies"))


def vocabulary(counts: DataFrame, copies: DataFrame, min_df: int, max_features: int) -> DataFrame:
    """(term, df): terms of at least `min_df` documents, the most frequent `max_features` of them."""
    seen = counts.join(copies, "text_id").groupBy("term").agg(F.sum("copies").alias("df"), F.sum(F.col("tf") * F.col("copies")).alias("cf"))
    return seen.where(F.col("df") >= min_df).orderBy(F.desc("cf"), "term").limit(max_features).select("term", "df")


def tfidf(docs: DataFrame, min_df: int = 2, max_features: int = 500) -> tuple[DataFrame, DataFrame]:
    """(assignment product_id -> text_id, weights text_id, term, df, weight) with unit length."""
    assigned = docs.select("product_id", F.sha2(F.col("text_corpus"), 256).alias("text_id"))
    texts = distinct_texts(docs)
    counts = terms(texts)
    # at most `max_features` rows, so the broadcast size is bounded
    vocab = F.broadcast(vocabulary(counts, texts.select("text_id", "copies"), min_df, max_features))
    n_docs = docs.select(F.count("*")).scalar()
    idf = F.log((F.lit(1.0) + F.col("n_docs")) / (F.lit(1.0) + F.col("df"))) + 1.0
    raw = counts.join(vocab, "term").withColumn("n_docs", n_docs).withColumn("raw", (F.lit(1.0) + F.log("tf")) * idf)
    length = raw.groupBy("text_id").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"))
    weights = raw.join(length, "text_id").select("text_id", "term", "df", (F.col("raw") / F.col("length")).alias("weight"))
    return assigned, weights


def product_weights(docs: DataFrame) -> DataFrame:
    assigned, weights = tfidf(docs)
    return assigned.join(weights, "text_id").select("product_id", "term", F.round("weight", 6).alias("weight"))


# --- classes of equal vectors ---------------------------------------------------
class VectorClasses:
    """Products grouped by equal vectors, written once to the shared folder."""

    def __init__(self, docs: DataFrame, name: str, top: int = 10):
        assigned, weights = tfidf(docs)
        entry = F.struct("df", "term", "weight")
        vectors = weights.groupBy("text_id").agg(F.array_sort(F.collect_list(entry)).alias("vector"))  # <= max_features entries
        printed = F.transform("vector", lambda e: F.concat_ws(":", e["term"], F.round(e["weight"], 9).cast("string")))
        keyed = vectors.withColumn("class_id", F.sha2(F.array_join(printed, "|"), 256))
        keyed = stage(keyed, f"{name}_vectors")  # read several times below
        lines = assigned.join(keyed.select("text_id", F.col("class_id").alias("digest")), "text_id")
        vector = keyed.groupBy(F.col("class_id").alias("digest")).agg(F.first("vector").alias("vector"))
        sizes = lines.groupBy("digest").agg(F.count("*").alias("n"), F.min("product_id").alias("head")).join(vector, "digest")
        # short dense numbers instead of digests: pairs of them are what gets shuffled
        sizes = stage(sizes, f"{name}_sizes")
        numbered = stage(surrogate_key(sizes, "class_id", ["digest"]), f"{name}_classes")
        self.classes = numbered.drop("digest")
        self.members = stage(lines.join(numbered.select("digest", "class_id"), "digest").select("class_id", "product_id"), f"{name}_members")
        self.top = top

    def first_members(self, n: int) -> DataFrame:
        place = F.row_number().over(W.partitionBy("class_id").orderBy("product_id"))
        return self.members.withColumn("place", place).where(F.col("place") <= n)


def cells(v: VectorClasses, asks: Column | None = None) -> N.Cells:
    """The classes as sparse unit vectors over the vocabulary, dealt to cells."""
    terms = sorted(r[0] for r in v.classes.select(F.explode("vector.term").alias("t")).distinct().collect())  # at most max_features
    place = F.create_map(*(F.lit(x) for i, t in enumerate(terms) for x in (t, i))) if terms else F.lit(None).cast("map<string,int>")
    vectors = v.classes.select("head", "n", F.transform("vector", lambda e: F.element_at(place, e["term"])).alias("at"), F.col("vector.weight").alias("v"))
    return N.cells_of(vectors, len(terms), asks)


def similar_classes(v: VectorClasses, threshold: float) -> DataFrame:
    """All class pairs with cosine >= threshold, named by their smallest product."""
    near, _ = N.classes_above(cells(v), threshold)
    names = v.classes.select("head", "n")
    return (
        near.where("head < other")
        .join(names.withColumnRenamed("n", "members_a"), "head")
        .join(names.select(F.col("head").alias("other"), F.col("n").alias("members_b")), "other")
        .select(F.col("head").alias("product_a"), F.col("other").alias("product_b"), "members_a", "members_b", "similarity")
    )


def neighbour_classes(v: VectorClasses) -> DataFrame:
    """(a, b, similarity): for every class with at most `top` members the `top` nearest other classes, if they share a term."""
    near, _ = N.class_neighbours(cells(v, F.col("n") <= v.top), v.top)
    a, b = (v.classes.select(F.col("class_id").alias(c), F.col("head").alias(h)) for c, h in (("a", "head"), ("b", "other")))
    return near.where("similarity > 0").join(a, "head").join(b, "other").select("a", "b", "similarity")


def recommend(v: VectorClasses) -> DataFrame:
    """(product_id, partner_id, similarity_score, place): the `top` most similar other products.

    Equal vectors come first (similarity 1), then other classes by similarity; ties by product id.
    """
    k = v.top
    heads = v.first_members(k + 1)
    twins = (
        v.members.join(heads.select("class_id", F.col("product_id").alias("partner_id")), "class_id")
        .where("product_id <> partner_id")
        .select("product_id", "partner_id", F.lit(1.0).alias("similarity_score"))
    )
    near = neighbour_classes(v).join(
        heads.where(F.col("place") <= k).select(F.col("class_id").alias("b"), F.col("product_id").alias("partner_id")), "b"
    )
    best = near.withColumn("place", F.row_number().over(W.partitionBy("a").orderBy(F.desc("similarity"), "partner_id"))).where(F.col("place") <= k)
    others = best.join(v.members.withColumnRenamed("class_id", "a"), "a").select(
        "product_id", "partner_id", F.col("similarity").alias("similarity_score")
    )
    order = W.partitionBy("product_id").orderBy(F.desc("similarity_score"), "partner_id")
    return twins.unionByName(others).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def similarity_matrix(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """Cosines among a small chosen set (product_id, place 1..size), one column per member."""
    assigned, weights = tfidf(docs)
    rows = chosen.join(assigned, "product_id").join(weights, "text_id").select("product_id", "place", "term", "weight")
    other = rows.select(F.col("place").alias("other"), "term", F.col("weight").alias("w2"))
    dots = rows.join(other, "term").groupBy("product_id", "place", "other").agg(F.round(F.sum(F.col("weight") * F.col("w2")), 6).alias("s"))
    wide = dots.groupBy("product_id", "place").pivot("other", list(range(1, size + 1))).agg(F.first("s"))
    return wide.select("product_id", "place", *[F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"p{i}") for i in range(1, size + 1)])


def category_fit(docs: DataFrame, categories: DataFrame) -> DataFrame:
    """Dot product of each product vector with the mean vector of its category, on shared terms."""
    assigned, weights = tfidf(docs)
    lines = assigned.join(categories, "product_id").join(weights, "text_id")
    sizes = assigned.join(categories, "product_id").groupBy("category").agg(F.count("*").alias("n"))
    profile = lines.groupBy("category", "term").agg(F.sum("weight").alias("total")).join(sizes, "category")
    profile = profile.select("category", "term", (F.col("total") / F.col("n")).alias("mean_weight"))
    return (
        lines.join(profile, ["category", "term"])
        .groupBy("product_id", "category")
        .agg(F.round(F.sum(F.col("weight") * F.col("mean_weight")), 6).alias("similarity"))
    )
