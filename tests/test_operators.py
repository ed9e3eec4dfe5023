"""Operators on literal rows, with results worked out by hand or by brute force."""

import random
from collections import defaultdict
from decimal import Decimal
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.operators import baskets as B
from bazaarlens.operators import cleaning as C
from bazaarlens.operators import embeddings as E
from bazaarlens.operators import extraction as X
from bazaarlens.operators import learning as L
from bazaarlens.operators import quality as Q
from bazaarlens.operators import ranges as R
from bazaarlens.operators import star
from bazaarlens.operators import textvec as V
from bazaarlens.plans import business, quality_suites
from bazaarlens.sources import contracts, io
from bazaarlens.streaming import refresh


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- scalars --------------------------------------------------------------------------
def test_text_scalars(spark):
    df = spark.createDataFrame([("embu-guaçu  do SUL", "São  Paulo\t", "A/b c\\d!é")], "a string, b string, c string")
    got = df.select(S.initcap_words("a"), S.normalize_city("b"), S.slug("c"), S.short_label(F.repeat(F.lit("x"), 70))).first()
    assert tuple(got) == ("Embu-Guaçu  Do Sul", "sao paulo", "a_b_c_dé", "x" * 65 + "...")


def test_rounding_is_half_up_in_decimals(spark):
    df = spark.createDataFrame([(201, 20000), (-5, 1000), (1, 0)], "n int, d int")
    assert [r[0] for r in df.select(S.percent("n", "d")).collect()] == [Decimal("1.01"), Decimal("-0.50"), None]


def test_hour_and_day_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2018-01-01 23:59:00' a, timestamp_ntz'2018-01-02 00:01:00' b")
    got = df.select(S.days_between("a", "b"), S.hours_between("a", "b"), S.floor_days("a", "b"), S.floor_days("b", "a")).first()
    assert tuple(got) == (1, 1, 0, -1)


def test_safe_casts(spark):
    df = spark.createDataFrame([("225.0",), ("abc",), ("12.345",), (None,)], "x string")
    got = df.select(S.safe_int("x"), S.safe_decimal("x"), S.safe_timestamp("x")).collect()
    assert [r[0] for r in got] == [225, None, 12, None]
    assert [r[1] for r in got] == [Decimal("225.00"), None, Decimal("12.35"), None]


# --- cleaning ---------------------------------------------------------------------------
def test_trusted_orders_keeps_latest_and_marks_delay(spark):
    data = [
        ("1", "c", " delivered ", "2018-01-01 10:00:00", "2018-13-01 00:00:00", None, "2018-01-20 02:00:00", "2018-01-20 00:00:00"),
        ("1", "c", "delivered", "2017-01-01 10:00:00", None, None, None, None),
        ("2", None, "created", "2018-01-01 10:00:00", None, None, None, None),
    ]
    cols = ["order_id", "customer_id", "order_status", *C.ORDER_TIMES]
    out = C.trusted_orders(spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))).collect()
    assert len(out) == 1
    assert (out[0].order_status, out[0].delivery_days, out[0].delivery_delay_days, out[0].delivery_status) == ("DELIVERED", 19, 0, "LATE")
    assert out[0].order_approved_at is None


def test_quarantine_rejects_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (99.0,)], "lat double")
    good, bad = C.split_quarantine(df, F.col("lat") < 5)
    assert (good.count(), bad.count()) == (1, 2)


def test_repeat_customer_orders_drop_out_but_bridge_keeps_them(spark):
    raw = spark.createDataFrame([("a", "p", "1037", "x", "SP"), ("b", "p", "1037", "x", "SP")], "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string")
    people = C.trusted_customers(raw)
    assert [r.customer_id for r in people.collect()] == ["a"]
    keyed = people.withColumn("customer_key", F.lit(7).cast("bigint"))
    assert sorted(rows(star.customer_bridge(raw, keyed))) == [("a", 7), ("b", 7)]


# --- ranges --------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 7, 1500])
def test_surrogate_key_is_dense_and_ordered(spark, n):
    ids = [f"k{i:05d}" for i in range(n)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    assert sorted(rows(R.surrogate_key(df, "sk", ["id"], ranges=8))) == [(i + 1, k) for i, k in enumerate(sorted(ids))]


def test_quantiles_and_ranks_with_a_hot_value(spark):
    rng = random.Random(3)
    values = [5.0] * 700 + [rng.uniform(0, 10) for _ in range(1300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(6)
    got = R.exact_quantiles(df, "v", {"a": 0.5, "b": 0.99}, ranges=8).first()
    assert np.allclose([got.a, got.b], np.percentile(values, [50, 99]))
    ranks = {r.id: r.p for r in R.percent_ranks(df, {"p": ("v", False)}).select("id", "p").collect()}
    ordered = sorted(values)
    assert all(abs(ranks[i] - ordered.index(v) / (len(values) - 1)) < 1e-12 for i, v in list(enumerate(values))[::97])


# --- baskets --------------------------------------------------------------------------------
def brute_partners(lines):
    orders, partners = defaultdict(set), defaultdict(set)
    for o, p in lines:
        orders[o].add(p)
    for products in orders.values():
        for p in products:
            partners[p] |= products - {p}
    return {p: len(s) for p, s in partners.items() if s}, partners


def test_partner_counts_with_large_baskets(spark):
    rng = random.Random(5)
    lines = [("hot", f"p{i}") for i in range(40)] + [("hot2", f"p{i}") for i in range(30, 75)]
    lines += [(f"o{rng.randrange(60)}", f"p{rng.randrange(90)}") for _ in range(200)]
    items = spark.createDataFrame([(o, 1, p) for o, p in lines], "order_id string, order_item_id int, product_id string")
    counts, partners = brute_partners(lines)
    for limit in (10, 1000):
        assert dict(rows(B.partner_counts(items, limit).select("product_id", "n_partners"))) == counts
    pairs = [(f"p{i}", f"p{j}") for i in range(20) for j in range(20, 80, 7)]
    candidates = spark.createDataFrame(pairs, "product_id string, partner_id string")
    assert sorted(rows(B.bought_together(items, candidates))) == sorted((a, b) for a, b in pairs if b in partners[a])


def test_basket_lists_split_large_orders(spark):
    items = spark.range(50).select(F.lit("o").alias("order_id"), F.col("id").alias("order_item_id"), F.col("id").cast("string").alias("product_id"))
    parts = B.basket_lists(items, chunk=10).collect()
    assert len(parts) > 1 and sorted(p for r in parts for p in r.products) == sorted(str(i) for i in range(50))


# --- text vectors ------------------------------------------------------------------------------
def test_recommendations_equal_brute_force(spark):
    rng = random.Random(11)
    kinds = [f"kind {a} line {b}" for a in ("red", "blue", "green") for b in range(10, 16)]
    docs = [(f"p{i:03d}", f"{rng.choice(kinds)} peso {rng.randrange(10, 22) * 50} volume {rng.randrange(100, 108)}") for i in range(150)]
    docs += [(f"t{i:03d}", "red twin peso 900 volume 103") for i in range(9)]
    df = spark.createDataFrame(docs, "product_id string, text_corpus string")
    k = 4
    weights = defaultdict(dict)
    assigned, w = V.tfidf(df)
    for p, t, x in rows(assigned.join(w, "text_id").select("product_id", "term", "weight")):
        weights[p][t] = x
    assert all(abs(sum(x * x for x in v.values()) - 1) < 1e-9 for v in weights.values())
    want = {}
    for a in weights:
        scored = [(-round(sum(x * weights[b].get(t, 0.0) for t, x in weights[a].items()), 6), b) for b in weights if b != a]
        want[a] = [(b, -s) for s, b in sorted(scored)[:k]]
    got = defaultdict(list)
    for r in V.recommend(V.VectorClasses(df, "test_rec", k)).orderBy("product_id", "place").collect():
        got[r.product_id].append((r.partner_id, r.similarity_score))
    assert got == want


def test_zero_shot_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 2)
    data = [(str(i), [float(i % 5 == j) + 0.01 * i for j in range(5)], f"c{i % 5}" if i < 20 else None) for i in range(30)]
    df = spark.createDataFrame(data, "product_id string, embedding array<float>, label string")
    out = {r.product_id: r.assigned_category for r in E.zero_shot(df, "label", 5).collect()}
    assert out == {str(i): f"c{i % 5}" for i in range(20, 30)}


# --- learning ----------------------------------------------------------------------------------
def test_forest_learns_and_split_is_stable(spark):
    rng = random.Random(2)
    data = [(str(i), 1, rng.randrange(5), rng.randrange(5), float(rng.randrange(100)), 1.0, Decimal(1), Decimal(2), i % 2) for i in range(400)]
    df = spark.createDataFrame(
        data,
        "order_id string, order_item_id int, seller_state_enc int, customer_state_enc int, product_weight_g double, product_volume_cm3 double, freight_value decimal(12,2), price decimal(12,2), same_state int",
    ).withColumn("delivery_days", F.col("product_weight_g") / 10 + F.col("same_state"))
    split = L.train_test_split(df)
    assert rows(split.orderBy("order_id")) == rows(L.train_test_split(df.repartition(7)).orderBy("order_id"))
    small = {"numTrees": 5, "maxDepth": 6}
    model = L.fit_forest(split.where("part = 'train'"), **small)
    score = L.regression_metrics(L.predict(model, split.where("part = 'test'")), "delivery_days", "prediction").first()
    assert score.r2 > 0.8
    assert L.feature_importance(spark, model).first().feature in ("product_weight_g", "same_state")
    summary = L.cross_validation_summary(L.cross_validate(split, folds=2, **small)).first()
    assert summary.folds == 2 and summary.cv_rmse_mean > 0


# --- quality -------------------------------------------------------------------------------------
def test_rules_ignore_nulls_and_count_all_repeats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 9)], "k string, v int")
    rules = [
        Q.Rule("t", "unique", "k", "uniqueness"),
        Q.Rule("t", "between", "v", "validity", (1, 5), 0.6),
        Q.Rule("t", "not_null", "k", "completeness"),
        Q.Rule("t", "row_count", "TABLE", "volume", (1, 3)),
        Q.Rule("t", "check", "v", "validity", ("v > 0",), 1.0, True),
        Q.Rule("t", "refers", "k", "consistency", ("p", "k")),
    ]
    parent = spark.createDataFrame([("a",)], "k string")
    got = {r.rule: (r.total, r.unexpected, r.passed) for r in Q.run_rules({"t": df, "p": parent}, rules).collect()}
    assert got == {
        "unique": (3, 2, False), "between": (3, 1, True), "not_null": (4, 1, False), "row_count": (4, 4, False),
        "check: v > 0": (4, 1, False), "refers": (2, 1, False),
    }


def test_rule_set_sizes():
    assert (len(quality_suites.EXPECTATIONS), len(quality_suites.CATALOG), len(quality_suites.STAR_CONTRACTS)) == (81, 52, 10)
    assert len(quality_suites.REFERENCES + quality_suites.DATE_ORDERS) == 11


def test_contracts(spark):
    found = contracts.contracts()
    assert len(found) == 25 and sum(c.zone == "raw" for c in found.values()) == 9
    df = spark.createDataFrame([("o", 1)], "order_id string, order_item_sequence int")
    assert contracts.apply_contract(df, found["fact_orders"]).first().customer_key == -1


# --- extraction -------------------------------------------------------------------------------------
def test_extract_retries_and_reports_failures(spark):
    texts = spark.createDataFrame([("1", "good ring", "x"), ("2", "bad", "y")], "product_id string, title string, description string")

    def sometimes(title, description):
        if title == "bad":
            raise TimeoutError
        return '{"category": "Audio"}'

    got = {r.product_id: (r.extraction_status, r.attempts) for r in X.extract_batch(texts, sometimes, retries=2).collect()}
    assert got == {"1": ("SUCCESS", 1), "2": ("FAILED", 2)}
    assert X.extract_batch(texts).where("extraction_status = 'SUCCESS'").count() == 2


def test_example_answer_validates(spark):
    df = spark.createDataFrame([("1", "t", X.EXAMPLE[1])], "product_id string, title string, answer string")
    row = X.flatten(X.validate(df)).first()
    assert row.is_valid and row.validation_warnings is None and len(row) == 18


# --- streaming -----------------------------------------------------------------------------------------
def test_upsert_is_safe_to_replay(spark, tmp_path):
    order = lambda df: C.total_order(df, F.col("v").desc())
    sink = refresh.Upsert(str(tmp_path / "t"), lambda df: df, ["k"], order)
    one = spark.createDataFrame([("a", 1), ("b", 5)], "k string, v int")
    two = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "k string, v int")
    for batch, n in [(one, 0), (two, 1), (two, 1)]:
        sink(batch, n)
    assert sorted(rows(sink.table(spark, one.schema))) == [("a", 3), ("b", 5), ("c", 1)]
    again = refresh.Upsert(str(tmp_path / "t"), lambda df: df, ["k"], order)
    assert again.table(spark, one.schema).count() == 3


# --- plans ------------------------------------------------------------------------------------------------
def test_funnel_share_can_pass_one_hundred(spark):
    df = spark.createDataFrame([("1", "created"), ("2", "delivered"), ("3", "delivered")], "order_id string, order_status string")
    assert [r["% Relativo ao Topo do Funil"] for r in business.status_funnel(df).collect()] == [Decimal("100.00"), Decimal("200.00")]


def test_scan_reads_only_needed_columns(spark, root):
    from bazaarlens.sources.market import Market

    m = Market(spark, root)
    plan = business.average_ticket(m.order_items)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_extendedprice" in plan


def test_work_dir_prefers_the_shared_folder():
    context = SimpleNamespace(applicationId="app-1", master="spark://x", getCheckpointDir=lambda: None)
    conf = {"spark.checkpoint.dir": "hdfs:///shared/"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)
    assert io.work_dir(session) == "hdfs:///shared/bazaarlens-app-1"
    conf.clear()
    with pytest.raises(ValueError):
        io.work_dir(session)


def test_cleaners_take_numbers_that_fit_nothing(spark):
    numbers = ["product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    rows = [("a", "x", *["NaN"] * 7), ("b", "x", *["1e12"] * 7), ("c", "x", *["-inf"] * 7), ("d", "x", "1", "1", "1", "1", "3000", "3000", "3000"), ("e", None, *[None] * 7)]
    products = spark.createDataFrame(rows, "product_id string, product_category_name string, " + ", ".join(f"{c} string" for c in numbers))
    words = spark.createDataFrame([("x", "ex")], "product_category_name string, product_category_name_english string")
    got = {r["product_id"]: r for r in C.clean_products(products, words).collect()}
    assert all(got[k]["product_weight_g"] == 0 and got[k]["product_volume_cm3"] == 0 for k in "abce") and got["d"]["product_volume_cm3"] == 27_000_000_000
    reviews = spark.createDataFrame([("r1", "NaN"), ("r2", "inf"), ("r3", "4.9"), ("r4", "1e12"), ("r5", None)], "review_id string, review_score string").selectExpr(
        "review_id", "'o' as order_id", "review_score", "'' as review_comment_title", "'' as review_comment_message", "timestamp'2020-01-01' as review_creation_date", "timestamp'2020-01-01' as review_answer_timestamp"
    )
    assert [(r["review_id"], r["review_score"]) for r in C.clean_order_reviews(reviews).collect()] == [("r3", 4)]


def test_type_two_merge_sees_values_that_trade_places_with_null(spark):
    old = spark.createDataFrame([(1, "x", None), (2, "x", None)], "k int, a string, b string")
    history = old.selectExpr("*", "timestamp_ntz'2020-01-01' as _dw_valid_from", "cast(null as timestamp_ntz) as _dw_valid_to", "true as _dw_is_current")
    new = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "k int, a string, b string")
    rows = C.scd2_merge(history, new, ["k"], ["a", "b"], F.lit("2021-01-01").cast("timestamp_ntz")).collect()
    assert sorted((r["k"], r["_dw_is_current"]) for r in rows) == [(1, False), (1, True), (2, True)]


def test_large_basket_is_listed_in_ordered_parts(spark):
    items = spark.createDataFrame([("big", i, f"p{i:05d}") for i in range(1500)] + [("small", 1, "z"), ("small", 2, "a")], "order_id string, order_item_id int, product_id string")
    parts = {(r["order_id"], r["part"]): r["products"] for r in B.basket_lists(items).collect()}
    assert parts["small", 0] == ["a", "z"]
    assert parts["big", 0] + parts["big", 1] == [f"p{i:05d}" for i in range(1500)] and len(parts["big", 0]) == 1000


def test_staged_tables_stay_readable(spark):
    first = io.stage(spark.range(3), "same-name")
    second = io.stage(spark.range(5), "same-name")
    assert (first.count(), second.count()) == (3, 5)
    io.replace_table(spark.range(2).toDF("n"), "replaced_here")
    assert io.replace_table(spark.range(4).toDF("n"), "replaced_here").count() == 4
    path = io.fresh_path(spark, "appended")
    table = spark.createDataFrame([(1, "a")], "n bigint, s string")
    table.write.parquet(path)
    io.insert_rows(table, spark.createDataFrame([(7,)], "n int"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (7, None)]


def test_views_keep_every_fact_row(spark, root):
    from bazaarlens.queries.q03_star import Warehouse
    from bazaarlens.sources.market import Market

    w = Warehouse(Market(spark, root))
    assert star.vw_sales_analysis(w.fact_orders, w.dates, w.dim_customer, w.dim_product, w.dim_seller).count() == w.fact_orders.count()
    assert star.vw_satisfaction_analysis(w.fact_reviews, w.dates, w.dim_customer, w.dim_product).count() == w.fact_reviews.count()


def test_default_extractor_matches_whole_words(spark):
    import json

    texts = spark.createDataFrame([("1", "Steel hundred women bottle", "It is read by MEN."), ("2", None, None)], "product_id string, title string, description string")
    answers = {r["product_id"]: json.loads(r["answer"]) for r in X.extract_batch(texts).collect()}
    assert answers["1"]["color"] is None and answers["1"]["material"] == "Steel" and answers["1"]["target_audience"] == "Women"
    assert answers["1"]["keywords"] == ["steel", "hundred", "women", "bottle", "read"] and answers["2"]["keywords"] == []


def test_extractors_read_long_texts_to_their_end(spark):
    import json

    far = "ab " * 500
    cases = [
        ("", far + "bottle " * 3 + "Smart Home steel_red"),  # words behind the head only
        ("x", "wordy" * 300 + " alpha"),  # one word longer than the head
        ("x", "aaaa bbbb cccc dddd eeee ffff gggg hhhh iiii " + far + "kitchen"),
        ("strings", "ringed ring " + far + "Black Phones"),
        ("", "aaaa bbbb cccc dddd eeee ffff gggg " + far + "hhhh last"),
    ]
    texts = spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(cases)], "product_id string, title string, description string")
    built_in = {r["product_id"]: json.loads(r["answer"]) for r in X.extract_batch(texts).collect()}
    assert built_in == {str(i): json.loads(X.keyword_answer_of(a, b)) for i, (a, b) in enumerate(cases)}
    assert built_in["0"]["keywords"] == ["bottle", "smart", "home", "steel"] and built_in["0"]["color"] == "Red"
    assert built_in["1"]["keywords"] == ["wordy" * 300, "alpha"] and built_in["4"]["subcategory"] == "last"
    assert built_in["3"]["features"] == {"has_bolt": False, "has_gear": False, "has_ring": True}


def test_texts_are_not_moved_once_per_product(spark, tmp_path):
    import bazaarlens.queries  # noqa: F401
    from bazaarlens.oracle import registry

    spark.range(40).selectExpr("id AS p_partkey", "'Brand#1' AS p_brand", "'red' AS p_name", "'ECONOMY' AS p_type", "1.0D AS p_retailprice").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(5).selectExpr("id AS doc_id", "repeat('steel ', 9) AS text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    done = registry.QUERIES["llm_extract_batch"](spark, str(tmp_path))
    assert done.count() == 40
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan and plan.index("Join") < plan.index("Repartition")  # dealt below the join, not above it


def grown(model) -> list[list[tuple]]:
    """The trees of a fitted forest as plain nodes (feature, threshold, left, right, value, gain, rows), by node number."""
    rows = model.stages[-1].toDebugString  # the shape is checked against the node table below
    assert rows.count("Tree ") == model.stages[-1].getNumTrees

    def walk(node, out):
        place = len(out)
        out.append(None)
        if node.getClass().getSimpleName() == "LeafNode":
            out[place] = (-1, 0.0, -1, -1, node.prediction(), 0.0, node.impurityStats().count())
        else:
            left, right = walk(node.leftChild(), out), walk(node.rightChild(), out)
            out[place] = (node.split().featureIndex(), node.split().threshold(), left, right, node.prediction(), node.gain(), node.impurityStats().count())
        return place

    trees = []
    for tree in model.stages[-1]._java_obj.trees():
        nodes = []
        walk(tree.rootNode(), nodes)
        trees.append(nodes)
    return trees


def test_forest_predictions_and_importances_follow_from_its_trees(spark):
    random.seed(3)
    data = [(f"o{i}", 1, i % 3, i % 4, float(random.randint(100, 9000)), float(random.randint(10, 500)), 10.0 * (i % 7), float(i % 11), i % 2, 1.0 + (i % 3) * 4 + random.random()) for i in range(600)]
    lines = spark.createDataFrame(data, "order_id string, order_item_id int, seller_state_enc int, customer_state_enc int, product_weight_g double, product_volume_cm3 double, freight_value double, price double, same_state int, delivery_days double")
    model = L.fit_forest(lines, numTrees=5, maxDepth=4)
    trees = grown(model)
    inputs = np.array([[float(v) for v in r[2:9]] for r in data])
    sums = np.zeros(len(inputs))
    for nodes in trees:
        for k, x in enumerate(inputs):
            at = 0
            while nodes[at][0] >= 0:
                at = nodes[at][2] if x[nodes[at][0]] <= nodes[at][1] else nodes[at][3]
            sums[k] += nodes[at][4]
    got = {r["order_id"]: r["prediction"] for r in L.predict(model, lines).collect()}
    assert np.allclose([got[r[0]] for r in data], sums / len(trees))
    shares = np.zeros(len(L.FEATURES))
    for nodes in trees:
        own = np.zeros(len(L.FEATURES))
        for feature, _, _, _, _, gain, n in nodes:
            if feature >= 0:
                own[feature] += gain * n
        shares += own / own.sum()
    wanted = dict(zip(L.FEATURES, shares / shares.sum()))
    weights = L.feature_importance(spark, model).collect()
    assert [r["importance"] for r in weights] == sorted((r["importance"] for r in weights), reverse=True)
    assert all(abs(wanted[r["feature"]] - r["importance"]) < 1e-9 for r in weights)


def test_cross_validation_is_the_mean_over_its_folds(spark):
    random.seed(4)
    data = [(f"o{i}", 1, i % 3, 0, 100.0, 10.0, 5.0, 5.0, 0, float(i % 3)) for i in range(200)]
    lines = spark.createDataFrame(data, "order_id string, order_item_id int, seller_state_enc int, customer_state_enc int, product_weight_g double, product_volume_cm3 double, freight_value double, price double, same_state int, delivery_days double")
    folds = L.cross_validate(lines, 3, numTrees=3, maxDepth=3)
    rows = folds.collect()
    got = L.cross_validation_summary(folds).first()
    errors = [r["rmse"] for r in rows]
    assert sum(r["n"] for r in rows) == 200 and got["folds"] == 3
    assert abs(got["cv_rmse_mean"] - np.mean(errors)) < 1e-5 and abs(got["cv_rmse_std"] - np.std(errors)) < 1e-5


def test_trusted_volume_takes_fractions_and_huge_sizes(spark):
    numbers = "product_name_lenght string, product_description_lenght string, product_photos_qty string, product_weight_g string, product_length_cm string, product_height_cm string, product_width_cm string"
    rows_ = [("a", "x", "1", "1", "1", "1", "10.5", "2", "2"), ("b", "x", "1", "1", "1", "1", "1e30", "2", "2"), ("c", "x", "1", "1", "1", "1", "1e300", "1e300", "2"), ("d", None, *[None] * 7)]
    words = spark.createDataFrame([("x", "ex")], "product_category_name string, product_category_name_english string")
    products = spark.createDataFrame(rows_, "product_id string, product_category_name string, " + numbers)
    got = {r["product_id"]: r["product_volume_cm3"] for r in C.trusted_products(products, words).collect()}
    assert got == {"a": 42.0, "b": 4e30, "c": float("inf"), "d": 0.0}


def test_forest_keeps_node_ids_and_few_partitions(spark):
    data = [(f"o{i}", 1, i % 3, 0, 100.0, 10.0, 5.0, 5.0, 0, float(i % 3)) for i in range(60)]
    lines = spark.createDataFrame(data, "order_id string, order_item_id int, seller_state_enc int, customer_state_enc int, product_weight_g double, product_volume_cm3 double, freight_value double, price double, same_state int, delivery_days double")
    kept, walked = L.fit_forest(lines, numTrees=3, maxDepth=3), L.fit_forest(lines, numTrees=3, maxDepth=3, cacheNodeIds=False)
    assert kept.stages[-1].getCacheNodeIds()
    assert grown(kept) == grown(walked)
    assert [L.forest_parts(n) for n in (0, 120_000, 400_000, 720_000, 7_200_000)] == [8, 8, 8, 12, 36]


def test_date_keys_by_arithmetic_equal_the_formatted_date(spark):
    days = ["2017-01-02 23:59:59", "0001-03-04 00:00:00", "0000-02-29 00:00:00", "-0005-02-27 00:00:00", "12000-01-01 00:00:00", "9999-12-31 10:00:00", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp_ntz").alias("d"))
    got = df.select(S.date_key("d").alias("key"), F.date_format("d", "yyyyMMdd").cast("int").alias("formatted"))
    assert all(r["key"] == r["formatted"] for r in got.collect())
    assert "date_format" not in df.select(S.date_key("d"))._jdf.queryExecution().toString()
    assert dict(got.dtypes)["key"] == "int"


def test_facts_read_once_are_made_without_a_written_table(spark, root):
    from bazaarlens.queries.q03_star import Warehouse
    from bazaarlens.sources.market import Market

    w = Warehouse(Market(spark, root))
    read = lambda df: [f for f in df.inputFiles() if "/fact_orders-" in f]
    assert not read(w.fact_lines.select("order_id", "price")) and read(w.fact_orders)
    assert rows(w.fact_lines.groupBy("order_status").agg(F.sum("price")).orderBy("order_status")) == rows(w.fact_orders.groupBy("order_status").agg(F.sum("price")).orderBy("order_status"))


def test_star_tables_are_kept_once_by_name(spark, root):
    from bazaarlens.queries.q01_sources import LandingView
    from bazaarlens.sources.market import Market

    kept = []
    star.build_refined(C.build_trusted(LandingView(Market(spark, root))), lambda df, name: (kept.append(name), df)[1])
    assert kept == ["dim_customer", "dim_product", "dim_seller", "fact_orders"]


def test_small_baskets_are_listed_by_one_grouping(spark):
    data = [("a", "p2", 1), ("a", "p1", 2), (None, "p3", 1), (None, "p0", 2), ("b", None, 1)]
    lists = B.basket_lists(spark.createDataFrame(data, "order_id string, product_id string, order_item_id int"))
    assert "Window" not in lists._jdf.queryExecution().toString()
    got = {r["order_id"]: (r["part"], r["products"]) for r in lists.collect()}
    assert got == {"a": (0, ["p1", "p2"]), None: (0, ["p0", "p3"]), "b": (0, [])}
    both = spark.createDataFrame([*data, *((None, f"q{i}", i) for i in range(4))], "order_id string, product_id string, order_item_id int")
    got = {(r["order_id"], r["part"]): r["products"] for r in B.basket_lists(both, 4).collect()}
    assert got == {("a", 0): ["p1", "p2"], ("b", 0): [], (None, 0): ["p0", "p3", "q0", "q1"], (None, 1): ["q2", "q3"]}


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_facts_without_payments_have_the_same_rows(spark, root):
    from bazaarlens.queries.q03_star import Warehouse
    from bazaarlens.sources.market import Market

    w = Warehouse(Market(spark, root))
    bare = w.unpaid_lines
    assert set(w.fact_lines.columns) - set(bare.columns) == {"payment_type", "payment_installments", "payment_value"}
    whole = w.fact_lines.select(*bare.columns)
    assert bare.count() > 0 and bare.exceptAll(whole).isEmpty() and whole.exceptAll(bare).isEmpty()


def test_first_item_moves_only_its_columns(spark):
    from bazaarlens.operators import star

    rows = [("1", 2, "b", "s"), ("1", 1, "z", "s"), ("1", 1, "y", "t"), ("2", None, "c", "s"), ("2", 5, "d", None), ("3", None, "e", "s"), (None, 1, "f", "s")]
    first = star.first_item(spark.createDataFrame(rows, "order_id string, order_item_id int, product_id string, seller_id string"))
    assert {tuple(r) for r in first.collect()} == {("1", "y"), ("2", "d"), ("3", "e"), (None, "f")}
    assert "seller_id" not in plan_of(first).split("Optimized Logical Plan")[1].split("LogicalRDD")[0]


def test_keys_are_grouped_as_they_are(spark):
    from bazaarlens.operators import contract_checks as K
    from bazaarlens.sources.contracts import contracts

    contract = contracts()["stg_order_items"]
    rows = [("1", 1), ("1", 1), ("1", 2), (None, 1), (None, 1), ("2", None), ("2", None), ("1", 1)]
    found = K.check_key(contract, "PRIMARY KEY", ["order_id", "order_item_id"], spark.createDataFrame(rows, "order_id string, order_item_id int"), {})
    assert [(r["n_rows"], r["n_faults"]) for r in found.collect()] == [(8, 2)]
    assert "sha2" not in plan_of(found)


def test_file_names_are_not_cut_out_of_paths_row_by_row(spark, tmp_path):
    from bazaarlens.operators import clustering
    from bazaarlens.streaming import views

    df = spark.range(500).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    stats = clustering.write_clustered(df, str(tmp_path / "c"), ["a", "b"], "a", 100)
    names = {p.name for p in (tmp_path / "c/rows").iterdir() if p.name.startswith("part-")}
    assert {r["file"] for r in stats.collect()} == names and stats.agg(F.sum("n_rows")).first()[0] == 500
    parts = views.Parts(str(tmp_path / "p"), df.schema)
    parts.write(df.withColumn("part", F.when(F.col("a") < 100, "2018-01-02").otherwise("none")), 3, ["2018-01-02", "none"])
    read = parts.with_part(spark)
    assert {(r["part"], r["count"]) for r in read.groupBy("part").count().collect()} == {("2018-01-02", 100), ("none", 400)}
    assert read.columns == ["a", "b", "part"] and "regexp_extract" not in plan_of(read)


def test_forest_over_many_blocks_is_the_one_over_a_single_block(spark, monkeypatch):
    """Trees grown level by level over blocks are those that a task grows from all rows, and do not depend on partitions."""
    random.seed(5)
    data = [(f"o{i}", 1, i % 3, i % 4, float(random.randint(100, 9000)), float(random.randint(10, 500)), 10.0 * (i % 7), float(i % 11), i % 2, 1.0 + (i % 3) * 4 + random.random()) for i in range(900)]
    lines = spark.createDataFrame(data, "order_id string, order_item_id int, seller_state_enc int, customer_state_enc int, product_weight_g double, product_volume_cm3 double, freight_value double, price double, same_state int, delivery_days double")
    one = grown(L.fit_forest(lines, numTrees=4, maxDepth=5))
    monkeypatch.setattr(L.forest, "BLOCK_ROWS", 200)
    many = grown(L.fit_forest(lines.repartition(5), numTrees=4, maxDepth=5))
    shape = lambda trees: [[(n[0], n[1], n[2], n[3], n[6]) for n in nodes] for nodes in trees]
    assert shape(one) == shape(many) and max(len(nodes) for nodes in one) > 15
    assert all(abs(a[4] - b[4]) < 1e-9 for x, y in zip(one, many) for a, b in zip(x, y))


def test_forest_bins_come_from_all_rows(spark):
    df = spark.range(100_000).selectExpr("cast(id % 5 as double) AS few", "cast(id * id as double) - 100 AS many", "1.0D AS same")
    few, many, same = L.forest.thresholds_of(df, ["few", "many", "same"])
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5] and len(same) == 0
    parts = np.bincount(np.searchsorted(many, [i * i - 100.0 for i in range(100_000)]))
    assert len(parts) == 32 and parts.min() > 2900 and parts.max() < 3350
    drawn = np.bincount(L.forest.drawn(np.random.default_rng(1).integers(0, 2**32, 200_000).astype(np.uint32), 3, 42))
    assert abs(drawn[0] / 200_000 - np.exp(-1)) < 0.005 and abs((drawn * np.arange(len(drawn))).sum() / 200_000 - 1) < 0.01


def test_partner_pairs_are_shuffled_in_one_direction(spark):
    """The pairs of small baskets are made distinct in one direction and turned afterwards."""
    from bazaarlens.operators import baskets

    items = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "y"), ("b", "z"), ("c", "x"), (None, "z"), ("d", None), ("e", "x"), ("e", "y")], "order_id string, product_id string")
    got = baskets.partner_counts(items)
    assert {r["product_id"]: r["n_partners"] for r in got.collect()} == {"x": 1, "y": 2, "z": 1}
    assert dict(got.dtypes) == {"product_id": "string", "n_partners": "bigint"}
    lines = baskets.basket_lines(items)
    plan = baskets.small_pairs(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate") and "(product_id" in plan.split("Join Inner")[1].split("\n")[0] and " < " in plan.split("Join Inner")[1].split("\n")[0]
    some_large = baskets.partner_counts(items.unionAll(spark.createDataFrame([("f", "x"), ("f", "y"), ("f", "w")], items.schema)), limit=2)
    assert {r["product_id"]: r["n_partners"] for r in some_large.collect()} == {"x": 2, "y": 3, "z": 1, "w": 2}


def test_candidates_meet_listed_pairs_and_large_baskets(spark):
    """Candidates are found in small baskets by the distinct pairs, in larger ones by the lines; a product meets itself."""
    from bazaarlens.operators import baskets

    items = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("b", "z"), ("b", "w"), ("c", "v"), (None, "v"), ("d", None)], "order_id string, product_id string")
    asked = [("x", "y"), ("y", "x"), ("y", "x"), ("x", "z"), ("w", "z"), ("v", "x"), ("v", "v"), ("q", "q"), (None, "x"), ("x", None)]
    candidates = spark.createDataFrame(asked, "product_id string, partner_id string")
    want = {("x", "y"), ("y", "x"), ("w", "z"), ("v", "v")}
    for limit in (2, 1000):
        got = [tuple(r) for r in baskets.bought_together(items, candidates, limit).collect()]
        assert set(got) == want and len(got) == len(want)
    plan = baskets.bought_together(items, candidates)._jdf.queryExecution().optimizedPlan().toString()
    assert "low" in plan and plan.count("LeftSemi") == 3
