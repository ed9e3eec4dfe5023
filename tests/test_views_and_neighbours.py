"""Views kept by streams, and exact neighbours, against recomputation and brute force."""

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import neighbours as N
from bazaarlens.operators import star
from bazaarlens.plans import business
from bazaarlens.streaming import views

ORDERS, ITEMS, PAYMENTS = (views.ROWS[k] for k in ("orders", "order_items", "order_payments"))


def at(day, month=1, year=2018):
    return dt.datetime(year, month, day, 12)


def order(i, status="delivered", bought=None, customer="c1"):
    return (i, customer, status, bought or at(1), None, at(20))


def changes(spark, rows):
    """(kind, op, minute, row) tuples as changes."""
    out = spark.createDataFrame([], views.change_schema())
    for kind, op, minute, row in rows:
        df = spark.createDataFrame([row], views.ROWS[kind])
        out = out.unionByName(views.changes_of(kind, df, F.lit(dt.datetime(2020, 1, 1, 0, minute)), op))
    return out


@pytest.fixture(scope="module")
def dims(spark):
    return SimpleNamespace(
        dim_customer=spark.createDataFrame([("c1", 1), ("c2", 2)], "customer_id string, customer_sk bigint"),
        dim_product=spark.createDataFrame([("p", 7)], "product_id string, product_sk bigint"),
        dim_seller=spark.createDataFrame([("s", 8)], "seller_id string, seller_sk bigint"),
    )


def item(i, n, price):
    return (i, n, "p", "s", Decimal(price), Decimal("1.00"))


def paid(i, n, value):
    return (i, n, "voucher", 1, Decimal(value))


def batch_run(spark, dims, orders, items, payments):
    t = SimpleNamespace(orders=spark.createDataFrame(orders, ORDERS), order_items=spark.createDataFrame(items, ITEMS), order_payments=spark.createDataFrame(payments, PAYMENTS))
    facts = star.fact_orders_agg(t, dims.dim_customer, dims.dim_product, dims.dim_seller)
    return facts, business.monthly_sales(t.orders, t.order_items)


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_late_rows_corrections_and_deletions_equal_the_batch_run(spark, dims, tmp_path):
    v = views.OrderViews(str(tmp_path), dims)
    batches = [
        # the item of order 2 comes before its order; order 1 is entered in the wrong month
        [("orders", "upsert", 1, order("1", bought=at(3, 2))), ("order_items", "upsert", 1, item("1", 1, "10.00")), ("order_items", "upsert", 1, item("2", 1, "20.00")), ("order_payments", "upsert", 1, paid("1", 1, "11.00"))],
        [("orders", "upsert", 2, order("2", bought=at(9, 2), customer="c2")), ("orders", "upsert", 5, order("1", bought=at(3, 1))), ("order_payments", "upsert", 3, paid("2", 1, "3.00")), ("order_payments", "upsert", 3, paid("2", 2, "4.00"))],
        # an old version and an old payment arrive last, a second item is added and deleted again, order 3 is canceled
        [("orders", "upsert", 4, order("1", "created", at(5, 5))), ("order_payments", "delete", 9, paid("2", 2, "4.00")), ("order_items", "delete", 8, item("1", 2, "5.00")), ("orders", "upsert", 6, order("3", "canceled", at(1, 1))), ("order_items", "upsert", 6, item("3", 1, "7.00"))],
        [("order_items", "upsert", 7, item("1", 2, "5.00")), ("order_payments", "upsert", 8, paid("2", 2, "4.00")), ("order_items", "upsert", 9, item("2", 1, "25.00")), ("order_items", "upsert", 9, item("4", 1, "1.00"))],
    ]
    for n, rows in enumerate(batches):
        v(changes(spark, rows), n)
    facts, monthly = batch_run(
        spark, dims, [order("1", bought=at(3, 1)), order("2", bought=at(9, 2), customer="c2"), order("3", "canceled", at(1, 1))],
        [item("1", 1, "10.00"), item("2", 1, "25.00"), item("3", 1, "7.00"), item("4", 1, "1.00")], [paid("1", 1, "11.00"), paid("2", 1, "3.00")],
    )
    same(v.fact_orders(spark), facts)
    same(v.monthly_sales(spark), monthly)
    # a repeated batch changes nothing
    v(changes(spark, batches[3]), 3)
    same(v.fact_orders(spark), facts)
    same(v.monthly_sales(spark), monthly)


def test_a_batch_touches_only_the_parts_of_its_orders(spark, dims, tmp_path):
    v = views.OrderViews(str(tmp_path), dims)
    first = []
    for m in range(1, 7):
        first += [("orders", "upsert", 1, order(str(m), bought=at(2, m))), ("order_items", "upsert", 1, item(str(m), 1, "10.00"))]
    v(changes(spark, first), 0)
    v(changes(spark, [("order_items", "upsert", 2, item("3", 1, "12.00"))]), 1)
    assert v.touched == ["2018-03"]
    for table in (v.rows, v.facts, v.monthly):
        assert {p for p, b in table.newest(spark).items() if b == 1} == {"2018-03"}
        assert {p for p, b in table.newest(spark).items() if b == 0} == {f"2018-0{m}" for m in (1, 2, 4, 5, 6)}
    # read back, one month needs the files of its part only
    assert all("part=2018-03" in f for f in v.fact_month(spark, "2018-03").inputFiles())
    # a move empties the old part
    v(changes(spark, [("orders", "upsert", 3, order("3", bought=at(2, 8)))]), 2)
    assert v.touched == ["2018-03", "2018-08"] and "2018-03" not in v.facts.newest(spark) and v.fact_month(spark, "2018-03").count() == 0
    v(changes(spark, [("orders", "delete", 4, order("3"))]), 3)
    assert v.touched == ["2018-08", views.NONE] and [r["order_id"] for r in v.fact_month(spark, views.NONE).collect()] == ["3"]


def test_homes_are_compacted(spark, dims, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "COMPACT_EVERY", 2)
    homes = views.Homes(str(tmp_path))
    rows = lambda *r: spark.createDataFrame(r, "order_id string, part string")
    for n, r in enumerate([rows(("a", "1"), ("b", "1")), rows(("a", "2")), rows(("c", "3")), rows(("a", "4"), ("d", "9"))]):
        homes.add(r, n)
    wanted = rows(("a", ""), ("b", ""), ("c", ""), ("x", "")).select("order_id")
    assert {tuple(r) for r in homes.of(wanted, 4).collect()} == {("a", "4"), ("b", "1"), ("c", "3")}
    assert {tuple(r) for r in homes.of(wanted, 2).collect()} == {("a", "2"), ("b", "1")}  # what a repeated batch saw


# --- neighbours ------------------------------------------------------------------------
def brute(vectors, k):
    ids = [i for i, v in vectors if v is not None and np.linalg.norm(v) > 0]
    x = np.array([v for _, v in vectors if v is not None and np.linalg.norm(v) > 0], float)
    x = x / np.linalg.norm(x, axis=1)[:, None]
    near = np.round(x @ x.T, 6)
    out = {}
    for a, row in zip(ids, near, strict=True):
        out[a] = sorted(((-s, b) for b, s in zip(ids, row, strict=True) if b != a))[:k]
    return out


@pytest.mark.parametrize(("n", "clusters", "pivots", "block"), [(120, 4, 256, 2048), (150, 0, 5, 16), (60, 2, 3, 7)])
def test_neighbours_equal_brute_force(spark, n, clusters, pivots, block):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(clusters, 6)) * 5 if clusters else np.zeros((1, 6))
    vectors = [(f"p{i}", (centres[i % len(centres)] + rng.normal(size=6)).tolist()) for i in range(n)]
    vectors += [(f"q{i}", vectors[0][1]) for i in range(15)]  # equal vectors
    vectors += [("r1", [2 * v for v in vectors[1][1]]), ("none", None), ("zero", [0.0] * 6)]
    df = spark.createDataFrame(vectors, "product_id string, embedding array<double>").repartition(5)
    wanted = brute(vectors, 4)
    got = {}
    for r in N.nearest_products(df, 4, pivots, block).collect():
        got.setdefault(r["product_id"], []).append((r["place"], -r["similarity"], r["partner_id"]))
    assert {p: [x[1:] for x in sorted(rows)] for p, rows in got.items()} == {p: [(s, b) for s, b in rows] for p, rows in wanted.items()}
    assert N.nearest_products(df.limit(0), 4).count() == 0 and N.nearest_products(df.where("product_id = 'p1'"), 4).count() == 0


def test_cells_that_cannot_help_are_passed_over(spark):
    """On clustered vectors the compared share falls as the table grows."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 24))
    shares = []
    for n in (500, 3000):
        rows = [(f"p{i:05d}", (centres[i % 40] + 0.05 * rng.normal(size=24)).tolist()) for i in range(n)]
        _, classes = N.unit_classes(spark.createDataFrame(rows, "product_id string, embedding array<double>"))
        cells = N.cells_of(classes)
        _, asked = N.class_neighbours(cells, 5)
        shares.append(N.scored_share(cells, asked))
    assert shares[0] < 0.5 and shares[1] < 0.15 and shares[1] < shares[0]


def test_pairs_above_a_threshold(spark):
    rng = np.random.default_rng(9)
    x = np.abs(rng.normal(size=(90, 5))) * (rng.random((90, 5)) < 0.6) + 1e-3
    x = x / np.linalg.norm(x, axis=1)[:, None]
    sparse = [(f"h{i:02d}", [j for j in range(5) if x[i, j]], [float(v) for v in x[i] if v]) for i in range(90)]
    cells = N.cells_of(spark.createDataFrame(sparse, "head string, at array<int>, v array<double>"), 5, pivots=9)
    found, _ = N.classes_above(cells, 0.9, block=13)
    near = np.round(x @ x.T, 6)
    wanted = {(f"h{i:02d}", f"h{j:02d}", near[i, j]) for i in range(90) for j in range(90) if i != j and near[i, j] >= 0.9}
    assert {tuple(r) for r in found.collect()} == wanted


def test_vectors_are_sent_once_per_area(spark):
    """On vectors without structure every cell is asked; a vector still goes to each area once, however many cells that has."""
    rng = np.random.default_rng(3)
    rows = [(f"p{i:04d}", rng.normal(size=8).tolist()) for i in range(900)]
    cells = N.cells_of(N.unit_classes(spark.createDataFrame(rows, "product_id string, embedding array<double>"))[1])
    areas = N.areas_of(cells, 300)
    n_areas = 1 + max(a for mine in areas for a in mine)
    asking = N.asking_areas(cells, areas, 5, None)
    sent = asking.agg(F.count("*").alias("n"), F.sum(F.size("areas")).alias("sent")).first()
    assert len(areas) == 30 and 3 <= n_areas <= 6 and sent["n"] == 900 and sent["sent"] <= 900 * n_areas
    assert max(N.in_areas(cells, areas).groupBy("area").count().toPandas()["count"]) <= 450


# --- co-purchase pairs ---------------------------------------------------------------------
def test_pair_table_reads_every_pair_once(spark):
    import itertools
    import random
    from collections import Counter

    from bazaarlens.operators import baskets

    rng = random.Random(7)
    products = [f"p{i:03d}" for i in range(80)]
    orders = {f"o{i}": rng.sample(products, rng.choice([1, 2, 3, 5])) for i in range(120)}
    orders |= {f"big{i}": rng.sample(products, 40) for i in range(6)}  # every product has its own set of large baskets
    lines = [(o, p, n) for o, ps in orders.items() for n, p in enumerate(ps)] + [("o1", orders["o1"][0], 9), (None, "p001", 1), ("o2", None, 1)]
    items = spark.createDataFrame(lines, "order_id string, product_id string, order_item_id int").repartition(4)
    wanted = Counter(pair for ps in orders.values() for pair in itertools.permutations(ps, 2))
    table = baskets.PairTable(items, 6)
    got = {(r["product_id"], r["partner_id"]): r["n_orders"] for r in table.partners_of(items).collect()}
    assert got == dict(wanted)
    assert table.pairs.count() + table.cliques.count() < len(wanted) / 2
    some = spark.createDataFrame([("p001",), ("p001",), ("none",)], "product_id string")
    assert {r["partner_id"] for r in table.partners_of(some).collect()} == {b for a, b in wanted if a == "p001"}


def test_parts_of_a_hot_order_are_numbered_across_ranges(spark, monkeypatch):
    from bazaarlens.operators import baskets, ranges

    monkeypatch.setattr(ranges.with_range, "__defaults__", (None, 50))
    items = spark.createDataFrame([("hot", f"p{i % 900:04d}", i) for i in range(2500)] + [(f"o{i}", "x", 1) for i in range(300)] + [("hot", "p0000", 0)] * 3, "order_id string, product_id string, order_item_id int").repartition(5)
    parts = {(r["order_id"], r["part"]): r["products"] for r in baskets.basket_lists(items, 100).collect()}
    hot = [p for n in range(26) for p in parts["hot", n]]
    assert hot == sorted([f"p{i % 900:04d}" for i in range(2500)] + ["p0000"] * 3)
    assert all(len(parts["hot", n]) == 100 for n in range(25)) and all(parts[f"o{i}", 0] == ["x"] for i in range(300))


# --- joins of streams -------------------------------------------------------------------
def test_streams_are_joined_slice_by_slice(spark, tmp_path, monkeypatch):
    from bazaarlens.oracle import registry
    from bazaarlens.queries import q12_streams
    from bazaarlens.sources.market import Market

    day = "CASE WHEN o_orderkey = 5 THEN NULL ELSE TIMESTAMP_NTZ '1995-12-31' + make_dt_interval(CAST(o_orderkey DIV 30 AS INT)) END"
    orders = spark.range(22, 112).selectExpr("id AS o_orderkey", "1L AS o_custkey", "'F' AS o_orderstatus", "10.5D AS o_totalprice")
    orders = orders.unionByName(orders.where("o_orderkey = 30")).unionByName(orders.limit(1).withColumn("o_orderkey", F.lit(5)))
    orders.withColumn("o_orderdate", F.expr(day)).write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.range(0, 360).selectExpr("id DIV 3 AS l_orderkey", "CAST(id % 3 AS INT) AS l_linenumber", "1L AS l_partkey", "1L AS l_suppkey", "TIMESTAMP_NTZ '1996-01-01' AS l_shipdate", "1.5D AS l_extendedprice", "0.1D AS l_tax")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    m = Market(spark, str(tmp_path))
    near = [F.expr(f"CAST(order_id AS BIGINT) % {n} <= 6") for n in (8, 11)]
    columns = ["order_id", "order_item_id", "payment_sequential", "payment_value"]
    dated = m.orders.where("order_purchase_timestamp IS NOT NULL").select("order_id")
    # every row of a repeated order meets the arrivals that each of its rows gives
    want = dated.join(m.order_items.join(dated, "order_id").where(near[0]), "order_id").join(m.order_payments.join(dated, "order_id").where(near[1]), "order_id")
    want = sorted(tuple(r) for r in want.select(columns).collect())
    assert ("22", 0, 1, want[0][3]) in want  # its lines arrive in the year after
    for items in (1_000_000, 60):
        monkeypatch.setattr(q12_streams, "SLICE_ITEMS", items)
        got = registry.QUERIES["stream_join_on_time"](spark, str(tmp_path))
        assert sorted(tuple(r) for r in got.select(columns).collect()) == want
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 0 and spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_arrivals_are_deleted_once_joined(spark, root, monkeypatch):
    """Landed files and old state go while the stream runs, so that its disk does not follow the number of slices."""
    import glob

    from bazaarlens.oracle import registry
    from bazaarlens.queries import q12_streams
    from bazaarlens.sources import io

    monkeypatch.setattr(q12_streams, "SLICE_ITEMS", 2_000)
    done = registry.QUERIES["stream_join_on_time"](spark, root)
    assert done.count() > 0
    top = max(glob.glob(f"{io.work_dir(spark)}/arrivals-*/landing"), key=lambda p: __import__("os").path.getmtime(p))
    landed = spark.read.parquet(f"{top}/kind=orders").count()
    assert landed < spark.read.parquet(f"{root}/orders.parquet").count()
