"""Resumable extraction, clustered tables and ranges by row count."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import clustering, ranges
from bazaarlens.operators.extraction_job import ExtractionJob, Lane, Policy, RateLimited, ServiceFault, TimedOut


# --- extraction job -------------------------------------------------------------------
class Clock:
    """A clock that only sleeping moves."""

    def __init__(self):
        self.now, self.naps = 100.0, []

    def read(self):
        return self.now

    def sleep(self, seconds):
        self.naps.append(seconds)
        self.now += seconds


def failing(errors, then='{"a": 1}'):
    left = list(errors)

    def ask(title, description):
        if left:
            error = left.pop(0)
            if isinstance(error, str):
                return error
            raise error
        return then

    return ask


@pytest.mark.parametrize(
    ("errors", "naps", "result"),
    [
        ([], [], ("SUCCESS", 1)),
        ([RateLimited()], [2.0], ("SUCCESS", 2)),
        ([RateLimited(), TimedOut()], [2.0, 4.0], ("SUCCESS", 3)),
        ([TimedOut(), TimedOut(), TimedOut()], [2.0, 4.0, 8.0], ("FAILED", 3)),
        ([ServiceFault(), ServiceFault(), ServiceFault()], [2.0, 2.0], ("FAILED", 3)),
        (["no json", "still none"], [], ("SUCCESS", 3)),
        (["no json"] * 3, [], ("FAILED", 3)),
        ([KeyError("x")], [], ("FAILED", 1)),
    ],
)
def test_pauses_grow_with_the_attempts(errors, naps, result):
    clock = Clock()
    lane = Lane(failing(errors), Policy(clock=clock.read, sleep=clock.sleep), 4)
    status, tries, answer = lane.ask("t", "d")
    assert (status, tries) == result and clock.naps == naps and (answer is not None) == (status == "SUCCESS")


def test_lanes_keep_the_rate_together():
    times = []
    for lanes in (1, 5):
        clock = Clock()
        lane = Lane(lambda t, d: times.append(clock.now) or "{}", Policy(rate=10.0, clock=clock.read, sleep=clock.sleep), lanes)
        times.clear()
        for _ in range(20):
            lane.ask("t", "d")
        gaps = [b - a for a, b in zip(times, times[1:], strict=False)]
        assert all(abs(g - lanes / 10.0) < 1e-9 for g in gaps)  # all lanes: lanes calls per lanes / rate seconds


def test_a_stopped_run_asks_for_every_text_once(spark, tmp_path):
    calls = str(tmp_path / "calls")
    os.mkdir(calls)

    def ask(title, description):
        with open(f"{calls}/{os.getpid()}", "a") as f:
            f.write(title + "\n")
        if title == "t7" and not os.path.exists(f"{calls}/again"):
            raise KeyError(title)
        return json.dumps({"title": title, "text": description})

    rows = [(f"p{i}", f"t{i % 60}", f"d{i % 60}") for i in range(90)] + [("n1", None, None), ("n2", "", None)]
    texts = spark.createDataFrame(rows, "product_id string, title string, description string").repartition(3)
    job = ExtractionJob(str(tmp_path / "log"), ask, lanes=2, wave_rows=13)
    assert job.run(texts, max_waves=2) == 2
    assert 0 < job.log(spark).count() < 61
    again = ExtractionJob(str(tmp_path / "log"), ask, lanes=2, wave_rows=13)  # as a new driver would
    again.run(texts)
    said = sorted(line for name in os.listdir(calls) for line in open(f"{calls}/{name}").read().splitlines())
    assert sorted(set(said)) == sorted({t or "" for _, t, _ in rows})
    assert len(said) - said.count("t7") == len(set(said)) - 1  # t7 failed and was asked for again at most once
    got = {r["product_id"]: r for r in again.answers(texts).collect()}
    assert len(got) == 92 and got["p7"]["extraction_status"] == "FAILED" and json.loads(got["p61"]["answer"]) == {"title": "t1", "text": "d1"}
    open(f"{calls}/again", "w").close()
    assert again.run(texts) == 1 and again.run(texts) == 0
    assert {r["extraction_status"] for r in again.answers(texts).collect()} == {"SUCCESS"}


def test_texts_are_read_once_a_run_whatever_the_waves(spark, tmp_path):
    reads = str(tmp_path / "reads")
    os.makedirs(reads)

    def noted(frames):
        for f in frames:
            with open(f"{reads}/{os.getpid()}", "a") as out:
                out.write("".join(f"{p}\n" for p in f["product_id"]))
            yield f

    rows = [(f"p{i}", f"t{i}", f"d{i}") for i in range(40)]
    texts = spark.createDataFrame(rows, "product_id string, title string, description string")
    texts = texts.mapInPandas(noted, texts.schema)
    job = ExtractionJob(str(tmp_path / "log"), lambda title, description: json.dumps({"t": title}), lanes=2, wave_rows=10)
    assert job.run(texts) == 4
    said = sorted(line for name in os.listdir(reads) for line in open(f"{reads}/{name}").read().splitlines())
    assert said == sorted(r[0] for r in rows)


# --- clustered tables -------------------------------------------------------------------
def test_curve_place_interleaves_bits(spark):
    rows = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    for r in rows.select("a", "b", clustering.curve_place([F.col("a"), F.col("b")], 3).alias("p")).collect():
        assert r["p"] == sum(((r["a"] >> i) & 1) << (2 * i + 1) | ((r["b"] >> i) & 1) << (2 * i) for i in range(3))


def test_clustered_files_serve_ranges_of_both_columns(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, 20180000 + rng.randrange(365), rng.choice([7] * 200 + list(range(400))), rng.random()) for i in range(20_000)]
    rows += [(20_000 + i, None, 3, 0.5) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, date_key int, customer int, v double").repartition(6)
    path = str(tmp_path / "t")
    stats = clustering.write_clustered(df, path, ["date_key", "customer"], "id", rows_per_file=500)
    files = stats.count()
    assert files >= 35 and stats.agg(F.sum("n_rows")).first()[0] == len(rows)
    assert stats.agg(F.max("n_rows")).first()[0] < 5 * 500  # also with a customer in a third of all rows
    asked = {"date_key": (20180100, 20180110)}, {"customer": (350, 352)}, {"date_key": (20180100, 20180150), "customer": (100, 140)}, {"customer": (7, 7)}
    for wanted in asked:
        read = clustering.files_within(spark, path, wanted)
        got = sorted(r["id"] for r in clustering.read_clustered(spark, path, df.schema, wanted).collect())
        place = {"date_key": 1, "customer": 2}
        assert got == sorted(r[0] for r in rows if all(r[place[c]] is not None and lo <= r[place[c]] <= hi for c, (lo, hi) in wanted.items()))
        if wanted != {"customer": (7, 7)}:
            assert len(read) <= files // 3
    assert clustering.read_clustered(spark, path, df.schema, {"customer": (1000, None)}).count() == 0


# --- ranges --------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [0, 1, 3, 5000])
def test_ranges_follow_the_row_count(spark, n):
    ids = [f"k{i:06d}" for i in range(n)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(4)
    cut = ranges.with_range(df, ["id"], rows_per_range=200)
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert sum(sizes) == n and max(sizes, default=0) < 4 * 200 and (n < 5000 or 15 <= len(sizes) <= 40)
    order = [r["_range"] for r in cut.orderBy("id").collect()]
    assert order == sorted(order)
    numbered = ranges.surrogate_key(df, "sk", ["id"]).collect()
    assert sorted((r["sk"], r["id"]) for r in numbered) == [(i + 1, k) for i, k in enumerate(sorted(ids))]


# --- contracts -------------------------------------------------------------------------------
def test_contract_checks_name_every_fault(spark):
    from bazaarlens.operators import contract_checks as K
    from bazaarlens.sources.contracts import contracts

    all_ = contracts()
    facts = [
        ("1", "o1", 1, 5, 1, 1, 20180101, "voucher", "delivered", "1.00", "1.00", None, "1"),
        ("1", "o1", None, 9, None, -1, 20180101, "v" * 21, None, "abc", "1.00", "2", "2.0"),
        (None, None, 2, None, 1, 1, 20990101, None, "s", "1", "99999999999.99", "x", "y"),
    ]
    schema = "order_item_key string, order_id string, order_item_id int, customer_key bigint, product_key bigint, seller_key bigint, purchase_date_key int, payment_type string, order_status string, price string, freight_value string, payment_value string, payment_installments string"
    tables = {"fact_orders": spark.createDataFrame(facts, schema)}
    for dim, key in (("dim_customer", "customer_key"), ("dim_product", "product_key"), ("dim_seller", "seller_key"), ("dim_geography", "geography_key")):
        tables[dim] = spark.createDataFrame([(1,), (5,), (1,)], f"{key} bigint")
    tables["dim_date"] = spark.createDataFrame([(20180101,)], "date_key int")
    only = {"fact_orders": all_["fact_orders"]}
    got = {(r["constraint_type"], r["column_name"]): r["n_faults"] for r in K.check_contracts(only, tables, {"fact_orders": {"order_item_sequence": "order_item_id", "date_key": "purchase_date_key"}}).collect()}
    wanted = {
        ("TYPE", "order_item_key"): 0, ("TYPE", "price"): 1, ("TYPE", "freight_value"): 1, ("TYPE", "payment_value"): 1, ("TYPE", "payment_installments"): 1,
        ("LENGTH", "payment_type"): 1, ("LENGTH", "order_id"): 0, ("NOT NULL", "order_item_key"): 1, ("NOT NULL", "order_id"): 1, ("NOT NULL", "order_item_sequence"): 1,
        ("NOT NULL", "order_status"): 1, ("NOT NULL", "price"): 1, ("NOT NULL", "customer_key"): 0, ("DEFAULT", "customer_key"): 1, ("DEFAULT", "product_key"): 1,
        ("DEFAULT", "geography_key"): 3, ("PRIMARY KEY", "order_item_key"): 1, ("FOREIGN KEY", "customer_key"): 1, ("FOREIGN KEY", "product_key"): 0,
        ("FOREIGN KEY", "seller_key"): 0, ("FOREIGN KEY", "date_key"): 1, ("FOREIGN KEY", "geography_key"): 0,
    }
    assert {k: got[k] for k in wanted} == wanted


# --- recorded statistics ------------------------------------------------------------------------
def test_recorded_runs_merge_replace_and_compare(spark, tmp_path):
    from bazaarlens.operators.stats_store import StatsStore

    store = StatsStore(str(tmp_path))
    assert store.trend(spark).count() == 0
    at = lambda n: F.lit(f"2020-01-0{n} 00:00:00").cast("timestamp_ntz")
    rng = random.Random(5)
    rows = [(i, rng.gauss(0, 1) if i % 10 else None, f"k{i % 3000}", None) for i in range(8000)]
    df = spark.createDataFrame(rows, "id bigint, v double, k string, empty int").repartition(4)
    store.record("a", at(1), {"t": df.limit(10)})
    store.record("a", at(1), {"t": df.where("id < 4000")})  # recorded again
    for n in range(3):
        store.record("b", at(2), {"t": df.where(F.col("id") % 3 == n)}, part=f"p{n}")
    store.record("c", at(3), {"t": df.withColumn("v", F.col("v").cast("string")).drop("empty")})
    runs = {(r["run"], r["column_name"]): r for r in store.runs(spark).collect()}
    assert runs["a", "id"]["n_rows"] == 4000 and runs["b", "v"]["n_nulls"] == 800 and runs["b", "empty"]["n_distinct"] == 0
    assert abs(runs["b", "k"]["n_distinct"] / 3000 - 1) < 0.05 and abs(runs["b", "id"]["n_distinct"] / 8000 - 1) < 0.05
    median = store.runs(spark).where("run = 'b' AND column_name = 'v'").select(F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5))).first()[0]
    values = sorted(v for _, v, _, _ in rows if v is not None)
    assert abs(sum(v <= median for v in values) / len(values) - 0.5) < 0.03
    drift = {r["column_name"]: r["drift"] for r in store.drift(spark, "b", "c").collect()}
    assert drift == {"id": "same", "v": "type_changed", "k": "same", "empty": "removed"}
    trend = store.trend(spark).orderBy("at").collect()
    assert [r["run"] for r in trend] == ["a", "b", "c"] and trend[0]["change"] is None and float(trend[1]["score"]) == 0.725
    assert trend[2]["change"] == trend[2]["score"] - trend[1]["score"]
