"""Importance resampling, whitening and wrapper extraction against brute force, with their edge cases."""

import hashlib
import html
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import html_tree, queries, resampling, whitening, wrappers

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# --- importance resampling -------------------------------------------------------
def features_of(text, runs):
    words = LETTERS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def expected_scores(docs, target, runs, buckets, least, percent, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features_of(t, runs)[1])
    t = Counter(bucket(f) for x in target for f in features_of(x, runs)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, text in docs:
        words, found = features_of(text, runs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in found)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    ranked = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return rows, ranked[: percent * len(ranked) // 100]


@pytest.mark.parametrize(("runs", "segment", "samples"), [(1, 250_000, 1 << 16), (2, 7, 40), (1, 3, 5)])
def test_scores_and_ranks_match_brute_force(spark, root, tables, runs, segment, samples):
    docs = tables.sql("SELECT doc_id, text FROM documents").fetchall()
    target = [t for (t,) in tables.sql("SELECT text FROM benchmark").fetchall()]
    frames = [spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "benchmark")]
    got = resampling.resampled(frames[0].repartition(5), frames[1], percent=30, runs=runs, buckets=997, segment=segment, samples=samples).collect()
    rows, drawn = expected_scores(docs, target, runs, 997, 20, 30)
    assert sorted(tuple(r)[:5] for r in got) == sorted(rows)
    assert [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == [r[0] for r in drawn]
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))


def test_resampling_edges(spark, messy, nothing):
    target = spark.createDataFrame([("one two",), (None,)], "text string")
    rows = messy.select("doc_id", "text").collect()
    got = resampling.resampled(messy, target, percent=100, least=1, buckets=50).collect()
    wanted, drawn = expected_scores([tuple(r) for r in rows], ["one two", ""], 1, 50, 1, 100)
    order = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(wanted, key=order)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))
    assert resampling.resampled(nothing, target).count() == 0
    assert resampling.resampled(messy, nothing).count() == len(rows)


def test_repeated_rows_fill_no_segment(spark):
    docs = spark.createDataFrame([(7, "same words in every row " * 5)] * 300 + [(None, "no id at all " * 8)] * 300, "doc_id long, text string").repartition(6)
    got = resampling.resampled(docs, docs.limit(1), percent=100, segment=20, samples=400).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 601))


# --- whitening ------------------------------------------------------------------------
def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 8, 30):
        for kind in range(3):
            a = rng.normal(size=(d, d))
            v = [a @ a.T, a + a.T, np.diag(rng.normal(size=d)) * (rng.random((d, d)) < 2)][kind]
            for s in rng.normal(size=5) * 2:
                assert whitening.above(v, s) == (np.linalg.eigvalsh(v) > s).sum()
    swap = np.array([[0.0, 1.0], [1.0, 0.0]])  # no single pivot exists
    assert whitening.above(swap, 0.0) == 1


@pytest.mark.parametrize("values", [[9, 4, 1, 0.5, 0.1, 0.01], [5, 5, 5, 3, 3, 1], [1, 1 - 1e-13, 1e-9, 0, 0, 0], [7, 7 - 1e-7, 7 - 2e-7, 2, 1e-3, 0]])
def test_slices_find_close_and_equal_values(values):
    q, _ = np.linalg.qr(np.random.default_rng(5).normal(size=(6, 6)))
    v = q @ np.diag(np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    found, vectors = whitening.leading_pairs(v, 4)
    wanted = [x for x in values if x > 1e-12][:4]
    assert np.allclose(found, wanted, rtol=1e-9, atol=1e-13) and np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-12)
    assert np.allclose(v @ vectors.T, vectors.T * found, atol=1e-12)


def brute_whitening(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    unique = np.unique(x, axis=0)
    n, sums = len(unique), unique.sum(axis=0)
    centred = unique - sums / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ u / np.sqrt(e), e / np.trace(cov)


def test_whitening_query_matches_brute_force(spark, root):
    table = spark.read.parquet(f"{root}/embeddings.parquet").collect()
    got = queries.QUERIES["op12_whitening"](spark, root).toPandas()
    n, deviation, white, explained = brute_whitening([r["embedding"] for r in table], 16)
    ids = [r["vec_id"] for r in table]
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert list(got.n.unique()) == [n] and got.identity_error.max() <= 1e-10 and got.identity_error.nunique() == 1
    assert np.allclose(abs(wide), abs(white), atol=1e-8)
    assert (got.groupby("vec_id").deviation.first().loc[ids].to_numpy() == deviation).all()
    assert np.allclose(got.groupby("component").explained.first().to_numpy(), explained, rtol=1e-9)


def test_whitening_edges(spark):
    good = [(i, [float(i % 7), float(i % 5) / 2, -float(i % 3)], "a", 1) for i in range(40)]
    odd = [(100, None, "a", 1), (101, [], "a", 1), (102, [1.0, None, 2.0], "a", 1), (103, [1.0, float("nan"), 2.0], "a", 1), (104, [float("inf"), 0.0, 0.0], "a", 1), (105, [1.0, 2.0], "a", 1), (106, [1e300, 0.0, 0.0], "a", 1), (None, [1.0, 1.0, 1.0], None, None)]
    df = spark.createDataFrame(good + odd + good[:10], "vec_id long, embedding array<double>, whitened string, n int").repartition(4)
    got = whitening.components(df, k=16).toPandas()
    kept = [r[1] for r in good] + [[1.0, 1.0, 1.0]] + [r[1] for r in good[:10]]
    n, _, white, _ = brute_whitening(kept, 3)
    assert len(got) == 51 * 3 and set(got.component) == {1, 2, 3} and set(got.n) == {n} and got.vec_id.isna().sum() == 3
    assert np.allclose(sorted(abs(got.whitened)), sorted(abs(white).ravel()))
    assert whitening.components(df.where("vec_id > 99")).where("vec_id < 105").count() == 0  # one usable row: no variance
    assert whitening.components(df.limit(0)).count() == 0
    assert whitening.components(df.where("vec_id = 100")).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whitening.components(flat).collect()} == {1}


def test_exact_deviations_beyond_a_long():
    x = np.array([[2**40, 0], [1, 2]])
    assert whitening.deviations(x, 10**7, np.array([5, 5])) == [None, (10**7 - 5) ** 2 + (2 * 10**7 - 5) ** 2]


# --- extraction ---------------------------------------------------------------------
def article_text(page):
    """Texts between the article tags of the test pages, by patterns."""
    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)
    blocks = re.split(r"</?(?:p|h1|br)>", inside[1]) if inside else []
    return " ".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks) if t)


def test_extraction_query_matches_the_articles(spark, root, tables):
    pages = {i: (u, h) for i, u, h in tables.sql("SELECT page_id, url, html FROM pages").fetchall()}
    got = queries.QUERIES["op13_html_extraction"](spark, root).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]][0], article_text(pages[r["page_id"]][1]), len(r["text"]))


def test_reader_is_tolerant():
    text = lambda page: wrappers.main_text(page, None)
    assert text("<body><p>One <b>bo</b>ld &amp; more<p>two<br>three &eacute;&nbsp;&#33;</body>") == "One bold & more two three é !"
    assert text('<p title="a > b" data-x=\'>\'>in</p><!-- <p>out</p> --><script>if (a < b) "</p>"</script>after') == "in after"
    assert text("a < b <3 </> <p unfinished") == "a < b <3"
    assert text('<p>x<a href="1>y</a></p><p>z</p>') == "x y z".replace("x y", "xy")
    assert text("<ul><li>a<li>b</ul><dl><dt>t<dd>d</dl><table><tr><td>1<td>2<tr><td>3</table>") == "a b t d 1 2 3"
    assert text("<script>never closed <p>x") == "" and text("<!-- open <p>x") == "" and text("") == ""
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>last</p>") == "deep last"
    assert text("<p>" + "word " * 100_000 + "</p>").count("word") == 100_000
    for hostile in ("<" * 50_000, "<a " * 50_000, '<a x="' * 20_000, "<!--" * 50_000, "&" * 50_000, "<p>" * 30_000, "</p>" * 30_000):
        text(hostile)


def test_parts_beside_the_text_are_left_out():
    page = """<html><body class="has-sidebar"><header>Site</header><div class="cookie-notice">Cookies</div><nav><a>Menu</a></nav>
    <main><article><header><span>by me</span><h1>Title</h1></header><p>First.</p><aside>Aside</aside><div class="advert top">Ad</div>
    <form>Mail <input></form><p>Second <i>word</i>.</p><section id="comments"><p>A comment</p></section></article></main>
    <div class="sidebar">Side</div><footer>Foot</footer></body></html>"""
    assert wrappers.main_text(page, None) == "Title First. Second word."


def host_page(title, paragraphs, extra=""):
    inner = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"<body><div class=top><div>Shop of all</div></div><div class=links><a>Home</a> <a>{title} page</a></div><div class=story><h2>{title}</h2>{inner}<p class=end>Read our terms</p></div>{extra}<div class=end>All rights kept</div></body>"


def test_wrappers_split_template_from_content(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows, wanted = [], {}
    for i in range(30):
        ps = [" ".join(word() for _ in range(8)) for _ in range(1 + i % 4)]
        title = f"T {word()}"
        rows.append((i, f"https://u@News.example.com:80/{i}", host_page(title, ps, "<div class=box>Call us</div>" if i % 3 == 0 else "")))
        wanted[i] = " ".join([title, *ps])
    rows += [(100, "http://lone.example.com/a", host_page("Lone", ["only page"])), (101, None, None), (102, "x", ""), (103, "http://news.example.com/z", None)]
    rows += [(200 + i, "http://news.example.com/0", rows[0][2]) for i in range(40)]
    df = spark.createDataFrame([(*r, "clash", 1.5) for r in rows], "page_id long, url string, html string, text string, host double").repartition(7)
    got = {r["page_id"]: r for r in wrappers.extracted(df).collect()}
    assert all(got[i]["text"] == t for i, t in wanted.items())
    assert all(got[200 + i]["text"] == wanted[0] for i in range(40))
    assert got[100]["text"] == "Shop of all Lone only page Read our terms All rights kept"
    assert [got[i]["text"] for i in (101, 102, 103)] == ["", "", ""] and got[5]["host"] == 1.5
    assert wrappers.extracted(df.limit(0)).count() == 0


def test_repeated_lines_inside_an_article(spark):
    rows = [(i, f"http://a.example.org/{i}", f"<article><p>Share this</p><h1>Head {i}</h1><div>Same story for all</div></article>") for i in range(12)]
    rows += [(50 + i, f"http://b.example.org/{i}", f"<article><p>Share this</p><h1>Head {i}</h1></article>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in wrappers.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Head 3"  # the same on twelve different pages
    assert got[51] == "Share this Head 1"  # three pages are too few to tell


def most_matches(a, b):
    """Matching nodes by trying every order-keeping alignment of the children."""
    if a[wrappers.LABEL] != b[wrappers.LABEL]:
        return 0
    best, left, right = 0, a[wrappers.KIDS], b[wrappers.KIDS]
    for n in range(min(len(left), len(right)) + 1):
        for xs in itertools.combinations(range(len(left)), n):
            for ys in itertools.combinations(range(len(right)), n):
                best = max(best, sum(most_matches(left[x], right[y]) for x, y in zip(xs, ys, strict=True)))
    return 1 + best


def test_tree_matching_and_merging():
    rng = random.Random(8)

    def grow(depth):
        return [rng.choice("ab") if depth < 3 else "r", rng.choice(["", "1", "2"]), [str(rng.randrange(99))], [grow(depth - 1) for _ in range(rng.randrange(4))] if depth else []]

    size = lambda t: 1 + sum(map(size, t[wrappers.KIDS]))
    for _ in range(60):
        a, b = grow(3), grow(3)
        matches = wrappers.matching(a, b, {})[0]
        assert matches == most_matches(a, b)
        both = wrappers.merged(a, b)
        assert size(both) == size(a) + size(b) - matches  # nothing is lost, nothing is kept twice
        assert wrappers.merged(a, a)[wrappers.KIDS] == a[wrappers.KIDS]


def test_trees_follow_the_layout_not_the_length():
    long = html_tree.read("<body>" + "<h2>x</h2><p>y</p>" * 5000 + "</body>")
    tree = wrappers.shape([long], "d")
    assert len(tree[wrappers.KIDS][0][wrappers.KIDS]) == 2 * wrappers.RUNS
