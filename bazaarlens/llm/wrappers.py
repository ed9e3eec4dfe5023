"""HTML extraction (13) by wrapper induction: block trees of same-host pages are aligned by simple tree matching.

Every page is read into a tree of its blocks (`html_tree`). Runs of siblings with one label are one iterating node, so a tree's
size follows the layout, not the length of the text. Trees of one host are aligned one after the other: two nodes match when
their labels do, and among the children the order-keeping alignment with the most matching nodes is taken (simple tree
matching). A node whose text is the same on all pages that have it becomes template, one whose text varies a content slot.

Main text of a page: inside its `article` or `main` elements, if it has any, everything but parts that stand beside the text
by tag, role or class name (menus, headers, footers, sidebars, notices, adverts, forms, comments) and template nodes that were
the same on at least `SURE` different pages. On other pages, all content slots that do not stand beside the text and are not
mostly links; template nodes seen on two different pages or more are left out. If that leaves nothing, the template nodes are
taken as well (a page that its host repeats).

At scale: tasks fold their pages into one small tree per host, trees of a host meet in salted groups first, then once per
host, so a host that holds a third of all pages costs one small row per task. The second scan joins each page with its host's
wrapper; only the list of hosts decides whether Spark broadcasts the wrappers.

Bounds: a node has at most `RUNS` runs of one label among its children (later ones join the last), class names with digits
are no part of a label, and a task holds the trees of `HOSTS` hosts before it hands them on.

Defined cases: NULL, empty and textless pages give the empty text. Pages without a host (NULL or odd URL) are not aligned and
follow the rules for a host's only page. Repeated pages count once in the alignment. Pages of any length are read whole, one
at a time; memory follows the longest page. Empty tables give an empty result. Further columns are carried along; `text` and
`n_chars` are replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm import common as C
from bazaarlens.llm.html_tree import HEADINGS, Node, read

SURE, RUNS, HOSTS, SALTS = 8, 4, 400, 32


def digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


# --- aligned trees -----------------------------------------------------------------
# A tree node is a list: label, digest of its text ("" none, "*" varying), pages seen (up to SURE digests), children.
LABEL, TEXT, PAGES, KIDS = range(4)


def own_text(node: Node) -> str:
    return " ".join(" ".join(k for k in node.kids if isinstance(k, str)).split())


def layout(nodes: list[Node]) -> list[list[Node]]:
    """Children of a run of blocks, in page order: neighbours with one label are one run, and from the `RUNS`-th run of a
    label on all later ones join it."""
    runs: list[list[Node]] = []
    seen: dict[str, list[list[Node]]] = {}
    for node in nodes:
        before = None
        for kid in node.kids:
            if isinstance(kid, str) or kid.tag == "br":
                continue
            if kid.label != before:
                known = seen.setdefault(kid.label, [])
                if len(known) < RUNS:
                    known.append([])
                    runs.append(known[-1])
            seen[kid.label][-1].append(kid)
            before = kid.label
    return runs


def shape(nodes: list[Node], page: str, blocks: dict[int, list] | None = None) -> list:
    """The tree of a run of blocks with one label on one page. `blocks` collects the tree node of every block by its id."""
    texts = [t for t in map(own_text, nodes) if t]
    tree = [nodes[0].label, digest("\n".join(texts)) if texts else "", [page], []]
    if blocks is not None:
        for n in nodes:
            blocks[id(n)] = tree
    tree[KIDS] = [shape(run, page, blocks) for run in layout(nodes)]
    return tree


def matching(a: list, b: list, known: dict) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two nodes with one label: (matching nodes, aligned children)."""
    key = (id(a), id(b))
    if key in known:
        return known[key]
    left, right = a[KIDS], b[KIDS]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, x in enumerate(left, 1):
        for j, y in enumerate(right, 1):
            both = best[i - 1][j - 1] + matching(x, y, known)[0] if x[LABEL] == y[LABEL] else 0
            best[i][j] = max(best[i - 1][j], best[i][j - 1], both)
    pairs, i, j = [], len(left), len(right)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    known[key] = (1 + best[-1][-1], pairs[::-1])
    return known[key]


def merged(a: list, b: list, known: dict | None = None) -> list:
    """One tree of both: aligned nodes become one, the others keep their place between them."""
    known = {} if known is None else known
    _, pairs = matching(a, b, known)
    kids, i, j = [], 0, 0
    for x, y in [*pairs, (len(a[KIDS]), len(b[KIDS]))]:
        kids += a[KIDS][i:x] + b[KIDS][j:y]
        if x < len(a[KIDS]) and y < len(b[KIDS]):
            kids.append(merged(a[KIDS][x], b[KIDS][y], known))
        i, j = x + 1, y + 1
    pages = a[PAGES] + [p for p in b[PAGES] if p not in a[PAGES]]
    return [a[LABEL], a[TEXT] if a[TEXT] == b[TEXT] else "*", pages[:SURE], kids]


def wrapper(tree: list) -> list:
    """What extraction needs of a host's tree: label, pages on which the text was the same (0: a slot), children."""
    return [tree[LABEL], 0 if tree[TEXT] == "*" else len(tree[PAGES]), [wrapper(k) for k in tree[KIDS]]]


# --- main text -----------------------------------------------------------------------
def fixed_blocks(tree: list, given: list | None) -> dict[int, int]:
    """For every tree node of a page, by id, on how many pages its text was the same, after alignment with a wrapper."""
    out: dict[int, int] = {}

    def open_wrapper(w: list) -> list:
        return [w[0], w[1], [], [open_wrapper(k) for k in w[2]]]

    def walk(a: list, b: list, known: dict) -> None:
        out[id(a)] = b[TEXT]
        for x, y in matching(a, b, known)[1]:
            walk(a[KIDS][x], b[KIDS][y], known)

    if given is not None:
        walk(tree, open_wrapper(given), {})
    return out


def main_roots(node: Node, tags: tuple[str, ...]) -> list[Node]:
    """Outermost main elements that do not stand beside the text."""
    out: list[Node] = []
    for kid in node.kids:
        if isinstance(kid, Node) and not (kid.beside and kid.tag not in ("div", "section")):
            if kid.tag in tags and not kid.beside or (kid.hidden and "main" in tags):
                out.append(kid)
            else:
                out += main_roots(kid, tags)
    return out


def text_of(nodes: list[Node], dropped, heads: bool) -> str:
    """Texts of the blocks in page order; inside a header of the main text (`heads`) its headings stay."""
    parts: list[str] = []

    def walk(node: Node, only_headings: bool) -> None:
        out = dropped(node)
        skip = out or only_headings and node.tag not in HEADINGS
        for kid in node.kids:
            if isinstance(kid, str):
                if not skip:
                    parts.append(" ".join(kid.split()))
            elif kid.tag == "br":
                continue
            elif not kid.beside:
                walk(kid, only_headings and node.tag not in HEADINGS)
            elif heads and kid.tag == "header":
                walk(kid, True)

    for n in nodes:
        walk(n, False)
    return " ".join(p for p in parts if p)


def main_text(page: str, given: list | None) -> str:
    """The main text of a page, given its host's wrapper (None: the page stands alone)."""
    root = read(page)
    blocks: dict[int, list] = {}
    tree = shape([root], "", blocks)
    same = fixed_blocks(tree, given)
    seen = lambda n: same.get(id(blocks[id(n)]), 0) if id(n) in blocks else 0
    explicit = main_roots(root, ("article",)) or main_roots(root, ("main",))
    if explicit:
        return text_of(explicit, lambda n: seen(n) >= SURE, True)
    links = lambda n: 2 * n.linked > sum(len(k) for k in n.kids if isinstance(k, str))
    return text_of([root], lambda n: seen(n) >= 2 or links(n), False) or text_of([root], links, False)


# --- over all pages --------------------------------------------------------------------
def host_of(url: Column) -> Column:
    """Lower-case host without port and user; NULL if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def host_trees(pages: DataFrame) -> DataFrame:
    """(host, tree): one aligned tree per host, folded per task, per salted group, per host."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, list] = {}
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(trees), pa.string()), pa.array([json.dumps(t) for t in trees.values()], pa.string())], ["host", "tree"])
        for b in batches:
            for host, page in zip(b.column(0), b.column(1), strict=True):
                text = page.as_py() or ""
                tree = shape([read(text)], digest(text))
                known = trees.get(host.as_py())
                trees[host.as_py()] = tree if known is None else merged(known, tree)
                if len(trees) >= HOSTS:
                    yield out()
                    trees.clear()
        yield out()

    def join(key, group: pd.DataFrame) -> pd.DataFrame:
        tree = None
        for t in sorted(group["tree"]):  # a fixed order, so reruns agree
            tree = json.loads(t) if tree is None else merged(tree, json.loads(t))
        return pd.DataFrame({"host": [key[0]], "tree": [json.dumps(tree)]})

    parts = pages.where("host IS NOT NULL").select("host", "html").mapInArrow(fold, "host string, tree string")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("tree"), F.lit(SALTS)))
    first = salted.groupBy("host", "salt").applyInPandas(join, "host string, tree string")
    return first.groupBy("host").applyInPandas(join, "host string, tree string")


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper), written to the shared folder once: small rows, one per host."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            short = [json.dumps(wrapper(json.loads(t)), separators=(",", ":")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(short, pa.string())], ["host", "wrapper"])

    return C.staged(host_trees(pages).mapInArrow(shorten, "host string, wrapper string"), "wrappers")


def extracted(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """`pages` with `text` and `n_chars` (code points) of the main text."""
    kept = pages.drop("text", "n_chars")
    named = kept.select("*", host_of(F.col(url)).alias("__host"))
    wrappers = host_wrappers(named.select(F.col("__host").alias("host"), F.col(page).alias("html")))
    both = named.join(wrappers.withColumnRenamed("host", "__known").withColumnRenamed("wrapper", "__wrapper"), F.col("__host") == F.col("__known"), "left").drop("__host", "__known")
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            opened: dict[str, list] = {}
            texts = []
            for p, w in zip(b.column(b.schema.names.index(page)), b.column(b.schema.names.index("__wrapper")), strict=True):
                given = w.as_py()
                if given is not None and given not in opened:
                    opened[given] = json.loads(given)
                texts.append(main_text(p.as_py() or "", opened.get(given)))
            columns = [c for c, name in zip(b.columns, b.schema.names, strict=True) if name != "__wrapper"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [f.name for f in schema.fields])

    return both.mapInArrow(run, schema)
