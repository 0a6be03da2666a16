"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Every block node is described by its subtree's density, its attribute tokens, its
depth and its siblings.  Boosted trees (Spark ML) are fitted on weakly labelled nodes
of a bounded sample of pages; each sampled page is also used with its attribute tokens
hidden, so that pages without telling names are handled too, and with paragraphs repeated
in parts named as comments, notices and the like.  The trees' margins
are then decoded over each page: a node is outside, inside or cut out of main text, where
inside follows outside and cut out follows inside down the tree, so no descendant
contradicts its ancestors.
"""

from __future__ import annotations

import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tracelens.llm.dom import AGAINST, Page
from tracelens.llm.store import columns_first, table

PUNCTUATION = re.compile(r"[.,;:!?]")
TEXT_TAGS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6".split())
PARAGRAPH = re.compile(r"<p\b[^<>]*>([^<]*)</p>", re.I)
PAGES_PER_PASS = 128
MARGIN_LIMIT = 4.0  # of a node's log-odds, so that one node never outweighs a page
SWITCH_COST = 0.5  # log-odds to enter main text or to cut a part out of it

FEATURES = ["chars", "link share", "chars per tag", "marks per char", "depth", "share of page", "children", "siblings",
            "chars against siblings", "place", "like siblings", "text tag", "heading", "list item", "text tags below",
            "parent link share", "own chars", "against", "against above", "favour", "favour above"]
FIRST_HINT = FEATURES.index("against")


def node_features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """(one row of FEATURES per node, own characters per node)."""
    n = len(page.tag)
    own, linked, marks = [0] * n, [0] * n, [0] * n
    for node, text, link in page.pieces:
        if text != " " and (size := len(text) - text.count(" ")):
            own[node] += size
            marks[node] += len(PUNCTUATION.findall(text))
            if link:
                linked[node] += size
    chars, links, mark, tags = own[:], linked[:], marks[:], [1] * n
    below = [int(t in TEXT_TAGS) for t in page.tag]
    children, depth = [0] * n, [0] * n
    against, favour = page.against[:], page.favour[:]
    kinds: dict[tuple[int, str], int] = {}
    parent = page.parent
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        children[p] += 1
        against[i] = against[i] or against[p]
        favour[i] = favour[i] or favour[p]
        kinds[p, page.tag[i]] = kinds.get((p, page.tag[i]), 0) + 1
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        mark[p] += mark[i]
        tags[p] += tags[i]
        below[p] += below[i]
    up = np.maximum(np.array(parent), 0)
    c, k = np.array(chars, dtype=float), np.array(children, dtype=float)
    link_share = np.array(links) / np.maximum(c, 1)
    siblings = np.maximum(k[up] - 1, 0)
    beside = np.where(siblings > 0, np.maximum(c[up] - c - np.array(own)[up], 0) / np.maximum(siblings, 1), 0)
    out = np.column_stack([
        np.log1p(c), link_share, c / np.array(tags), np.array(mark) / np.maximum(c, 1), depth, c / max(c[0], 1), k,
        siblings, np.log1p(c) - np.log1p(beside), np.arange(n) / n,
        [kinds.get((p, t), 0) for p, t in zip(parent, page.tag)] / np.maximum(k[up], 1),
        [t in TEXT_TAGS for t in page.tag], [t[0] == "h" and t[1:].isdigit() for t in page.tag],
        [t in ("li", "dt", "dd") for t in page.tag], below, link_share[up], np.log1p(own),
        page.against, against, page.favour, favour]).astype(np.float64)
    return out, np.array(own)


def weak_labels(page: Page) -> np.ndarray:
    """1, 0 or -1 (not known) per node, from the words of its tag and attributes and those above it.

    Known: what stands below a node that speaks against main text, and what stands inside one
    that speaks for it; a name with words of both kinds (``comment-content``) speaks against it.  On a page where nothing speaks for any node, long text elements count as
    main text.
    """
    n = len(page.tag)
    label = np.full(n, -1)
    any_favour = any(page.favour)
    state = [0] * n  # 1: inside main text, 2: below something against it
    for i in range(1, n):
        s = state[page.parent[i]]
        state[i] = 2 if s == 2 or page.against[i] else 1 if s == 1 or page.favour[i] else 0
        label[i] = {2: 0, 1: 1}.get(state[i], -1)
    if not any_favour:
        size = [0] * n
        for node, text, link in page.pieces:
            size[node] += 0 if link else len(text)
        for i in range(1, n):
            if label[i] < 0 and page.tag[i] in TEXT_TAGS and size[i] >= 120:
                label[i] = 1
    return label


def with_asides(source: str) -> str:
    """The page with every third paragraph repeated below it in a part whose class speaks against main text.

    Stands for comments, notices and the like between or after paragraphs, whose text looks like
    main text; the classes are taken in turn.
    """
    names, count = sorted(AGAINST), iter(range(len(source)))

    def add(m):
        n = next(count)
        if n % 3:
            return m[0]
        word = names[(zlib.crc32(source.encode("utf-8", "replace")) + n) % len(names)]
        return f'{m[0]}<div class="{word}"><p>{m[1]}</p></div>'

    return PARAGRAPH.sub(add, source)


def _labelled(batches):
    for batch in batches:
        for source in batch.column("html").to_pylist():
            for text, also_hidden in ((source or "", True), (with_asides(source or ""), False)):
                page = Page(text)
                features, _ = node_features(page)
                label = weak_labels(page)
                some = np.flatnonzero((label >= 0) & (features[:, 0] > 0))
                if not len(some):
                    continue
                rows, labels = features[some], label[some]
                if also_hidden:
                    hidden = rows.copy()
                    hidden[:, FIRST_HINT:] = 0
                    rows, labels = np.concatenate([rows, hidden]), np.tile(labels, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(labels.astype(np.float64)), pa.array(list(rows), pa.list_(pa.float64()))],
                    names=["label", "values"])


def _tree_tables(text: str) -> list[list[tuple]]:
    """The trees of Spark's model description as node tables: (feature, threshold, left, right, value)."""
    trees: list[list[tuple]] = []
    for line in text.splitlines():
        line = line.strip()
        if line.startswith("Tree "):
            trees.append([])
            weight = float(re.search(r"weight ([-+.\dEe]+)", line)[1])
            todo: list[tuple[int, int]] = []  # (node, which child is next)
        elif line.startswith(("If ", "Predict:")):
            at = len(trees[-1])
            if todo:
                node, side = todo.pop()
                trees[-1][node][side] = at
            if line.startswith("If "):
                m = re.search(r"feature (\d+) <= ([-+.\dEe]+)", line)
                trees[-1].append([int(m[1]), float(m[2]), -1, -1, 0.0])
                todo.append((at, 3))
                todo.append((at, 2))
            else:
                trees[-1].append([-1, 0.0, -1, -1, weight * float(line.split(":")[1])])
    return trees


def margins(model: SimpleNamespace, features: np.ndarray) -> np.ndarray:
    """Log-odds of main text for each row of features."""
    total = np.full(len(features), model.base)
    for tree in model.trees:
        feature, threshold, left, right, value = (np.array(c) for c in zip(*tree))
        at = np.zeros(len(features), dtype=np.int64)
        while (inner := feature[at] >= 0).any():
            go = np.flatnonzero(inner)
            node = at[go]
            at[go] = np.where(features[go, feature[node]] <= threshold[node], left[node], right[node])
        total += 2 * value[at]
    return total


def train(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
          sample_pages: int = 400, rounds: int = 12, depth: int = 4) -> SimpleNamespace:
    """Boosted trees fitted on the nodes of ``sample_pages`` pages, those with the smallest hash of the whole page.

    The hashes are chosen first, so a task holds no page that is not in the sample; repeated rows count once.
    Without a labelled node, or with one kind of label only, the model is a constant.
    """
    rows = columns_first(pages, id=id_col, html=html_col).where("html is not null") \
        .withColumn("h", F.xxhash64("html")).withColumn("i", F.xxhash64("id"))
    chosen = rows.select("h", "i").distinct().orderBy("h", "i").limit(sample_pages)
    sample = rows.join(F.broadcast(chosen), ["h", "i"]).dropDuplicates(["h", "i"]).orderBy("h", "i")
    nodes = table(spark, sample.coalesce(1).mapInArrow(_labelled, "label double, values array<double>"), "html-nodes")
    kinds = {r["label"]: r["n"] for r in nodes.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return SimpleNamespace(base=1.0 if kinds.get(1.0) or not kinds else -1.0, trees=[])
    fitted = GBTClassifier(featuresCol="values", labelCol="label", maxIter=rounds, maxDepth=depth, seed=7) \
        .fit(nodes.select("label", array_to_vector("values").alias("values")))
    return SimpleNamespace(base=0.0, trees=_tree_tables(fitted.toDebugString))


def decode(parent: list[int], margin: np.ndarray, own: np.ndarray) -> list[bool]:
    """Which nodes' own text is main text: the best consistent choice over the whole page."""
    n = len(parent)
    gain = (np.clip(margin, -MARGIN_LIMIT, MARGIN_LIMIT) * np.where(own > 0, 0.5 + np.log1p(own), 0.1)).tolist()
    outside, inside, cut = [-g for g in gain], gain[:], [-g for g in gain]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        outside[p] += max(outside[i], inside[i] - SWITCH_COST)
        inside[p] += max(inside[i], cut[i] - SWITCH_COST)
        cut[p] += cut[i]
    state = [0] * n  # 0: outside, 1: inside, 2: cut out
    for i in range(1, n):
        above = state[parent[i]]
        if above == 0:
            state[i] = int(inside[i] - SWITCH_COST > outside[i])
        elif above == 1:
            state[i] = 1 if inside[i] >= cut[i] - SWITCH_COST else 2
        else:
            state[i] = 2
    return [s == 1 for s in state]


def _extract(model):
    def run(batches):
        own_model = model.value
        for batch in batches:
            sources = batch.column("html").to_pylist()
            for lo in range(0, len(sources), PAGES_PER_PASS):
                pages = [Page(s or "") for s in sources[lo:lo + PAGES_PER_PASS]]
                described = [node_features(p) for p in pages]
                margin = margins(own_model, np.concatenate([f for f, _ in described]))
                texts, at = [], 0
                for page, (features, own) in zip(pages, described):
                    kept = decode(page.parent, margin[at:at + len(own)], own)
                    at += len(own)
                    texts.append(page.text(kept))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page").slice(lo, len(pages)), pa.array(texts, pa.string())], names=["page", "text"])
    return run


def extract(spark: SparkSession, pages: DataFrame, model: SimpleNamespace, html_col: str = "html",
            keep: list[str] | None = None) -> DataFrame:
    """(page, text) of every row of ``pages``; page: its columns ``keep`` (all) as one struct.

    The whole source is read.  Scripts, styles, the head, form fields and the like are never
    text; character references are decoded, white space becomes single spaces, blocks follow
    in page order.

    Null or empty source, or a page without main text: empty text.  Each row is handled alone,
    repeated ones alike.  Broken markup is read leniently: unclosed elements end with their
    parent, stray end tags are ignored, a head ends where something stands that no head may hold.
    Text outside every block element is a paragraph, judged like the others.  An empty table
    gives no rows.
    """
    rows = pages.select(F.struct(*[pages[c] for c in keep or pages.columns]).alias("page"),
                        pages[html_col].cast("string").alias("html"))
    schema = StructType([rows.schema["page"], StructField("text", StringType())])
    return rows.mapInArrow(_extract(spark.sparkContext.broadcast(model)), schema)
