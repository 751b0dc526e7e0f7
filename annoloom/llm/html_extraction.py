"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into text blocks (``html_blocks``). Each block has a word count and a link density, and sees those of
the block before and of the block after; it knows whether it is a heading, whether it stands in page furniture, in an
article or in neither, and whether its page marks an article at all. A decision tree (Gini impurity, grown here on a
small labelled table of blocks) says which blocks are the article's.

``extract`` keeps a page where it is: one pass, no shuffle, one page at a time in memory. The tree is a few dozen
numbers.

Odd input: a null or empty page, or one without article text, has an empty text. Tags that are cut off or whose quotes
are not closed end at the next ``>``; unclosed comments and scripts reach to the end of the page. White space is what
``str.split`` takes for it, so a no-break space counts; ``<br>`` is white space. Repeated rows and null ids are
pages like any other, other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoloom.llm.html_blocks import BOILER, CONTENT, NEUTRAL, Block, blocks_of
from annoloom.llm.rows import arrow_schema, record_batch, slices

EXTRACTED = "page_id long, url string, text string, n_chars long"
LABELLED = "page int, position int, words int, linked int, heading int, place int, main int"
#: The most rows of a labelled table that are used; the first pages, whole table below that.
MOST_LABELLED = 20_000
MAX_DEPTH, MIN_LEAF = 8, 1

# Labelled blocks of example pages, in page order. Each block is the label (+ article, - not), its
# words / words in links, and flags: h heading, c inside an article element, b inside page furniture.
EXAMPLES = """
-6/6b -9/0b +12/0hc +80/2c +1/0c +45/0c +3/0c -12/3b
-2/2b -1/1b +5/0hc +18/0c +7/7c +150/9c +2/0c -30/0b -25/0b
-4/4b +9/0hc +2/0c +6/0c +1/0c -22/22b -60/1b -1/0b
-40/0b +7/0hc +33/0c +12/12c +3/3c +20/15c -14/0b -8/8b -90/0b
-3/0 +6/0hc +70/0c +4/0c -35/0 -10/2
-8/8 -5/0h +25/0c +61/3c -45/1 -6/6 -3/0
-30/0b -12/0 +8/0hc +20/0c +1/1c +3/0c -9/0h -28/0
-1/1b +10/0hc +1/0c +1/0c +1/1c +2/2c +5/5c +2/0c -120/0b -7/0b
-75/0b +1/0c -50/0b -3/0b
+4/4c +40/30c +9/4c -18/0b -2/0hb -33/2b -64/0b
-5/0b -16/0b +3/0hc +500/0c -4/0b -200/5b
-1/1 -1/1 -2/2 -1/1 +8/0h +64/2 +91/0 +38/1 -5/1 -2/2 -1/1
-5/5 -3/3 +6/0h +44/0 +9/0 +52/1 +4/0h +70/3 -3/3 -12/9 -6/2
-2/2 -4/4 -1/1 +11/0h +120/4 +6/0 +85/0 -7/7 -4/4 -9/9
-4/0 -2/2 -3/3 +5/0h +31/0 +27/2 +41/0 -6/0 -3/3 -2/2
-20/20 -15/13 +9/0h +55/5 +16/0 +48/0 -18/16 -9/9 -4/4
-6/6 -2/2 -3/0h -5/5 -6/6 -4/4 -3/0h -7/7 -5/5
-10/10 +60/0 +1/0 +60/0 -2/0
-18/18 +75/2 +12/1 +30/0 -16/16 -40/38
-6/6 +90/4 +5/0h +110/3 -9/9 -30/30
-14/11 -1/1 +25/1 +140/6 +2/0 +33/1 -25/22
+40/0 +35/2 +60/0
+14/0h +22/0
-3/3 -3/3 +7/0h +3/0 +66/1 +12/0 +72/0 -4/0 -2/0 -5/5
"""


def example_blocks(spark: SparkSession) -> DataFrame:
    """The labelled table that goes with the library."""
    rows = []
    for page, line in enumerate(EXAMPLES.strip().splitlines()):
        for position, block in enumerate(line.split()):
            counts = block[1:].rstrip("hbc").split("/")
            place = BOILER if "b" in block else CONTENT if "c" in block else NEUTRAL
            rows.append((page, position, int(counts[0]), int(counts[1]), int("h" in block), place, int(block[0] == "+")))
    return spark.createDataFrame(rows, LABELLED)


def features(blocks: Sequence) -> np.ndarray:
    """One row per block of a page, from (words, linked, heading, place): place and heading, whether the page marks
    an article, words and link density of the block and of its two neighbours (0 beyond the ends)."""
    if not blocks:
        return np.zeros((0, 9))
    own = np.array([[b.words, b.linked / b.words] for b in blocks], dtype=float)
    gap = np.zeros((1, 2))
    before, after = np.vstack([gap, own[:-1]]), np.vstack([own[1:], gap])
    anchored = float(any(b.place == CONTENT for b in blocks))
    kind = np.array([[b.place, b.heading, anchored] for b in blocks], dtype=float)
    return np.hstack([kind, own, before, after])


#: A tree is a list of nodes (feature, threshold, left, right), left where the value is at most the threshold;
#: a leaf has feature -1 and its answer as threshold.
Tree = list[tuple[int, float, int, int]]


def _impurity(right: np.ndarray, n: np.ndarray) -> np.ndarray:
    share = right / np.maximum(n, 1)
    return n * share * (1 - share)


def best_split(x: np.ndarray, y: np.ndarray) -> tuple[float, int, float] | None:
    """(impurity, feature, threshold) of the purest cut; the first feature and smallest threshold on ties."""
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cuts = np.flatnonzero(v[:-1] < v[1:])
        cuts = cuts[(cuts + 1 >= MIN_LEAF) & (len(y) - cuts - 1 >= MIN_LEAF)]
        if not len(cuts):
            continue
        cost = _impurity(ones[cuts], cuts + 1) + _impurity(ones[-1] - ones[cuts], len(y) - cuts - 1)
        i = int(np.argmin(cost))
        if best is None or cost[i] < best[0] - 1e-12:
            best = (float(cost[i]), f, float(v[cuts[i]] + v[cuts[i] + 1]) / 2)
    return best


def grow(x: np.ndarray, y: np.ndarray, depth: int = MAX_DEPTH) -> Tree:
    """The decision tree of labelled rows; without rows it accepts nothing."""
    tree: Tree = []

    def node(rows: np.ndarray, left: int) -> int:
        at, ones = len(tree), int(y[rows].sum())
        tree.append((-1, float(2 * ones > len(rows)), 0, 0))
        cut = best_split(x[rows], y[rows]) if left and 0 < ones < len(rows) else None
        if cut:
            below = x[rows, cut[1]] <= cut[2]
            tree[at] = (cut[1], cut[2], node(rows[below], left - 1), node(rows[~below], left - 1))
        return at

    node(np.arange(len(y)), depth)
    return tree


def train_tree(labelled: DataFrame) -> Tree:
    """The tree of a small table of labelled blocks (columns of ``LABELLED``), at most ``MOST_LABELLED`` rows of it."""
    rows = labelled.orderBy("page", "position").limit(MOST_LABELLED).collect()      # bounded by the limit
    pages: dict[int, list] = {}
    for r in rows:
        pages.setdefault(r.page, []).append(r)
    if not rows:
        return grow(features([]), np.zeros(0, dtype=int))
    return grow(np.vstack([features(p) for p in pages.values()]), np.array([r.main for p in pages.values() for r in p]))


def classify(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Whether each row is article text: all rows go down the tree together."""
    at = np.zeros(len(x), dtype=int)
    feature, cut, left, right = (np.array(c) for c in zip(*tree, strict=True))
    for _ in range(MAX_DEPTH + 1):
        inner = feature[at] >= 0
        if not inner.any():
            break
        below = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= cut[at]
        at = np.where(inner, np.where(below, left[at], right[at]), at)
    return cut[at] > 0.5


def main_text(html: str | None, tree: Tree) -> str:
    blocks: list[Block] = blocks_of(html or "")
    if not blocks:
        return ""
    kept = classify(tree, features(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extract(pages: DataFrame, tree: Tree, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches):
        schema = arrow_schema(EXTRACTED)
        for b in slices(batches, 64):
            texts = [main_text(html, tree) for html in b.column(2).to_pylist()]
            yield record_batch(schema, [b.column(0).to_pylist(), b.column(1).to_pylist(), texts, [len(t) for t in texts]])

    return pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), html_col).mapInArrow(run, EXTRACTED)
