"""Main text of pages: the reader of markup, the tree, and whole pages against their articles."""

import html
import re
import time

import numpy as np
import pytest

from annoloom.llm import html_extraction as H
from annoloom.llm.html_blocks import BOILER, CONTENT, NEUTRAL, blocks_of
from annoloom.llm.queries import QUERIES

PAGE_DDL = "page_id long, url string, html string, text string, n_chars int"


@pytest.fixture(scope="module")
def tree(spark):
    return H.train_tree(H.example_blocks(spark))


def article(page):
    """The text of the test pages' one article element, whose blocks are h1 and p."""
    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = re.split(r"</?(?:p|h1)>", inside)
    blocks = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_whole_pages(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op11_html_extraction"](spark, sf_dir).collect()
    assert len(got) == len(pages) and got
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article(pages[r.page_id].html), len(r.text))


WORDS = "plain words of a long paragraph " * 8
CASES = [
    ("<nav>Menu</nav><article><h1>T</h1><p>One</p><aside>Also</aside><p>Two<script>x('<p>')</script></article><footer>F</footer>", "T\nOne\nTwo"),
    ("<article><header><h1>T</h1></header><p>a &lt;b&gt; &amp;&nbsp;c\n\t d<br>e</p><footer>by</footer></article>", "T\na <b> & c d e"),
    ("<article><p>One<div class='comments'><article>Reply</article></div></article>", "One"),
    ("<body class='no-sidebar'><div id=header><h1>Site</h1></div><div class=content><p>x<p class=ad>buy<p>more</div>", "x\nmore"),
    ("<main><p>x</p><form><label>Name</label><input value='a>b'><button>Go</button></form><p hidden>no</p></main>", "x"),
    ("<div class='post comments-open'>Text</div>", None),
    (f"<div><a href=x>one</a> <a href=y>two</a> <a>three</a></div><h1>T</h1><p>{WORDS}</p><p>short</p><p>{WORDS}</p><p>All rights</p>",
     f"T\n{WORDS.strip()}\nshort\n{WORDS.strip()}"),
    ("<article><p title=\"x>y\">a<p>b <!-- <p>no</p> -->c<!-- open <p>d", "a\nb c"),
    ("<article>1 < 2 <3 and <b>bold</b>er</article>", "1 < 2 <3 and bolder"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><pre>e\n  f</pre></article>", "a\nb\nc\nd\ne f"),
    ("<article>a<style>p{}</style><svg><text>no</text></svg><textarea><p>no</textarea>b</article>", "ab"),
    ("", ""), (None, ""), ("   ", ""), ("<nav>only a menu</nav>", ""), ("<p", ""), ("<article>x<p", "x"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_pages_by_hand(tree, page, want):
    if want is not None:
        assert H.main_text(page, tree) == want


def test_blocks_and_places():
    found = blocks_of("<nav>a <a>b</a></nav><div><h2>c <a>d e</a> f</h2>g</div><article>h</article>")
    assert [(b.text, b.words, b.linked, b.heading, b.place) for b in found] == [
        ("a b", 2, 1, 0, BOILER), ("c d e f", 4, 2, 1, NEUTRAL), ("g", 1, 0, 0, NEUTRAL), ("h", 1, 0, 0, CONTENT)]


def test_neighbours_are_features():
    x = H.features(blocks_of("<p>a b<p>c <a>d</a><p>e"))
    assert x[:, 3:].tolist() == [[2, 0, 0, 0, 2, .5], [2, .5, 2, 0, 1, 0], [1, 0, 2, .5, 0, 0]]
    assert H.features([]).shape == (0, 9)


def test_the_tree_learns_its_table(spark, tree):
    rows = H.example_blocks(spark).collect()
    pages = {}
    for r in rows:
        pages.setdefault(r.page, []).append(r)
    x = np.vstack([H.features(p) for p in pages.values()])
    assert len(rows) < 200
    assert H.classify(tree, x).tolist() == [bool(r.main) for p in pages.values() for r in p]


def test_the_tree_follows_other_labels(spark):
    """A user's own table counts, also an empty one."""
    only_headings = H.example_blocks(spark).selectExpr("page", "position", "words", "linked", "heading", "place", "heading AS main")
    assert H.main_text("<article><h1>T</h1><p>text</article>", H.train_tree(only_headings)) == "T"
    assert H.main_text("<article><h1>T</h1>", H.train_tree(only_headings.limit(0))) == ""


def test_best_split_is_the_purest():
    draw = np.random.default_rng(2)
    for _ in range(50):
        x, y = draw.integers(0, 6, (30, 3)).astype(float), draw.integers(0, 2, 30)
        gini = [(sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[x[:, f] <= c], y[x[:, f] > c])), f, c)
                for f in range(3) for c in np.unique(x[:, f])[:-1] + .5]
        assert H.best_split(x, y)[0] == pytest.approx(min(gini)[0])


@pytest.mark.parametrize("page", ["<" * 200_000, "<b>" * 60_000 + "x", '<p a="' * 50_000, "<p><b>" * 40_000, "<!--" * 50_000,
                                  "<p " + "=" * 200_000, "<script>" * 30_000, "<b>" * 20_000 + "</i>" * 50_000, "&" * 200_000])
def test_time_is_linear(tree, page):
    start = time.perf_counter()
    H.main_text(page, tree)
    assert time.perf_counter() - start < 10


def test_odd_pages(spark, tree):
    rows = [(1, "u", "<article>a", "z", 7), (1, "u", "<article>a", "z", 7), (None, None, None, None, None), (2, None, "", None, 1),
            (3, "u", f"<article><p>{'word ' * 200_000}", None, 1)]
    got = H.extract(spark.createDataFrame(rows, PAGE_DDL), tree)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(None, None, "", 0), (1, "u", "a", 1), (1, "u", "a", 1), (2, None, "", 0), (3, "u", ("word " * 200_000).strip(), 999_999)]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert H.extract(spark.createDataFrame([], PAGE_DDL), tree).count() == 0
