"""The prefix trie against brute force, with bands of several heights."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from annoloom.llm import prefix_trie as T
from annoloom.llm.queries import QUERIES
from annoloom.sources import tables

CONV_DDL = "conv_id long, turn long, role string, text string, node string, depth int"


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(list)
    own = {c: [(r, x) for _, _, r, x in sorted(found)] for c, found in convs.items()}
    for c, turns in own.items():
        lent = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:lent] + turns[lent:])
        for i in range(len(path) + 1):
            members[path[:i]].add(c)
        ends[path].append(c)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children[n]) or 1
        saved[n] = sum(saved[k] for k in children[n]) + (len(members[n]) - 1) * (len(n[-1][1]) if n else 0)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def nodes(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def odd_rows():
    """Shared prefixes, long conversations, no donor for one block, nulls and repeated turns."""
    draw, rows = random.Random(5), []
    for c in range(320):
        if c != 100:
            for t in range(30 if c % 50 == 0 else draw.choice([1, 2, 3, 4, 9])):
                text = f"x{c % 7}{t}" if draw.random() < .9 else draw.choice([None, "", "y"])
                rows.append((c, t, ("user", "assistant")[t % 2] if draw.random() < .95 else None, text, "n", 1))
    odd = [(None, 0, "user", "n", "n", 1), (7, None, "system", "s", "n", 1), (7, None, "system", "s", "n", 1),
           (900, 0, "user", "z" * 100_000, None, None), (901, 0, None, None, None, None)]
    return rows + odd


@pytest.mark.parametrize("height", [None, 1, 3])
def test_bands_of_any_height(spark, odd_rows, height):
    df = spark.createDataFrame(odd_rows, CONV_DDL).repartition(5)
    assert nodes(T.prefix_trie(df, height)) == brute([r[:4] for r in odd_rows])


def test_conversations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = nodes(QUERIES["op13_prefix_trie"](spark, sf_dir))
    assert got == brute(rows) and got


def test_no_conversations(spark):
    empty = spark.createDataFrame([], CONV_DDL)
    assert nodes(T.prefix_trie(empty)) == []
    null = spark.createDataFrame([(None, 0, "user", "x", None, None)], CONV_DDL)
    assert nodes(T.prefix_trie(null)) == []


def test_many_ends_at_one_node(spark, monkeypatch):
    """Copies of one conversation; the ids go through strings of a bounded number."""
    rows = [(c, t, "user", f"t{t}", None, None) for c in range(700) for t in range(2)]
    df = spark.createDataFrame(rows, CONV_DDL).repartition(7)
    assert nodes(T.prefix_trie(df)) == brute([r[:4] for r in rows])
    ended = tables.stage(T.prefixes(T.turn_digests(df), 8), "ended")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert T.ends(ended).count() < 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_band_bounds_what_a_node_explodes_to(spark, odd_rows):
    turns = T.turn_digests(spark.createDataFrame(odd_rows, CONV_DDL))
    sizes = {(r.depth, len(r.above)) for r in T.prefixes(turns, 4).select("depth", "above").collect()}
    assert max(n for _, n in sizes) == 4
    assert sizes == {(d, (d - 1) % 4 + 1 if d else 0) for d, _ in sizes}
    assert [T.band_height(d) for d in (0, 13, 64, 65, 10_000)] == [8, 8, 8, 9, 100]
