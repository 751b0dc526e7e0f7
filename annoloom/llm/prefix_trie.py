"""Prefix trie of conversations and its subtree totals, by depth-band rollup.

A node is a distinct sequence of the first d turns (role, text). Its id is a running 128-bit digest over the digests of
its turns, so texts leave the scan as digests and nothing is compared pair by pair.

1. ``prefixes``: the turns of each conversation, in order, give one narrow row for each of its prefixes: the node, the
   nodes above it in its band, and whether the conversation goes on. One shuffle of digests; rows are sorted
   outside Python and streamed, a turn at a time.
2. ``trie_nodes``: distinct nodes with their smallest member and counts, map-side combined, so a first turn that a
   third of all conversations share is one row for each map task.
3. ``subtree_totals``: bands are ``height`` levels high. A node at depth d explodes to the nodes above it down from the
   level ``height * ((d - 1) // height)``, its band's root level, at most ``height`` of them and never to the root of a
   deep trie. One aggregation gives each node its total within its band. Band roots are then completed from the
   lowest band up, one round a band, and what lies below a completed root is added to the nodes above it in its band.
   With ``height`` the larger of 8 and the square root of the greatest depth, rounds and explosion both stay below
   that root.
4. ``ends``: ids of the conversations that end at a node, range-partitioned by (node, id), so that a node with very many
   is spread over tasks, joined there to strings of at most ``IDS_PER_CHUNK`` ids; a node's hash takes these
   strings in their order.

A parent's id is joined to its children by ``heavy.spread_join``: the children of a node with a great share of them are
dealt over cells.

Odd input: a null role or text is empty; rows of a null conv_id belong to no conversation and have no node; null turns come
first, rows of one turn in the order of their role and the digest of their text, repeated rows are turns of their own.
A table without conversations has no root and gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom.llm.rows import arrow_schema, record_batch, slices
from annoloom.operators.heavy import spread_join
from annoloom.sources import tables

BLOCK = 100               # conversations that share a donor
MOST_BORROWED = 6         # fewer than so many turns come from the donor
LEAST_HEIGHT = 8
IDS_PER_CHUNK = 4096
ROOT = hashlib.sha256(b"").digest()[:16]

TURNS = "conv_id long, turn long, digest binary, chars long"
PREFIXES = ("conv_id long, depth int, node binary, parent binary, above array<binary>, chars long, goes_on int")
CHUNKS = "node binary, first_id long, ids string"
ENDS = "node binary, ends_sha256 string"


def turn_digests(conversations: DataFrame) -> DataFrame:
    """Each turn as a digest of its role and text, and the code points of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))


def borrowed(conv_id: int) -> int:
    """How many turns a rebuilt conversation takes from its donor."""
    return zlib.crc32(str(conv_id).encode()) % MOST_BORROWED


def step(node: bytes, digest: bytes) -> bytes:
    """The node below ``node`` by one more turn."""
    return hashlib.sha256(node + digest).digest()[:16]


def band_top(depth: int, height: int) -> int:
    """The depth of the band root above a node of depth 1 or more."""
    return (depth - 1) // height * height


def prefixes(turns: DataFrame, height: int) -> DataFrame:
    """One row for each prefix of each rebuilt conversation, the empty one included.

    Conversations of one block of ids have the same donor, which comes first in its block; of it only
    its first turns are remembered.
    """
    def run(batches):
        schema = arrow_schema(PREFIXES.replace("array<binary>", "binary"))
        schema = schema.set(4, schema.field(4).with_type(_binaries()))
        donor, first_turns, conv, walk = None, [], None, None

        def begin(c):
            """[node, depth, nodes above from the band's top, last row, turns to skip]"""
            lent = borrowed(c)
            state = [ROOT, 0, [], (c, 0, ROOT, None, [], 0), lent]
            out = []
            if first_turns is not None:
                for digest, chars in first_turns[:lent]:
                    forward(state, c, digest, chars, out)
            return state, out

        def forward(state, c, digest, chars, out):
            out.append((*state[3], 1))
            node, depth = state[0], state[1] + 1
            state[2] = [node] if band_top(depth, height) == depth - 1 else [*state[2], node]
            state[0], state[1] = step(node, digest), depth
            state[3] = (c, depth, state[0], node, state[2], chars)

        for b in slices(batches):
            out = []
            for block, c, digest, chars in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c != conv:
                    if walk is not None:
                        out.append((*walk[3], 0))
                    if block != donor:
                        donor, first_turns = block, []
                    conv, seen = c, 0
                    if c == donor:
                        # the donor's own first turns come back to it, so it is itself whatever it borrows
                        walk = [ROOT, 0, [], (c, 0, ROOT, None, [], 0), 0]
                    else:
                        walk, more = begin(c)
                        out += more
                if c == donor and len(first_turns) < MOST_BORROWED - 1:
                    first_turns.append((digest, chars))
                seen += 1
                if seen > walk[4]:
                    forward(walk, c, digest, chars, out)
            if out:
                yield record_batch(schema, list(zip(*out, strict=True)))
        if walk is not None:
            yield record_batch(schema, list(zip((*walk[3], 0), strict=True)))

    block = F.col("conv_id") - F.col("conv_id") % BLOCK
    dealt = turns.withColumn("block", block).repartition("block").sortWithinPartitions(
        "block", F.col("conv_id") != F.col("block"), "conv_id", F.asc_nulls_first("turn"), "role", "digest")
    return dealt.select("block", "conv_id", "digest", "chars").mapInArrow(run, PREFIXES)


def _binaries():
    import pyarrow as pa

    return pa.list_(pa.binary())


def trie_nodes(rows: DataFrame) -> DataFrame:
    """Distinct nodes: (node, depth, parent, above, chars, conv_id, n_convs, n_ends)."""
    return rows.groupBy("node", "depth", "parent", "above", "chars").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.count_if(F.col("goes_on") == 0).alias("n_ends"))


def _own(nodes: DataFrame) -> DataFrame:
    """What a node itself adds to all totals above it: whether it is a leaf, and the tokens it saves."""
    return nodes.select("node", "depth", "above", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"),
                        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))


def subtree_totals(nodes: DataFrame, height: int, deepest: int) -> DataFrame:
    """(node, n_children, n_leaves, saved_tokens) of every node, from staged ``nodes``."""
    own = _own(nodes)
    up = F.expr("transform(above, (a, i) -> named_struct('node', a, 'child', IF(i = size(above) - 1, 1L, 0L)))")
    to_self = F.array(F.struct(F.col("node").alias("node"), F.lit(0).cast("long").alias("child")))
    in_band = (own.select(F.explode(F.concat(to_self, up)).alias("to"), "leaf", "saved")
               .groupBy(F.col("to.node").alias("node")).agg(
                   F.sum("to.child").alias("n_children"), F.sum("leaf").alias("n_leaves"),
                   F.sum("saved").alias("saved_tokens")))
    tops = range((deepest - 1) // height * height, 0, -height)
    if not tops:
        return in_band
    in_band = tables.stage(in_band, "trie-bands")
    roots = tables.stage(
        own.filter((F.col("depth") > 0) & (F.col("depth") % height == 0)).join(in_band, "node")
        .select("node", "depth", "above", (F.col("n_leaves") - F.col("leaf")).alias("n_leaves"),
                (F.col("saved_tokens") - F.col("saved")).alias("saved_tokens")), "trie-roots")
    added, below = [], None
    for depth in tops:
        level = roots.filter(F.col("depth") == depth)
        if below is not None:           # the completed roots one band lower
            more = below.select(F.element_at("above", 1).alias("node"), "n_leaves", "saved_tokens").groupBy("node").agg(
                F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
            level = level.join(more, "node", "left").select(
                "node", "depth", "above", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"))
        below = tables.stage(level, "trie-level")
        added.append(below.select(F.explode("above").alias("node"), F.lit(0).cast("long").alias("n_children"),
                                  "n_leaves", "saved_tokens"))
    every = in_band
    for level in added:
        every = every.unionByName(level)
    return every.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])


def ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of every node at which a conversation ends."""
    def chunks(batches):
        schema = arrow_schema(CHUNKS)
        node, ids, out = None, [], []
        for b in slices(batches, 4096):
            for n, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if ids and (n != node or len(ids) == IDS_PER_CHUNK):
                    out.append((node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = n
                ids.append(c)
            if out:
                yield record_batch(schema, list(zip(*out, strict=True)))
                out = []
        if ids:
            yield record_batch(schema, [[node], [ids[0]], [",".join(map(str, ids))]])

    def hashes(batches):
        schema = arrow_schema(ENDS)
        node, digest = None, None
        for b in slices(batches):
            out = []
            for n, ids in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if digest is not None and n == node:
                    digest.update(f",{ids}".encode())
                    continue
                if digest is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = n, hashlib.sha256(ids.encode())
            if out:
                yield record_batch(schema, list(zip(*out, strict=True)))
        if digest is not None:
            yield record_batch(schema, [[node], [digest.hexdigest()]])

    spread = (rows.filter("goes_on = 0").select("node", "conv_id").repartitionByRange("node", "conv_id")
              .sortWithinPartitions("node", "conv_id").mapInArrow(chunks, CHUNKS))
    return (spread.repartition("node").sortWithinPartitions("node", "first_id").select("node", "ids")
            .mapInArrow(hashes, ENDS))


def band_height(deepest: int) -> int:
    """Levels of a band, for a trie of that depth."""
    height = LEAST_HEIGHT
    while height * height < deepest:
        height += 1
    return height


def prefix_trie(conversations: DataFrame, height: int | None = None) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (conv_id, turn, role, text).

    The first turns of a conversation are those of its block's first one, as ``borrowed`` says, the others its own.
    """
    turns = turn_digests(conversations)
    if height is None:
        longest = turns.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
        height = band_height(longest + MOST_BORROWED)
    rows = tables.stage(prefixes(turns, height), "trie-prefixes")
    nodes = tables.stage(trie_nodes(rows), "trie-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = subtree_totals(nodes, height, deepest)
    named = spread_join(nodes.drop("above", "chars"), nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")),
                        ["parent"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return (named.join(totals, "node").join(ends(rows), "node", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))
