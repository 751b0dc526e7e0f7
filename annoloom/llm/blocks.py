"""Which n-grams of a corpus occur in other documents, without one row per n-gram.

Documents are cut into blocks: ranges of the document id with a bounded number of rows. A block sorts
its distinct n-gram hashes and deals them over fragments of the hash range, as binary arrays. In a
fragment, the arrays of all blocks are merged; each block gets back, in the order in which it sent
its hashes, the first block that has them, or that there is none. The block then does its final
step, with its own documents and these answers. An n-gram that a third of all documents share is one
entry for each block, and an exchange moves a few bytes per n-gram.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoloom.llm.rows import mix

MAX_RANGES = 128
DOCS_PER_BLOCK = 1024
BYTES_PER_DOC = 4096        # of text, beyond which a hashed block takes fewer documents
BYTES_PER_FRAGMENT = 24 << 20    # of text, about a sixth as many n-grams
NO_BLOCK = -1               # blocks of rows without a document id have this number or a smaller one
LONG_WORD = 64              # bytes of a word that are hashed with those of all others
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LANE = 8
_LANE_MASK = np.array([(1 << 8 * n) - 1 for n in range(_LANE + 1)], dtype=np.uint64)
_BLANK = np.isin(np.arange(256), list(b"\t\n\v\f\r "))


def with_blocks(docs: DataFrame, id_col: str, text_col: str, docs_per_block: int, *more: Column) -> DataFrame:
    """(doc_id, text, block) and the columns ``more``, with blocks in the order of ids.

    Ids are cut at quantiles into ranges, and ranges evenly into blocks, so that neither gaps nor
    clusters of ids make large blocks. Only the id column is read for this.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    n = docs.filter(F.col(id_col).isNotNull()).count()
    ranges = max(1, min(MAX_RANGES, -(-n // docs_per_block)))
    parts = max(1, -(-n // (ranges * docs_per_block)))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(ranges + 1)], 20 * ranges)
                    .alias("c")).first()["c"] if n else None
    cuts = sorted(set(cuts)) if cuts else [0]
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    last = len(cuts)
    at = F.greatest(F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))), F.lit(1))
    low = F.element_at(bounds, at)
    high = F.element_at(bounds, F.least(at + 1, F.lit(last)))
    part = F.when(high > low, F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor(
        (F.col("doc_id") - low) * F.lit(float(parts)) / (high - low))))).otherwise(F.lit(0))
    block = (at - 1) * parts + part
    spread = F.lit(NO_BLOCK) - F.pmod(F.xxhash64("text"), F.lit(ranges * parts))
    return rows.withColumn("block", F.coalesce(block, spread).cast("long"))


def hashed_blocks(docs: DataFrame, id_col: str, text_col: str, docs_per_block: int, *more: Column) -> tuple[DataFrame, int]:
    """The same columns, with blocks by a hash of id and text, for uses that need no order of blocks; and the bytes
    of all texts.

    Their number follows from the rows and the bytes of text, so bursts of ids, one id on very many rows and null
    ids make no large block; only rows that are equal in both stay together.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // docs_per_block), -(-size // (docs_per_block * BYTES_PER_DOC)))
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long")), size


def word_hashes(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word of the texts, laid end to end, and how many words each text has.

    All words are hashed together, eight bytes at a time: the first lane of every word, then the second of those that have
    one. Words of up to eight bytes and equal length have different hashes. The few long words take a hash of their own.
    """
    parts = list(texts)
    laid = b" ".join([b"", *parts, b" " * _LANE])           # a blank before each text, and room to read a lane after the last
    blank = _BLANK[np.frombuffer(laid, dtype=np.uint8)]
    turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1     # words begin and end by turns
    begin, end = turns[::2], turns[1::2]
    size = end - begin
    hashes = size.astype(np.uint64) * _BASE
    lanes = np.ndarray(len(laid) - _LANE + 1, dtype="<u8", buffer=laid, strides=(1,))
    rest = np.arange(len(begin))
    for at in range(0, LONG_WORD, _LANE):
        left = size[rest] - at
        hashes[rest] = mix(hashes[rest] ^ lanes[begin[rest] + at] & _LANE_MASK[np.minimum(left, _LANE)])
        rest = rest[left > _LANE]
    for i in rest:
        hashes[i] = xxhash.xxh64_intdigest(laid[begin[i]:end[i]])
    edges = 1 + np.cumsum([0, *(len(p) + 1 for p in parts)])
    return hashes, np.diff(np.searchsorted(begin, edges))


class Grams:
    """Rolling n-gram hashes of the documents of one block, laid end to end; words are what ASCII blanks separate."""

    def __init__(self, texts: Iterable[bytes], n: int, short_too: bool):
        values, sizes = word_hashes(texts)
        total = len(values)
        self.sizes, self.begins = sizes, np.cumsum(sizes) - sizes
        count = np.maximum(sizes - n + 1, 0)
        start = np.repeat(self.begins - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        hashes = np.zeros(max(total - n + 1, 0), dtype=np.uint64)
        for k in range(n):
            hashes = hashes * _BASE + values[k:k + len(hashes)]
        doc = np.repeat(np.arange(len(sizes)), count)
        found = mix(hashes[start])
        if short_too:           # a document of fewer words is one n-gram of its own length
            few = np.flatnonzero((sizes > 0) & (sizes < n))
            rest = np.zeros(len(few), dtype=np.uint64)
            for k in range(n):
                inside = sizes[few] > k
                rest[inside] = rest[inside] * _BASE + values[self.begins[few[inside]] + k]
            doc = np.concatenate([doc, few])
            found = np.concatenate([found, mix(rest + sizes[few].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))])
            start = np.concatenate([start, self.begins[few]])
        #: hash, document and first word of every n-gram
        self.hashes, self.doc, self.start = found, doc, start


def block_answers(blocked: DataFrame, distinct: Callable[[list, list], np.ndarray], exact: bool) -> DataFrame:
    """For each block and fragment, which of its hashes occur in which other block.

    ``distinct(ids, texts)`` gives the sorted distinct 64-bit hashes of a block. With ``exact`` all
    bits are compared; without, the 32 bits below the fragment's, for a first selection whose few
    false hits a later step removes. With ``exact``, rows without an id are no reference. The answer to each hash is the rank of the first block that has it
    in ``refs``, if that is an earlier one; ``others`` has a bit for each hash that any other block has.
    """
    spark = blocked.sparkSession
    bits = max(4, int(2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    kind = "<u8" if exact else "<u4"

    def send(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        if block <= NO_BLOCK and exact:
            return pa.table({"fragment": pa.array([], pa.int64()), "block": pa.array([], pa.int64()),
                             "keys": pa.array([], pa.binary())})
        hashes = distinct(group.column("doc_id").to_pylist(), group.column("text").to_pylist())
        top = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.searchsorted(top, np.arange((1 << bits) + 1))
        keys = hashes if exact else hashes >> np.uint64(32 - bits) & np.uint64(0xFFFFFFFF)
        keys = keys.astype(kind)
        some = np.flatnonzero(np.diff(edges))
        return pa.table({"fragment": pa.array(some, pa.int64()),
                         "block": pa.array(np.full(len(some), block), pa.int64()),
                         "keys": pa.array([keys[edges[f]:edges[f + 1]].tobytes() for f in some], pa.binary())})

    def answer(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        blocks = np.array(group.column("block").to_pylist(), dtype=np.int64)
        arrays = [np.frombuffer(k, kind) for k in group.column("keys").to_pylist()]
        sizes = np.array([len(a) for a in arrays])
        keys, source = np.concatenate(arrays), np.repeat(np.arange(len(arrays)), sizes)
        order = np.argsort(keys, kind="stable")             # blocks stay in order within equal keys
        ranked = keys[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        group_of = np.cumsum(fresh) - 1
        first = source[order][np.flatnonzero(fresh)][group_of]
        size = np.bincount(group_of)[group_of]
        ref, other = np.empty(len(keys), dtype=np.int32), np.empty(len(keys), dtype=bool)
        ref[order], other[order] = first, size > 1
        ref[ref == source] = -1
        ends = np.cumsum(sizes)
        out = {"block": [], "fragment": [], "refs": [], "ranks": [], "others": []}
        for i, (a, b) in enumerate(zip(ends - sizes, ends, strict=True)):
            used, rank = np.unique(ref[a:b], return_inverse=True)
            out["block"].append(int(blocks[i]))
            out["fragment"].append(group.column("fragment")[0].as_py())
            out["refs"].append(np.where(used < 0, np.int64(NO_BLOCK), blocks[used]).astype("<i8").tobytes())
            out["ranks"].append(rank.astype("<u2" if len(used) < 65_536 else "<u4").tobytes())
            out["others"].append(np.packbits(other[a:b]).tobytes())
        return pa.table(out, schema=answers_schema)

    answers_schema = pa.schema([("block", pa.int64()), ("fragment", pa.int64()), ("refs", pa.binary()),
                                ("ranks", pa.binary()), ("others", pa.binary())])
    sent = blocked.groupBy("block").applyInArrow(send, "fragment long, block long, keys binary")
    return sent.groupBy("fragment").applyInArrow(
        answer, "block long, fragment long, refs binary, ranks binary, others binary")


def shared_levels(blocked: DataFrame, distinct: Callable[[list, list], tuple[np.ndarray, np.ndarray]],
                  text_bytes: int) -> DataFrame:
    """For each block and fragment, in how many documents its hashes occur in all, as a power of two.

    ``distinct(ids, texts)`` gives the sorted distinct 64-bit hashes of a block and in how many of its documents each is.
    The 32 bits below the fragment's are compared, so a level may be too high for a few hashes, but equal hashes have
    equal levels in all blocks. ``levels`` has a byte for each hash, in the order of the hashes: the binary
    logarithm of the number of documents, rounded down. The number of fragments grows with the bytes of text.
    """
    spark = blocked.sparkSession
    least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(31, max(4, (max(least, -(-text_bytes // BYTES_PER_FRAGMENT)) - 1).bit_length()))

    def send(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        hashes, counts = distinct(group.column("doc_id").to_pylist(), group.column("text").to_pylist())
        top = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.searchsorted(top, np.arange((1 << bits) + 1))
        keys = (hashes >> np.uint64(32 - bits) & np.uint64(0xFFFFFFFF)).astype("<u4")
        some = np.flatnonzero(np.diff(edges))
        sent = {"fragment": some, "block": np.full(len(some), block), "keys": [], "at": [], "counts": []}
        for f in some:
            part = counts[edges[f]:edges[f + 1]]
            many = np.flatnonzero(part > 1)                 # most are in one document
            sent["keys"].append(keys[edges[f]:edges[f + 1]].tobytes())
            sent["at"].append(many.astype("<u4").tobytes())
            sent["counts"].append(part[many].astype("<u4").tobytes())
        return pa.table(sent, schema=sent_schema)

    def answer(group: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(k, "<u4") for k in group.column("keys").to_pylist()]
        sizes = np.array([len(a) for a in arrays])
        ends = np.cumsum(sizes)
        keys, counts = np.concatenate(arrays), np.ones(int(ends[-1]), dtype=np.int64)
        for begin, at, many in zip(ends - sizes, group.column("at").to_pylist(), group.column("counts").to_pylist(), strict=True):
            counts[begin + np.frombuffer(at, "<u4").astype(np.int64)] = np.frombuffer(many, "<u4")
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        begins = np.flatnonzero(fresh)
        total = np.add.reduceat(counts[order], begins)
        level = np.empty(len(keys), dtype=np.uint8)
        level[order] = (np.frexp(total.astype(np.float64))[1] - 1)[np.cumsum(fresh) - 1]
        return pa.table([group.column("block"), group.column("fragment"),
                         pa.array([level[e - s:e].tobytes() for s, e in zip(sizes, ends, strict=True)], pa.binary())],
                        names=["block", "fragment", "levels"])

    sent_schema = pa.schema([("fragment", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("at", pa.binary()),
                             ("counts", pa.binary())])
    sent = blocked.groupBy("block").applyInArrow(send, "fragment long, block long, keys binary, at binary, counts binary")
    return sent.groupBy("fragment").applyInArrow(answer, "block long, fragment long, levels binary")


def gathered_levels(answers: pa.Table) -> np.ndarray:
    """The levels of a block's sorted distinct hashes."""
    return np.frombuffer(b"".join(answers.sort_by("fragment").column("levels").to_pylist()), dtype=np.uint8)


def gathered(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(first other block or -1, occurs in any other block) of a block's sorted distinct hashes."""
    refs, others = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=bool)]
    for row in answers.sort_by("fragment").select(["refs", "ranks", "others"]).to_pylist():
        used = np.frombuffer(row["refs"], "<i8")
        rank = np.frombuffer(row["ranks"], "<u2" if len(used) < 65_536 else "<u4")
        refs.append(used[rank])
        others.append(np.unpackbits(np.frombuffer(row["others"], np.uint8), count=len(rank)).astype(bool))
    return np.concatenate(refs), np.concatenate(others)
