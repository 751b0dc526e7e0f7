"""Substring dedup by a window-hash index of reference blocks, in place of relative Lempel-Ziv parsing.

Reference blocks are ranges of documents in order of their ids, indexed by the hashes of all windows of
``WINDOW`` words (``blocks``). Each window of a document is looked up and gets the first reference block of smaller
ids that has it; a run of windows with one block is called a factor. No factor is extended against a reference
text, so it need not be a copy of one phrase; no greedy choice and no check at boundaries is made or needed, as every
window is looked up on its own. Factors are at least ``WINDOW`` words long; all
words inside them are removed, judged on the input and not on what is left.

Hashes have 64 bits; in n windows the chance of any false match is about n * n / 2 ** 65.

Odd input: a null or empty text has no words. Rows with the same id are not smaller than one another.
A row with a null id is left as it is and is no reference. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from annoloom.llm.blocks import DOCS_PER_BLOCK, NO_BLOCK, Grams, block_answers, gathered, with_blocks

WINDOW = 13

SCHEMA = ("doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors long, "
          "kept_text string, factors array<struct<start:long,length:long,block:long>>")
_FACTORS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("block", pa.int64())]))


def parse(flag: np.ndarray, ref: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """Factors (first word, words, block) of a document whose window i is in block ref[i] if flag[i]."""
    at = np.flatnonzero(flag)
    if not len(at):
        return []
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) > 1) | (ref[at[1:]] != ref[at[:-1]])
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    return [(int(a), int(b - a + window), int(ref[a])) for a, b in zip(first, last, strict=True)]


def substring_dedup(docs: DataFrame, window: int = WINDOW, keep_text: bool = True,
                    docs_per_block: int = DOCS_PER_BLOCK, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: its factors, how many words they remove, and the words that stay.

    ``kept_text`` joins these by one blank; it is null unless ``keep_text``.
    """
    blocked = with_blocks(docs, id_col, text_col, docs_per_block)

    def in_order(ids: list, texts: list) -> tuple[list, list]:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0))
        return [ids[i] for i in order], [texts[i] or "" for i in order]

    def grams_of(texts: list) -> Grams:
        return Grams((t.encode() for t in texts), window, False)

    def distinct(ids: list, texts: list) -> np.ndarray:
        return np.unique(grams_of(in_order(ids, texts)[1]).hashes)

    def finish(key: tuple, ours: pa.Table, answers: pa.Table) -> pa.Table:
        block = key[0].as_py()
        ids, texts = in_order(ours.column("doc_id").to_pylist(), ours.column("text").to_pylist())
        grams = grams_of(texts)
        known = np.array([i or 0 for i in ids], dtype=np.int64)
        keys, first, inverse = np.unique(grams.hashes, return_index=True, return_inverse=True)
        ref = np.full(len(keys), NO_BLOCK, dtype=np.int64)
        if block > NO_BLOCK:
            ref, _ = gathered(answers)
        inside = known[grams.doc[first]][inverse] < known[grams.doc]    # documents are in order of ids
        ref = ref[inverse]
        flag = (ref != NO_BLOCK) | inside if block > NO_BLOCK else np.zeros(len(inverse), dtype=bool)
        ref = np.where(ref != NO_BLOCK, ref, block)
        edges = np.searchsorted(grams.doc, np.arange(len(texts) + 1))
        out = []
        for i, text in enumerate(texts):
            ws = text.encode().split()
            a, b = edges[i], edges[i + 1]
            factors = parse(flag[a:b], ref[a:b], window) if flag[a:b].any() else []
            kept = ws
            if factors:
                gone = np.zeros(len(ws), dtype=bool)
                for start, length, _ in factors:
                    gone[start:start + length] = True
                kept = [w for w, g in zip(ws, gone, strict=True) if not g]
            left = b" ".join(kept)
            out.append((ids[i], len(ws), len(ws) - len(kept), hashlib.sha256(left).hexdigest(), len(factors),
                        left.decode() if keep_text else None,
                        [{"start": s, "length": n, "block": r} for s, n, r in factors] if keep_text else None))
        columns = list(zip(*out, strict=True)) or [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), _FACTORS]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        names=["doc_id", "n_words", "n_removed", "kept_sha256", "n_factors", "kept_text", "factors"])

    answers = block_answers(blocked, distinct, exact=True)
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, SCHEMA)


def digests(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", "kept_sha256")
