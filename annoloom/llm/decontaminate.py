"""Benchmark decontamination: BM25 retrieval of test items for every training passage, then verification.

The test items are an inverted index with BM25 impacts, each divided by its item's score for itself, so
a score is the share of an item that a passage covers. Items are cut into blocks of ``BLOCK``. A
passage first adds up the block maxima of its terms; blocks whose sum stays below the threshold are
skipped without touching their postings (block-max WAND, here for all passages of a batch at once,
with array operations). In the blocks that remain, items are scored exactly, and all that reach the
threshold are retrieved. A retrieved item counts as leaked where the word trigrams of its question
and those of its answer both occur in the passage. One edit can take most trigrams of a part of fewer
than ``SHORT`` words, so such a part is also looked for by its words, if trigrams of the item remain; and
an item of which nearly all trigrams are there, those across its parts included, always counts.

Passages are two spans of the longest item's length and overlap by one, so an item is always inside
one passage. Texts are scored whole. Document frequencies are those of all items. An index larger
than ``SHARD_POSTINGS`` is cut into shards by item, each small enough to broadcast, and the documents
are read once for each.

Odd input: null and empty texts, and items without words, match nothing. Repeated documents and
items are each reported. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom.llm.rows import arrow_schema, filter_texts, record_batch, slices

TERM = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
K1, B = 1.2, 0.75
THRESHOLD = 0.6             # share of an item's own score
OVERLAP = 0.5               # share of the trigrams of question and answer
WHOLE = 0.7                 # share of all trigrams of an item that is enough alone
GRAM = 3
SHORT = 3 * GRAM - 1        # from so many words on, one edit leaves half the trigrams
BLOCK = 8
SHARD_POSTINGS = 2_000_000

LEAKS = ("doc_id long, item_id long, word_start long, score double, question_overlap double, "
         "answer_overlap double")
_POSTINGS = "item_id long, item_row long, term string, tf long, size long, text string"


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer; of one sentence, the last third is."""
    parts = [terms_of(s) for s in SENTENCE.split(text)]
    parts = [p for p in parts if p]
    if len(parts) > 1:
        return [t for p in parts[:-1] for t in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def grams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def overlap(wanted: list[str], passage: list[str]) -> float:
    """Share of the n-grams of ``wanted`` that the passage has; 1.0 where there are none."""
    ours = grams(wanted)
    if not ours:
        return 1.0
    n = len(next(iter(ours)))
    there = {tuple(passage[i:i + n]) for i in range(len(passage) - n + 1)}
    return len(ours & there) / len(ours)


def words_overlap(wanted: list[str], passage: list[str]) -> float:
    """Share of the words of ``wanted`` that the passage has; 1.0 where there are none."""
    there = set(passage)
    return sum(w in there for w in wanted) / len(wanted) if wanted else 1.0


def verified(question: list[str], answer: list[str], passage: list[str], least: float) -> tuple[float, float] | None:
    """The overlaps of question and answer, or None where the passage does not hold the item."""
    q, a = overlap(question, passage), overlap(answer, passage)
    if q >= least and a >= least:
        return q, a
    whole = overlap(question + answer, passage)
    if whole >= WHOLE:
        return q, a
    if whole >= least / 2:
        q, a = (max(o, words_overlap(p, passage)) if len(p) < SHORT else o for o, p in ((q, question), (a, answer)))
        if q >= least and a >= least:
            return q, a
    return None


class Index(NamedTuple):
    """Postings by term; impacts are shares of the item's own score."""
    item_ids: list[int | None]
    texts: list[str]
    span: int
    terms: dict[str, int]
    begins: np.ndarray          # of a term's postings
    items: np.ndarray
    impacts: np.ndarray
    block_begins: np.ndarray    # of a term's blocks
    blocks: np.ndarray
    block_max: np.ndarray


def build_index(rows: list[tuple], n_items: int, mean_size: float, span: int) -> Index | None:
    """``rows``: (item_id, item_row, term, tf, df, size, text) of a shard; text in one row of an item."""
    if not rows:
        return None
    by_item: dict[int, list] = defaultdict(list)
    for r in rows:
        by_item[r[1]].append(r)
    order = sorted(by_item)
    terms: dict[str, int] = {}
    found = []
    for k, row in enumerate(order):
        weights = [(r[2], np.log1p((n_items - r[4] + 0.5) / (r[4] + 0.5))
                    * r[3] * (K1 + 1) / (r[3] + K1 * (1 - B + B * r[5] / mean_size))) for r in by_item[row]]
        whole = sum(w for _, w in weights)
        found += [(terms.setdefault(t, len(terms)), k, w / whole) for t, w in weights]
    found.sort()
    term, item, impact = (np.array(c) for c in zip(*found, strict=True))
    begins = np.searchsorted(term, np.arange(len(terms) + 1))
    key = term * (len(order) // BLOCK + 1) + item // BLOCK
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return Index([by_item[r][0][0] for r in order],
                 [next(x[6] for x in by_item[r] if x[6] is not None) for r in order], span, terms,
                 begins, item, impact, np.searchsorted(term[first], np.arange(len(terms) + 1)),
                 (item // BLOCK)[first], np.maximum.reduceat(impact, first))


def expanded(begins: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``which``, position in the lists) of every entry of the lists ``which``."""
    sizes = begins[which + 1] - begins[which]
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(which)), sizes)
    return owner, np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins[which] - ends + sizes, sizes)


def retrieve(index: Index, texts: list[str | None], threshold: float = THRESHOLD):
    """(text number, first word, item, score) of all passages and items that reach the threshold."""
    words = [terms_of(t) for t in texts]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    known = index.terms.get
    flat = np.fromiter((known(w, -1) for ws in words for w in ws), dtype=np.int64, count=int(sizes.sum()))
    halves = -(-sizes // index.span)                        # each passage is two neighbouring halves
    first_half = np.cumsum(halves) - halves
    position = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    half = np.repeat(first_half, sizes) + position // index.span
    inside = flat >= 0
    n_terms = len(index.terms)
    pairs = np.unique(half[inside] * n_terms + flat[inside])
    half, term = pairs // n_terms, pairs % n_terms
    n_halves, n_blocks = int(halves.sum()), int(index.blocks.max()) + 1
    last = np.zeros(n_halves + 1, dtype=bool)
    last[np.cumsum(halves)[halves > 0] - 1] = True
    edges = np.searchsorted(half, np.arange(n_halves + 2))
    text_of = np.repeat(np.arange(len(words)), halves)
    step = max(1, 4_000_000 // n_blocks)
    for low in range(0, n_halves, step):
        high = min(n_halves, low + step)
        stop = min(n_halves, high + 1)
        a, b = edges[low], edges[stop]
        owner, at = expanded(index.block_begins, term[a:b])
        bound = np.bincount((half[a:b][owner] - low) * n_blocks + index.blocks[at],
                            weights=index.block_max[at], minlength=(stop - low) * n_blocks)
        bound = bound.reshape(stop - low, n_blocks)
        upper = bound[:high - low].copy()
        joined = np.flatnonzero(~last[low:high])            # with the half that follows in the text
        upper[joined] += bound[joined + 1]
        hit = upper >= threshold - 1e-9
        for h in np.flatnonzero(hit.any(axis=1)):
            g = low + h
            own = term[edges[g]:edges[g + 1 if last[g] else g + 2]]
            _, at = expanded(index.begins, np.unique(own))
            at = at[hit[h][index.items[at] // BLOCK]]
            score = np.bincount(index.items[at], weights=index.impacts[at])
            for item in np.flatnonzero(score >= threshold - 1e-9):
                n = text_of[g]
                yield int(n), int((g - first_half[n]) * index.span), int(item), float(score[item]), words[n]


def leaks_in(index: Index, texts: list[str | None], threshold: float, least: float) -> dict[tuple, tuple]:
    """(text number, item) -> its best passage with question and answer verified."""
    best: dict[tuple, tuple] = {}
    answers: dict[int, tuple] = {}
    for n, start, item, score, words in retrieve(index, texts, threshold):
        if item not in answers:
            answers[item] = question_and_answer(index.texts[item])
        passage = words[start:start + 2 * index.span]
        if best.get((n, item), (0, 0.0))[1] < score and (found := verified(*answers[item], passage, least)):
            best[n, item] = (start, score, *found)
    return best


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
            shard_postings: int = SHARD_POSTINGS) -> list[Index]:
    """The index of all items, in as many shards as its size needs."""
    def run(batches):
        schema = arrow_schema(_POSTINGS)
        for b in slices(batches):
            rows = []
            for row, item, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = terms_of(text)
                rows += [(item, row, t, n, len(words), None if i else text)
                         for i, (t, n) in enumerate(sorted(Counter(words).items()))]
            if rows:
                yield record_batch(schema, list(zip(*rows, strict=True)))

    numbered = items.select(F.monotonically_increasing_id().alias("item_row"), F.col(id_col).cast("long"), text_col)
    postings = numbered.mapInArrow(run, _POSTINGS)
    total = postings.agg(F.count(F.lit(1)).alias("n"), F.sum("tf").alias("words"), F.max("size").alias("span"),
                         F.countDistinct("item_row").alias("items")).first()
    if not total["n"]:
        return []
    shards = -(-total["n"] // shard_postings)
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    full = postings.join(df, "term").select("item_id", "item_row", "term", "tf", "df", "size", "text")
    out = []
    for s in range(shards):         # one shard at a time, each of a bounded size, comes to the driver
        rows = full.filter(F.pmod(F.xxhash64("item_row"), F.lit(shards)) == s).collect()
        index = build_index([tuple(r) for r in rows], total["items"], total["words"] / total["items"], total["span"])
        if index is not None:
            out.append(index)
    return out


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP,
               id_col: str = "doc_id", text_col: str = "text", shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """One row per document and test item that it holds."""
    spark = docs.sparkSession
    out = None
    for index in indexes(items, shard_postings=shard_postings):
        shared = spark.sparkContext.broadcast(tuple(index))     # at most shard_postings entries

        def run(batches, shared=shared):
            schema, one = arrow_schema(LEAKS), Index(*shared.value)
            for b in slices(batches):
                ids = b.column(0).to_pylist()
                found = leaks_in(one, b.column(1).to_pylist(), threshold, least)
                if found:
                    rows = [(ids[n], one.item_ids[item], *r) for (n, item), r in sorted(found.items())]
                    yield record_batch(schema, list(zip(*rows, strict=True)))

        part = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, LEAKS)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], LEAKS) if out is None else out


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP,
               text_col: str = "text", shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    for index in indexes(items, shard_postings=shard_postings):
        shared = docs.sparkSession.sparkContext.broadcast(tuple(index))

        def make(shared=shared):
            one = Index(*shared.value)

            def fn(texts):
                bad = {n for n, _ in leaks_in(one, texts, threshold, least)}
                return [i not in bad for i in range(len(texts))]
            return fn

        docs = filter_texts(docs, make, text_col)
    return docs
