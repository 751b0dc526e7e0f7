"""Quality rules: how much of a text repeats itself.

Words are numbered within their text and n-grams of several lengths are compared by rolling hashes
in numpy; equal hashes are confirmed on the words themselves, so no collision can change a count.

Odd input: a null or empty text, or one without words, has zeros everywhere and fails the base rule
(too few words). Repeated rows are judged one by one and alike. An empty table gives an empty
result. Other columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

from itertools import count
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from annoloom.llm.rows import WORD, filter_texts, map_texts, mix

BASE_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
#: Largest share of a text's word characters inside n-grams that occur twice or more, by n.
MAX_NGRAM_SHARE = {5: 0.35, 6: 0.34, 7: 0.33, 8: 0.32, 9: 0.31, 10: 0.30}
#: Largest share of its word characters inside lines that repeat an earlier line.
MAX_LINE_SHARE = 0.30

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, dup_line_share double, "
          "dup_ngram_share double")

_BASE = np.uint64(0x9E3779B97F4A7C15)


class Repetition(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    dup_line_share: float
    dup_ngram_share: float


def repeated_windows(ids: np.ndarray, hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Which of the windows that start at ``at`` have an equal window among them, sorted."""
    h = hashes[at]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return at[:0]
    windows = np.lib.stride_tricks.sliding_window_view(ids, n)
    left, right = at[order[:-1][same]], at[order[1:][same]]
    if not (windows[left] == windows[right]).all():         # a hash collision: compare the words
        _, inverse, counts = np.unique(windows[at], axis=0, return_inverse=True, return_counts=True)
        return at[counts[inverse.ravel()] > 1]
    hit = np.zeros(len(at), dtype=bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    return at[hit]


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Mask of the positions inside the windows of length n that begin at ``starts``."""
    edges = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(text: str | None) -> Repetition:
    """All counts of one whole text."""
    text = text or ""
    words = WORD.findall(text)
    size = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=size)
    chars = int(lengths.sum())
    seen: set[str] = set()
    dup_lines = dup_line_chars = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                if found := WORD.findall(line):
                    dup_lines += 1
                    dup_line_chars += sum(map(len, found))
            else:
                seen.add(line)
    shares: dict[int, float] = {}
    repeat_words = 0
    first: dict[str, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), dtype=np.int64, count=size)
    if len(first) < size:
        values = mix(ids + 1)
        hashes, at = values.copy(), None
        for n in range(2, max(MAX_NGRAM_SHARE) + 1):        # longer by one word in each step
            if n > size:
                break
            hashes = hashes[:-1] * _BASE + values[n - 1:]
            if n < min(MAX_NGRAM_SHARE):
                continue
            # a repeated n-gram begins where a repeated (n-1)-gram does
            at = np.arange(len(hashes)) if at is None else at[at < len(hashes)]
            at = repeated_windows(ids, hashes, at, n)
            if not len(at):
                break
            mask = covered(at, n, size)
            shares[n] = float(lengths[mask].sum()) / chars
            if n == BASE_WINDOW:
                repeat_words = int(mask.sum())
    symbols = sum(map(text.count, SYMBOLS))
    line_share = dup_line_chars / chars if chars else 0.0
    failed = size < MIN_WORDS or 100 * repeat_words > MAX_REPEAT_PERCENT * size
    fine = line_share <= MAX_LINE_SHARE and all(
        shares.get(n, 0.0) <= most for n, most in MAX_NGRAM_SHARE.items())
    return Repetition(size, chars, symbols, dup_lines, repeat_words, failed, fine and not failed,
                      line_share, max(shares.values(), default=0.0))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts and the verdict ``kept`` per document; no shuffle."""
    def make():
        return lambda ids, texts: [ids, *zip(*map(measure, texts), strict=True)]

    return map_texts(docs, SCHEMA, make, id_col, text_col)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents the rules keep, with all their columns."""
    return filter_texts(docs, lambda: lambda texts: [measure(t).kept for t in texts], text_col)
