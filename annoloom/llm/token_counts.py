"""Token counts by a byte-level BPE tokenizer, equal to the library's on the whole text.

A text may be cut before a blank that a printable character follows: the tokenizer's pattern then
always starts a piece at that blank, whatever stands before or after (``CUT``).


* Documents up to ``huge`` characters are split by the tokenizer's own pattern, and the counts that its
  model gives for the pieces, which recur all the time, are remembered in a bounded table. Texts with
  characters outside ASCII and Latin-1 letters, or with what could begin a special token, are
  encoded whole.
* Longer documents are encoded in overlapping chunks with offsets. Neighbours are spliced at a token
  boundary that both have in the overlap and that is such a place; where there is none, the overlap
  is doubled, in the end up to the whole text. Memory is that of one chunk.

Odd input: a null text counts as empty (no bytes, no tokens). Repeated rows count alike. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from annoloom.llm.rows import Memo, map_texts

CUT = re.compile(r" (?=[!-~\w])")
#: A character, or the beginning of a special token, that the split below is not meant for.
ODD = re.compile(r"[^\x09-\x0d\x20-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]|<\|")
#: The pattern of the file, for all other texts.
_L = r"a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")
#: Byte-level alphabet: bytes that print stand for themselves, the others for U+0100 and on, in order.
_PRINT = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in _PRINT)}
HUGE = 65_536           # characters from which a document is encoded in chunks
CHUNK = 32_768
OVERLAP = 512
MEMO = 250_000          # remembered pieces in each task, twice
TOKEN_LIMIT = 512

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def load(path: str):
    """The tokenizer of a file, without truncation or padding, in one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def spliced_count(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a huge text, from overlapping chunks."""
    def boundaries(start: int, end: int) -> np.ndarray:
        """Where the tokens of text[start:end] begin, and its end."""
        code = tokenizer.encode(text[start:end], add_special_tokens=False)
        return np.array([start + a for a, _ in code.offsets] + [end], dtype=np.int64)

    size, total, begin = len(text), 0, 0
    end = min(size, chunk)
    here = boundaries(0, end)
    while end < size:
        width = overlap
        while True:
            start, stop = max(begin, end - width), min(size, end - width + max(chunk, 2 * width))
            following = boundaries(start, stop)
            both = np.intersect1d(here, following)
            stable = [p for p in both[(both > start) & (both < end - 1)] if CUT.match(text, p)]
            if stable or start == begin:
                break
            width *= 2
        if stable:
            place = stable[-1]
            total += int(((here >= begin) & (here < place)).sum())
            begin = place
        else:       # no common place at all: the chunk that begins at the last splice, and goes on, counts
            following = boundaries(begin, stop)
        here, end = following, stop
    return total + int(((here[:-1] >= begin)).sum())


def byte_letters(part: str) -> str:
    """A part of a text in the byte-level alphabet that the model works on."""
    if part.isascii() and part.isprintable() and " " not in part:
        return part
    return part.encode().decode("latin-1").translate(BYTE_LETTERS)


def piece_counter(tokenizer, memo_size: int = MEMO):
    """counts(texts): token counts of whole texts, by their remembered pieces."""
    memo, tokenize = Memo(memo_size), tokenizer.model.tokenize

    def compute(pieces: list[str]) -> list[int]:
        return [len(tokenize(byte_letters(p))) for p in pieces]

    def counts(texts: list[str]) -> list[int]:
        cut = [None if ODD.search(t) else PIECES.findall(t) for t in texts]
        distinct = list(dict.fromkeys(chain.from_iterable(c for c in cut if c)))
        of = dict(zip(distinct, memo.values(distinct, compute), strict=True)).__getitem__
        odd = iter(tokenizer.encode_batch_fast([t for t, c in zip(texts, cut, strict=True) if c is None],
                                               add_special_tokens=False))
        return [len(next(odd)) if pieces is None else sum(map(of, pieces)) for pieces in cut]

    return counts


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = TOKEN_LIMIT, huge: int = HUGE,
                 chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """UTF-8 bytes and tokens of every document, and whether it has more than ``limit`` tokens."""
    def make():
        tokenizer = load(tokenizer_path)
        counts = piece_counter(tokenizer)

        def fn(ids, texts):
            texts = [t or "" for t in texts]
            short = iter(counts([t for t in texts if len(t) <= huge]))
            n = [next(short) if len(t) <= huge else spliced_count(tokenizer, t, chunk, overlap)
                 for t in texts]
            return [ids, [len(t.encode()) for t in texts], n, [x > limit for x in n]]
        return fn

    return map_texts(docs, SCHEMA, make, id_col, text_col, rows=1024)
