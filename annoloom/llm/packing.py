"""Packing of tokenised documents into fixed-length sequences, online and in bounded space.

Each task keeps a fixed number of open windows. A document goes into the open window where it leaves
the least room (best fit); full windows of a longer one are cut off first. When it fits nowhere and
all windows are open, the fullest is topped up with the head of the document and emitted. At the end
of its partition a task merges its open windows into full sequences and one rest of less than a
window. The rests of ``GROUP`` neighbouring partitions, at most that many windows, are merged in one
more step; what then remains is laid out in sequences whose lengths are powers of two, so it needs
no padding. All other rows pass that step spread by sequence.

This tokenizer drops white space and never joins across the parts that its pattern makes, so the ids of
a text are those of its parts in turn; these are kept in a bounded table.

Odd input: a null or empty text still has its end token. Repeated rows are packed each on its own.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom.llm.rows import arrow_schema, record_batch, slices
from annoloom.llm.token_counts import ODD, byte_letters, load

WINDOW = 4096
OPEN_WINDOWS = 64
END_ID = 2
SMALL_GAP = 8           # a window with at most this much room left is emitted as it is
GROUP = 64              # partitions whose rests are merged together
MEMO = 300_000          # encoded parts kept in each task, and those of one more batch
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|"
                   r"[^\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_ROUTED = PIECES + ", route long, rest binary"
WITH_IDS = PIECES + ", ids array<int>"


class PartTable(dict):
    """Numbers of parts, given as they are asked for; ``ids_of`` turns numbers into token ids.

    One look-up per part of a text is all that a known part costs. The table starts anew once it is full.
    """

    def __init__(self, tokenize, size: int):
        super().__init__()
        self.tokenize, self.size = tokenize, size
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.pool = np.empty(1 << 12, dtype=np.uint32)
        self.ends = np.zeros(1 << 10, dtype=np.int64)       # ends[i + 1] is where the ids of part i end

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.fresh.append(part)
        return number

    def numbers(self, texts: list[list[str] | None]) -> list[np.ndarray | None]:
        """The numbers of the parts of each text; all of them are valid until the next call."""
        if len(self) >= self.size:
            self._empty()
        get = self.__getitem__
        found = [None if t is None else np.fromiter(map(get, t), dtype=np.int64, count=len(t)) for t in texts]
        if self.fresh:
            tokenize, first = self.tokenize, len(self) - len(self.fresh)
            ids = [[t.id for t in tokenize(byte_letters(p))] for p in self.fresh]
            self.fresh = []
            if len(self.ends) <= len(self):
                self.ends = np.resize(self.ends, 2 * len(self) + 1)
            np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)), out=self.ends[first + 1:len(self) + 1])
            self.ends[first + 1:len(self) + 1] += self.ends[first]
            if self.ends[len(self)] > len(self.pool):
                self.pool = np.resize(self.pool, 2 * int(self.ends[len(self)]))
            self.pool[self.ends[first]:self.ends[len(self)]] = np.fromiter(chain.from_iterable(ids), dtype=np.uint32)
        return found

    def ids_of(self, which: np.ndarray) -> np.ndarray:
        begins = self.ends[which]
        own = self.ends[which + 1] - begins
        ends = np.cumsum(own)
        return self.pool[np.repeat(begins - ends + own, own) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Encoder:
    """Token ids of whole texts by way of their parts.

    The file's pattern splits a lower-cased text into runs of letters, single digits and runs of
    other signs. That split is done here and the tokenizer's model gives the ids of each part, kept
    in a bounded table. Texts that the split is not meant for go through the whole tokenizer.
    """

    def __init__(self, path: str, memo_size: int = MEMO):
        self.tokenizer = load(path)
        self.parts = PartTable(self.tokenizer.model.tokenize, memo_size)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """For each text its ids, without the end token."""
        texts = [t or "" for t in texts]
        numbers = self.parts.numbers([None if ODD.search(t) else PARTS.findall(t.lower()) for t in texts])
        for text, which in zip(texts, numbers, strict=True):
            if which is None:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            else:
                yield self.parts.ids_of(which)


#: doc_id, first token, ids, tokens of the document
Piece = tuple[int | None, int, np.ndarray, int]


class Packer:
    """The open windows of one task; ``place`` and ``finish`` give full windows."""

    def __init__(self, window: int, open_windows: int, small_gap: int):
        self.window, self.most, self.small_gap = window, open_windows, small_gap
        self.open: list[tuple[int, int, list[Piece]]] = []      # (room, number, pieces), by room
        self.number = 0

    def place(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[Piece]]:
        size, at = len(ids), 0
        while size - at >= self.window:
            yield [(doc_id, at, ids[at:at + self.window], size)]
            at += self.window
        while at < size:
            need = size - at
            k = bisect_left(self.open, (need, -1))              # the least room that is enough
            if k < len(self.open):
                room, number, pieces = self.open.pop(k)
            elif len(self.open) < self.most:
                self.number += 1
                room, number, pieces = self.window, self.number, []
            else:                                               # fits nowhere: top up the fullest
                room, number, pieces = self.open.pop(0)
                need = room
            pieces.append((doc_id, at, ids[at:at + need], size))
            at += need
            if room - need <= self.small_gap:
                yield pieces
            else:
                insort(self.open, (room - need, number, pieces))

    def finish(self) -> Iterator[list[Piece]]:
        """Full windows out of the open ones; the last list may be shorter than a window."""
        yield from recut([p for _, _, pieces in self.open for p in pieces], [], self.window)
        self.open = []


def recut(pieces: list[Piece], last: list[int], window: int) -> Iterator[list[Piece]]:
    """Lay pieces end to end and cut them into windows; ``last`` has lengths for the final ones."""
    sequence: list[Piece] = []
    total = sum(len(p[2]) for p in pieces)
    lengths = iter([window] * (total // window) + (last or [total % window]))
    room = next(lengths) if total else 0
    for doc_id, start, ids, size in pieces:
        at = 0
        while at < len(ids):
            part = ids[at:at + room]
            sequence.append((doc_id, start + at, part, size))
            at += len(part)
            room -= len(part)
            if room == 0:
                yield sequence
                sequence, room = [], next(lengths, 0)


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _rows(sequence: list[Piece], sequence_id: int, with_ids: bool) -> list[tuple]:
    """Piece rows of one finished sequence."""
    out, offset = [], 0
    for doc_id, start, ids, size in sequence:
        raw = ids.astype("<u4").tobytes()
        out.append((doc_id, start, len(ids), zlib.crc32(raw), size, sequence_id, offset,
                    sequence_id, raw if with_ids else None))
        offset += len(ids)
    return out


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
         small_gap: int = SMALL_GAP, with_ids: bool = False, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece of a document: where it begins, its length and its place in a sequence.

    Every id of a document is in exactly one piece. With ``with_ids`` the ids themselves are kept
    too. Sequence ids from tasks are not negative; those of merged rests are.
    """
    def fill(batches):
        schema = arrow_schema(_ROUTED)
        encoder, packer = Encoder(tokenizer_path), Packer(window, open_windows, small_gap)
        task = TaskContext.get().partitionId()
        sequence_id = task << 33

        def table_of(rows):
            return record_batch(schema, list(zip(*rows, strict=True)))

        for b in slices(batches, 512):
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), encoder.encode(b.column(1).to_pylist()),
                                   strict=True):
                for sequence in packer.place(doc_id, np.append(ids, np.uint32(END_ID))):
                    rows += _rows(sequence, sequence_id, with_ids)
                    sequence_id += 1
            if rows:
                yield table_of(rows)
        for sequence in packer.finish():
            full = sum(len(p[2]) for p in sequence) == window
            rows = _rows(sequence, sequence_id, with_ids or not full)
            if not full:
                rows = [(*r[:7], -1 - task // GROUP, r[8]) for r in rows]
            sequence_id += 1
            yield table_of(rows)

    ddl = WITH_IDS if with_ids else PIECES

    def merge(batches):
        schema, rests = arrow_schema(ddl), {}
        for b in batches:
            ours = np.array(b.column(7).to_pylist(), dtype=np.int64) < 0
            done = b.filter(pa.array(~ours))
            columns = [done.column(i) for i in range(7)]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32)
                                         for x in done.column(8).to_pylist()], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            for r in b.filter(pa.array(ours)).to_pylist():
                rests.setdefault(r["route"], []).append(r)
        for route, rows in sorted(rests.items()):
            rows.sort(key=lambda r: (r["sequence_id"], r["offset"]))
            pieces = [(r["doc_id"], r["start"], np.frombuffer(r["rest"], "<u4"), r["doc_tokens"])
                      for r in rows]
            total = sum(len(p[2]) for p in pieces)
            sequences = recut(pieces, powers_of_two(total % window), window)
            out = [x for i, s in enumerate(sequences) for x in _rows(s, (route << 20) - i, with_ids)]
            columns = list(zip(*out, strict=True))
            if with_ids:
                columns[7] = [np.frombuffer(x, "<u4").astype(np.int32) for x in columns[8]]
            yield record_batch(schema, columns[:len(schema)])

    return (docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(fill, _ROUTED)
            .repartition("route").mapInArrow(merge, ddl))
