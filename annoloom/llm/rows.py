"""Shared row plumbing: Arrow maps over documents, ASCII-blank words, stable 64-bit mixing."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")

_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
          "double": pa.float64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
          "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (part.split() for part in ddl.split(", "))])


def record_batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512,
           text_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces small enough for a worker, also where texts are long."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, min(rows, int(rows * text_bytes / max(batch.nbytes * rows // batch.num_rows, 1))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def map_texts(df: DataFrame, ddl: str, make: Callable[[], Callable[[list, list], Sequence]],
              id_col: str = "doc_id", text_col: str = "text", rows: int = 512) -> DataFrame:
    """One output row per document, by ``make()(ids, texts) -> columns`` in the order of ``ddl``.

    ``make`` runs once in each task, so that what it loads is loaded once. Only the two columns
    are read, whatever else the table holds.
    """
    def run(batches):
        schema, fn = arrow_schema(ddl), make()
        for b in slices(batches, rows):
            yield record_batch(schema, fn(b.column(0).to_pylist(), b.column(1).to_pylist()))

    return df.select(id_col, text_col).mapInArrow(run, ddl)


def filter_texts(df: DataFrame, make: Callable[[], Callable[[list], Sequence[bool]]],
                 text_col: str = "text") -> DataFrame:
    """The rows whose text ``make()`` accepts, with all their columns as they are."""
    at = df.columns.index(text_col)

    def run(batches):
        fn = make()
        for b in slices(batches):
            yield b.filter(pa.array(fn(b.column(at).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


class Memo:
    """Values of keys that recur, computed once and kept in bounded memory.

    Keys live in two generations of at most ``size`` entries or so: those used since the last
    change of generation, and those used in the one before.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def values(self, keys: list, compute: Callable[[list], list]) -> list:
        """The value of each of the distinct ``keys``."""
        young, old, missing = self.young, self.old, []
        for k in keys:
            if k not in young:
                v = old.get(k)
                if v is None:
                    missing.append(k)
                else:
                    young[k] = v
        if missing:
            young.update(zip(missing, compute(missing), strict=True))
        out = [young[k] for k in keys]
        if len(young) > self.size:
            self.young, self.old = {}, young
        return out


def mix(v: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a fixed bijection of 64-bit values that spreads them."""
    v = v.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v
