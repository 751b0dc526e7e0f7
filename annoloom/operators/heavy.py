"""Joins in which one key may hold a great share of the rows.

Adaptive execution splits a skewed join only where both sides are plain shuffles, and only beyond its size thresholds. Here
the split is part of the query. Keys with more rows than a fair share are found by a mergeable top-k sketch, in one
pass with a few kilobytes for each task. Their rows are dealt over cells in proportion, and the rows of the other side
are repeated once per cell; all other keys have a single cell. Every row of the left side is in exactly one cell, so
the result is that of the plain join, however good the sketch is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

MOST_HEAVY = 1000         # keys that are split, and entries of the map that goes to the tasks
CELLS_PER_TASK = 2        # a cell holds at most 1 / (this * shuffle partitions) of the rows
BROADCAST_BYTES = 8 << 20  # a side that is measured to be no larger is broadcast
HOWS = ("inner", "left", "left_semi", "left_anti")


def _key(keys: Sequence[str]) -> Column:
    """One number for a key; null keys have one too, so that rows without a key are spread as well."""
    return F.xxhash64(*keys)


def heavy_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_key, _cells) of the keys with more rows than a cell may hold, at most ``MOST_HEAVY``.

    A key with more than one of ``MOST_HEAVY`` parts of all rows cannot be missed by the sketch.
    """
    cells = CELLS_PER_TASK * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = (rows.select(_key(keys).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {MOST_HEAVY}, {10 * MOST_HEAVY})").alias("_top"), F.count(F.lit(1)).alias("_rows"))
        .select(F.explode("_top").alias("_t"), "_rows"))
    needed = F.ceil(F.col("_t.count") * F.lit(cells) / F.col("_rows")).cast("int")
    return top.select(F.col("_t.item").alias("_key"), needed.alias("_cells")).filter(F.col("_cells") > 1)


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and _has_map(kind.elementType))


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                deal_by: Sequence[str] | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` with bounded rows of ``left`` per task, whatever its keys.

    ``how`` is one of ``HOWS``. A heavy key's rows of ``left`` are dealt by a hash of ``deal_by``, by default all
    columns; name a column that tells rows apart if there is one. The choice depends on the row alone, so a task
    that is run again deals the same. Few rows of ``right`` should have a heavy key: they are repeated per cell.
    """
    if how not in HOWS:
        raise ValueError(f"unknown join {how!r}, expected one of {HOWS}")
    keys = list(keys)
    heavy = (heavy_keys(left, keys)                             # one value with at most MOST_HEAVY entries
             .agg(F.map_from_entries(F.collect_list(F.struct("_key", "_cells")))).scalar())
    cells = F.coalesce(F.try_element_at("_heavy", _key(keys)), F.lit(1))
    by = list(deal_by or [f.name for f in left.schema if not _has_map(f.dataType)])
    dealt = left.withColumn("_heavy", heavy).withColumn("_cell", F.pmod(F.hash(*by), cells)).drop("_heavy")
    repeated = (right.withColumn("_heavy", heavy)
                .withColumn("_cell", F.explode(F.sequence(F.lit(0), cells - 1))).drop("_heavy"))
    return dealt.join(repeated, [*keys, "_cell"], how).drop("_cell")


def measured_bytes(rows: DataFrame) -> int:
    """Bytes of the values of narrow ``rows`` (strings, numbers, times), measured in one pass."""
    sizes = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + 16 for f in rows.schema]
    return rows.select(sum(sizes[1:], sizes[0]).alias("_b")).agg(F.coalesce(F.sum("_b"), F.lit(0))).first()[0]


def side_join(left: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner",
              deal_by: Sequence[str] | None = None, source: DataFrame | None = None) -> DataFrame:
    """Join of a narrow side table: broadcast if it is measured to be small, else :func:`spread_join`.

    ``source`` is what is measured, by default ``side`` itself: a table that ``side`` is part of or grouped from.
    """
    if measured_bytes(side if source is None else source) <= BROADCAST_BYTES:
        return left.join(F.broadcast(side), list(keys), how)
    return spread_join(left, side, keys, how, deal_by)
