"""Duplicate content across records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom.functions import text as TX
from annoloom.operators.heavy import spread_join
from annoloom.sources import tables

KINDS = ("id", "source", "target", "pair")
PREVIEW_CHARS = 80


def record_hashes(records: DataFrame) -> DataFrame:
    """Ids and content hashes; the texts are read once and go no further."""
    return records.select(
        "record_id", "benchmark",
        F.col("record_id").alias("id_key"),
        TX.content_hash("source_text").alias("source_key"),
        TX.content_hash("target_text").alias("target_key"),
        TX.pair_hash("source_text", "target_text").alias("pair_key"),
        TX.preview("source_text", PREVIEW_CHARS).alias("preview"))


def _groups(hashes: DataFrame, *keys: str, with_preview: bool = False) -> DataFrame:
    """Groups of two or more. Counts and minima combine map-side, so a text that fills
    a third of the table reaches its reducer as one row per map task."""
    extra = [F.min("preview").alias("preview")] if with_preview else []
    return (hashes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.min("record_id").alias("first_id"),
        (F.min("benchmark") != F.max("benchmark")).alias("cross_benchmark"), *extra)
        .filter(F.col("copies") > 1))


def duplicate_groups(records: DataFrame, kind: str) -> DataFrame:
    """Groups of records that share an id, a source, a target or both texts."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}, expected one of {KINDS}")
    return _groups(record_hashes(records).withColumnRenamed(f"{kind}_key", "key"), "key",
                   with_preview=kind == "source").orderBy("first_id")


def duplicate_members(records: DataFrame, kind: str = "source") -> DataFrame:
    """Every record of every duplicate group.

    The texts are read once, their hashes are staged. Group sizes come from a partial aggregation, not
    from a window over the group; in the join back the members of a very large group are dealt over cells.
    """
    hashes = tables.stage(record_hashes(records).select(
        F.col(f"{kind}_key").alias("key"), "record_id", "benchmark"), "hashes")
    groups = hashes.groupBy("key").agg(F.count(F.lit(1)).alias("copies")) \
        .filter(F.col("copies") > 1)
    return spread_join(hashes, groups, ["key"], deal_by=["record_id"]).select("key", "copies", "record_id", "benchmark")


def duplicate_summary(records: DataFrame) -> DataFrame:
    """Records and cross- and within-benchmark groups for each kind, zeros included."""
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_key").alias("key"))
                     for k in KINDS])
    long = (record_hashes(records)
            .select("record_id", "benchmark", F.explode(keys).alias("k"))
            .select("record_id", "benchmark", "k.kind", "k.key"))
    groups = long.groupBy("kind", "key").agg(
        F.count(F.lit(1)).alias("copies"),
        (F.min("benchmark") != F.max("benchmark")).alias("cross_benchmark"))
    many, cross = F.col("copies") > 1, F.col("cross_benchmark")

    def of(kind: str):
        return F.col("kind") == kind

    counts = groups.agg(*[c for k in KINDS for c in (
        F.coalesce(F.sum(F.when(of(k), F.col("copies"))), F.lit(0)).alias(f"{k}_n"),
        F.count_if(of(k) & many & cross).alias(f"{k}_cross"),
        F.count_if(of(k) & many & ~cross).alias(f"{k}_within"))])
    rows = F.array(*[F.struct(
        F.lit(k).alias("kind"), F.col(f"{k}_n").alias("records"),
        F.col(f"{k}_cross").alias("cross_groups"),
        F.col(f"{k}_within").alias("within_groups")) for k in KINDS])
    return counts.select(F.explode(rows).alias("r")).select("r.*")
