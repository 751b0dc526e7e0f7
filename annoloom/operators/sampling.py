"""Seeded samples, global order and calibration sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annoloom import schema as S
from annoloom.functions import text as TX
from annoloom.operators.facts import positioned
from annoloom.sources import generations, ordered

ORDER_DIGITS = 3          # leading hex digits of the seeded key: 16 ** 3 order buckets
MAX_DIGITS = 4            # 16 ** 4 bucket counts are the most that is ever broadcast


def shuffled_order(df: DataFrame, item_id: str, seed: int = 42) -> DataFrame:
    """Add ``position`` 1..n of a repeatable random order.

    The order is that of a seeded md5 key. Only ids are ranked, by range partitions whose counts give the positions;
    the rows get their positions by id, so no text is moved for the ranking. Rows of one id are told
    apart by nothing and get the positions of each other: ids should be distinct.
    """
    ids = df.select(item_id).withColumn("_key", TX.seeded_key(item_id, seed))
    placed = positioned(ids, F.col("_key"), F.col(item_id)).select(F.col(item_id).alias("_item"), "position")
    return df.join(placed, F.col(item_id).eqNullSafe(F.col("_item"))).drop("_item")


def write_shuffled(spark: SparkSession, path: str, df: DataFrame, item_id: str, seed: int = 42,
                   rows_per_file: int = ordered.ROWS_PER_FILE) -> generations.Manifest:
    """Store the rows physically in that order; read them with :func:`ordered.read_ordered`.

    The rows are moved once, to the file that holds their part of the order; as many files as their number asks for.
    """
    return ordered.write_ordered(spark, path, df, [TX.seeded_key(item_id, seed), F.col(item_id)], rows_per_file)


def first_in_order(ids: DataFrame, item_id: str, n: int, seed: int = 42, digits: int = ORDER_DIGITS) -> DataFrame:
    """The first ``n`` ids of that order.

    The leading digits of the key cut the ids into even buckets. From the bucket counts, 16 ** digits rows, it
    is known which buckets hold the first n; the others are dropped before the shuffle.
    """
    if not 1 <= digits <= MAX_DIGITS:
        raise ValueError(f"digits must be 1 to {MAX_DIGITS}, got {digits}")
    keyed = ids.withColumn("_key", TX.seeded_key(item_id, seed)).withColumn("_bucket", F.substring("_key", 1, digits))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .drop("_n").filter(F.col("_before") < n))
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy("_key", item_id))
    placed = (keyed.join(F.broadcast(offsets), "_bucket")      # at most 16 ** digits rows
              .withColumn("_position", F.col("_before") + rank))
    return placed.filter(F.col("_position") <= n).select(item_id)


def sample_n(df: DataFrame, item_id: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), the same ones for the same seed.

    The ids are put in the seeded order and cut at position n, which never gathers the sample in
    one place; the rows themselves are only filtered by the chosen ids. Ids are distinct.
    """
    return df.join(first_in_order(df.select(item_id), item_id, n, seed), item_id, "left_semi")


def _pending(records: DataFrame, benchmarks: DataFrame) -> DataFrame:
    known = benchmarks.select("benchmark")
    return (records.filter((F.col("status") == "pending")
                           & F.col("record_type").isin(*S.RECORD_TYPES))
            .join(known, "benchmark", "left_semi"))


def calibration_sample(records: DataFrame, benchmarks: DataFrame, k: int = 1,
                       seed: int = 42) -> DataFrame:
    """``k`` pending records per benchmark and type, drawn by seed.

    Only ids are ranked. The leading digits of the seeded key cut a stratum into even buckets;
    from their counts it is known which ones hold the first k, and ranks are taken inside these.
    So neither a large stratum nor a large k is one group, and texts are read for the chosen ids.
    """
    stratum = ["benchmark", "record_type"]
    keyed = (_pending(records, benchmarks).select("record_id", *stratum)
             .withColumn("_key", TX.seeded_key("record_id", seed))
             .withColumn("_bucket", F.substring("_key", 1, ORDER_DIGITS)))
    before = W.partitionBy(*stratum).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    needed = (keyed.groupBy(*stratum, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .filter(F.col("_before") < k).drop("_n"))
    rank = F.row_number().over(W.partitionBy(*stratum, "_bucket").orderBy("_key", "record_id"))
    chosen = (keyed.join(needed, [*stratum, "_bucket"]).withColumn("_rank", F.col("_before") + rank)
              .filter(F.col("_rank") <= k))
    return records.join(chosen.select("record_id"), "record_id", "left_semi")


def calibration_records(sampled: DataFrame) -> DataFrame:
    """Sampled records as fresh calibration records; those without text are dropped."""
    source, target = TX.text_or_empty("source_text"), TX.text_or_empty("target_text")
    return (sampled.filter((source != "") & (target != "")).select(
        F.concat(F.lit("cal_"), "record_id").alias("record_id"),
        F.coalesce("benchmark", F.lit("Unknown")).alias("benchmark"),
        F.coalesce("record_type", F.lit("unknown")).alias("record_type"),
        TX.text_or_empty("task_id").alias("task_id"),
        source.alias("source_text"), target.alias("target_text"),
        target.alias("suggested_text"), F.lit("pending").alias("status")))


def empty_strata(records: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Benchmark and type combinations with no pending record."""
    types = F.array(*[F.lit(t) for t in S.RECORD_TYPES])
    wanted = benchmarks.select("benchmark", F.explode(types).alias("record_type"))
    present = (records.filter(F.col("status") == "pending")
               .select("benchmark", "record_type").distinct())
    return wanted.join(present, ["benchmark", "record_type"], "left_anti")


def calibration_composition(calibration: DataFrame) -> DataFrame:
    return calibration.groupBy("record_type").agg(F.count(F.lit(1)).alias("records"))


def required_submissions(users: DataFrame, members: DataFrame) -> DataFrame:
    """Submissions a calibration record needs: one per non-owner member, at least two."""
    inside = members.select("user_id").distinct()
    return (users.filter(F.col("role") != "owner").join(inside, "user_id", "left_semi")
            .agg(F.greatest(F.count(F.lit(1)), F.lit(2)).alias("min_submitted")))


def derived_status(records: DataFrame, responses: DataFrame,
                   min_submitted: int | DataFrame = 1) -> DataFrame:
    """Record status that follows from its submissions.

    ``min_submitted`` is a number, or the one-row table of :func:`required_submissions`.
    Submissions are counted per record before the join, map-side first.
    """
    counts = (responses.filter(F.col("status") == "submitted")
              .groupBy("record_id").agg(F.count(F.lit(1)).alias("n")))
    n = F.coalesce("n", F.lit(0))
    least = F.lit(min_submitted) if isinstance(min_submitted, int) else min_submitted.scalar()
    return (records.select("record_id").join(counts, "record_id", "left").withColumn("_least", least)
            .select("record_id", n.alias("submitted"),
                    F.when(n >= F.col("_least"), "completed").otherwise("pending")
                    .alias("status")))
