"""First-generation statistics: submitted responses on any record, marker-only rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom import schema as S
from annoloom.functions import scores as SC
from annoloom.functions import text as TX
from annoloom.operators.facts import resolve_annotators


def submitted(responses: DataFrame) -> DataFrame:
    return responses.filter(F.col("status") == "submitted")


def completion(records: DataFrame, responses: DataFrame) -> DataFrame:
    """Records, records with a submission and the rate in percent.

    The distinct runs map-side first, so a record with very many submissions reaches the
    join as one row.
    """
    answered = submitted(responses).select("record_id").distinct() \
        .withColumn("_hit", F.lit(1))
    return (records.select("record_id").join(answered, "record_id", "left")
            .agg(F.count(F.lit(1)).alias("total_records"),
                 F.count("_hit").alias("completed_records"))
            .withColumn("completion_pct",
                        F.try_divide(F.col("completed_records") * 100.0, "total_records")))


def tasks_per_annotator(responses: DataFrame, users: DataFrame) -> DataFrame:
    """Submissions per annotator, most first; counted by id before the name join."""
    by_id = submitted(responses).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return (resolve_annotators(by_id, users, short=False)
            .groupBy("annotator").agg(F.sum("n").alias("tasks"))
            .orderBy(F.desc("tasks"), "annotator"))


def score_distribution(responses: DataFrame,
                       labels: Sequence[str] = S.QUALITY_BANDS) -> DataFrame:
    """Count and percentage of the shown labels over all non-empty scores."""
    label = SC.quality_band("quality_score")
    counts = submitted(responses).agg(
        F.count(label).alias("scored"),
        *[F.count_if(label == name).alias(f"n{i}") for i, name in enumerate(labels)])
    rows = F.array(*[F.struct(F.lit(name).alias("label"), F.col(f"n{i}").alias("n"))
                     for i, name in enumerate(labels)])
    return (counts.select("scored", F.explode(rows).alias("r"))
            .select("r.label", "r.n",
                    F.try_divide(F.col("r.n") * 100.0, F.col("scored")).alias("pct")))


def modification_rate(responses: DataFrame,
                      markers: Sequence[str] = S.LEGACY_NO_CORRECTION_MARKERS) -> DataFrame:
    accepted = SC.accepted_legacy("corrected_text", markers)
    return (submitted(responses)
            .agg(F.count_if(~accepted).alias("modified"),
                 F.count_if(accepted).alias("accepted"))
            .withColumn("modified_pct", F.try_divide(
                F.col("modified") * 100.0, F.col("modified") + F.col("accepted")))
            .withColumn("accepted_pct", F.lit(100.0) - F.col("modified_pct")))


def score_by_annotator(responses: DataFrame, users: DataFrame,
                       labels: Sequence[str] = S.QUALITY_BANDS) -> DataFrame:
    """Scored submissions and the count of each label per annotator."""
    label = SC.quality_band("quality_score")
    by_id = (submitted(responses).filter(label.isNotNull()).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(label == name).alias(name) for name in labels]))
    return (resolve_annotators(by_id, users, short=False).groupBy("annotator")
            .agg(*[F.sum(c).alias(c) for c in ("total", *labels)])
            .orderBy("annotator"))


def dashboard_stats(records: DataFrame, responses: DataFrame) -> DataFrame:
    """Distinct tasks with a submission, all submissions, completion and modification.

    Percentages are not rounded; that is a matter of display."""
    modified = ~SC.accepted_legacy("corrected_text")
    # One row per record before the join, so a busy record joins as a single row.
    per_record = submitted(responses).groupBy("record_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(modified).alias("m"))
    joined = (records.select("record_id", F.coalesce("task_id", "record_id").alias("task"))
              .join(per_record, "record_id", "left"))
    return (joined.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(F.when(F.col("n") > 0, F.col("task"))).alias("completed_records"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_annotations"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("modified"))
        .withColumn("accepted", F.col("total_annotations") - F.col("modified"))
        .withColumn("completion_pct", F.coalesce(
            F.try_divide("completed_records", "total_records") * 100, F.lit(0.0)))
        .withColumn("modification_pct", 
            F.col("modified") / F.greatest("total_annotations", F.lit(1)) * 100))


def dashboard_per_annotator(responses: DataFrame, users: DataFrame,
                            labels: Sequence[str] = S.QUALITY_BANDS) -> DataFrame:
    label = SC.quality_band("quality_score")
    modified = ~SC.accepted_legacy("corrected_text")
    by_id = submitted(responses).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("annotations"),
        *[F.count_if(label == name).alias(name) for name in labels],
        F.count_if(modified).alias("modified"), F.count_if(~modified).alias("accepted"))
    names = ("annotations", *labels, "modified", "accepted")
    return (resolve_annotators(by_id, users, short=False).groupBy("annotator")
            .agg(*[F.sum(c).alias(c) for c in names]).orderBy("annotator"))


def sample_annotations(records: DataFrame, responses: DataFrame, users: DataFrame,
                       n: int = 20, preview_chars: int = 100) -> DataFrame:
    """First ``n`` submissions by key with the record's text previews."""
    first = (submitted(responses).join(records.select("record_id"), "record_id", "left_semi")
             .orderBy("record_id", "response_id").limit(n))
    texts = records.select("record_id", "task_id", "source_text", "target_text")
    rows = resolve_annotators(first, users, short=False).join(texts, "record_id")
    return (rows.select(
        F.coalesce("task_id", "record_id").alias("record_id"), "response_id", "annotator",
        "quality_score",
        TX.strip(TX.text_or_empty("corrected_text")).alias("corrected_text"),
        (~SC.accepted_legacy("corrected_text")).alias("was_modified"),
        F.substring(TX.text_or_empty("source_text"), 1, preview_chars).alias("source_text"),
        F.substring(TX.text_or_empty("target_text"), 1, preview_chars).alias("target_text"))
        .orderBy("record_id", "response_id"))
