"""Export tables: current filtered form and the first-generation form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoloom import schema as S
from annoloom.functions import scores as SC
from annoloom.functions import text as TX
from annoloom.operators.facts import resolve_annotators

UI_COLUMNS = ("annotation_guide_link",)


def completed_annotations(records: DataFrame, responses: DataFrame,
                          users: DataFrame) -> DataFrame:
    """Submitted responses on completed records, with the exported field names."""
    done = records.filter(F.col("status") == "completed").drop("status")
    given = (responses.filter(F.col("status") == "submitted")
             .select("response_id", "record_id", "user_id", "quality_score",
                     "error_categories", "corrected_text", "comment"))
    # names first: the texts of the records are then shuffled once, by record
    return resolve_annotators(given, users).join(done, "record_id").select(
        F.col("record_id").alias("id"), "response_id", "benchmark", "record_type", "task_id",
        F.col("source_text").alias("source_text_en"),
        F.col("target_text").alias("translated_text_sr"),
        "quality_score", "error_categories",
        F.col("corrected_text").alias("corrected_text_sr"), "comment", "annotator")


def _keep(min_score: int | None, require_correction: bool) -> Column:
    keep = F.lit(True)
    if min_score is not None:
        keep = keep & F.coalesce(SC.score_digit("quality_score") >= min_score, F.lit(False))
    if require_correction:
        keep = keep & ~SC.uncorrected("corrected_text_sr", "translated_text_sr")
    return keep


def export_annotations(completed: DataFrame, min_score: int | None = None,
                       require_correction: bool = False) -> DataFrame:
    """Rows to export, without columns that only serve the annotation page."""
    ui = [c for c in UI_COLUMNS if c in completed.columns]
    return completed.filter(_keep(min_score, require_correction)).drop(*ui)


def export_filter_counts(completed: DataFrame, min_score: int | None = None,
                         require_correction: bool = False) -> DataFrame:
    """Rows before and after the filters and how many they removed."""
    keep = _keep(min_score, require_correction)
    return completed.agg(F.count(F.lit(1)).alias("before"), F.count_if(keep).alias("after"),
                         F.count_if(~keep).alias("removed"))


def export_legacy(records: DataFrame, responses: DataFrame, users: DataFrame,
                  exported_at: str, status: str | None = "submitted") -> DataFrame:
    """First-generation rows: one per scored response of the chosen status.

    ``exported_at`` is the export's own time, passed in so that a rerun gives the same
    rows. The distance is 0 for an unmodified response and uses the unstripped texts.
    """
    chosen = responses.filter(F.col("quality_score").isNotNull())
    if status:
        chosen = chosen.filter(F.col("status") == status)
    named = resolve_annotators(chosen.select("response_id", "record_id", "user_id", "quality_score",
                                             "corrected_text"), users, short=False)
    joined = named.join(records.select("record_id", "task_id", "target_text"), "record_id")
    corrected = TX.text_or_empty("corrected_text")
    modified = ~SC.accepted_legacy("corrected_text")
    distance = F.when(modified, TX.edit_distance(TX.text_or_empty("target_text"), corrected)) \
        .otherwise(0)
    return joined.select(
        F.coalesce("task_id", "record_id").alias("id"),
        F.when(modified, corrected).otherwise(F.lit(S.LEGACY_UNMODIFIED_TEXT))
        .alias("corrected_text_sr"),
        "quality_score", F.col("annotator").alias("annotator_id"),
        F.lit(exported_at).alias("timestamp"),
        F.struct(modified.alias("was_modified"), distance.alias("edit_distance"))
        .alias("edit_metadata"))
