"""Retracting responses. Every operation has a preview of exactly the rows it removes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom.operators.facts import resolve_annotators
from annoloom.operators.heavy import spread_join


def discards_preview(responses: DataFrame, users: DataFrame) -> DataFrame:
    """Discarded responses with annotator and record."""
    gone = responses.filter(F.col("status") == "discarded")
    return resolve_annotators(gone.select("response_id", "record_id", "user_id"), users) \
        .select("annotator", "record_id", "response_id")


def discards_applied(responses: DataFrame) -> DataFrame:
    """Responses without the discarded ones: those records are open for their annotators
    again. A filter does this; no join with the preview is needed."""
    return responses.filter(~F.coalesce(F.col("status") == "discarded", F.lit(False)))


def _targets(targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct records to reopen for everyone, and distinct (record, annotator)."""
    everyone = targets.filter(F.col("annotator").isNull()).select("record_id").distinct()
    single = targets.filter(F.col("annotator").isNotNull()).select("record_id", "annotator").distinct()
    return everyone, single


BY = ["response_id"]      # what the responses of a hot record are dealt by


def _reopened(responses: DataFrame, users: DataFrame, targets: DataFrame) -> DataFrame:
    """Response ids that ``targets`` names, with annotator.

    Two equi-joins on distinct targets: whole records by id, and single annotators by record
    and name. Neither compares every response of a record with every target of it, and the responses of a
    record with very many are dealt over cells.
    """
    named = resolve_annotators(responses, users)
    everyone, single = _targets(targets)
    whole = spread_join(named, everyone, ["record_id"], "left_semi", BY)
    rest = spread_join(named, everyone, ["record_id"], "left_anti", BY)
    return whole.unionByName(spread_join(rest, single, ["record_id", "annotator"], "left_semi", BY))


def reopen_preview(responses: DataFrame, users: DataFrame, targets: DataFrame) -> DataFrame:
    """Responses that reopening ``targets`` (record_id, annotator or null for all) removes."""
    return _reopened(responses, users, targets) \
        .select("annotator", "record_id", "response_id", "status", "quality_score")


def reopen_applied(responses: DataFrame, users: DataFrame, targets: DataFrame) -> DataFrame:
    """Responses that stay after reopening ``targets``."""
    everyone, single = _targets(targets)
    rest = spread_join(resolve_annotators(responses, users), everyone, ["record_id"], "left_anti", BY)
    return spread_join(rest, single, ["record_id", "annotator"], "left_anti", BY).select(*responses.columns)
