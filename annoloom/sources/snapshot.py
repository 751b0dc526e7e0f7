"""Annotation snapshots: nested records with their responses, to flat tables.

A snapshot is JSON lines, one record each, with ``fields`` and ``metadata`` maps and a list of
responses whose ``values`` are either ``{"value": x}`` or bare. The schema is stated, so nothing is
inferred and unknown members cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annoloom.functions import text as TX
from annoloom.functions import values as V

SNAPSHOT = ("id string, external_id string, status string, updated_at timestamp, "
            "fields map<string,string>, metadata map<string,string>, "
            "responses array<struct<id:string,user_id:string,status:string,values:map<string,string>>>")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).json(path)


def record_id() -> Column:
    """The external id, or the internal one where there is none."""
    return F.coalesce(F.nullif("external_id", F.lit("")), F.col("id"))


def snapshot_records(snapshot: DataFrame) -> DataFrame:
    """Flat records; absent metadata get the same defaults as elsewhere, absent texts are empty."""
    def member(of: str, key: str) -> Column:
        return F.try_element_at(of, F.lit(key))

    return snapshot.select(
        record_id().alias("record_id"),
        F.coalesce(member("metadata", "benchmark"), F.lit("Unknown")).alias("benchmark"),
        F.coalesce(member("metadata", "record_type"), F.lit("unknown")).alias("record_type"),
        TX.text_or_empty(member("metadata", "task_id")).alias("task_id"),
        TX.text_or_empty(member("fields", "source_text_en")).alias("source_text"),
        TX.text_or_empty(member("fields", "translated_text_sr")).alias("target_text"), "status")


def snapshot_responses(snapshot: DataFrame) -> DataFrame:
    """One row per response, with its values unwrapped; ``seq`` is its place in the record.

    The responses of a record are in one row already, so this is a map without a shuffle.
    """
    each = snapshot.select(record_id().alias("record_id"), "updated_at",
                           F.posexplode("responses").alias("seq", "r"))

    def value(key: str) -> Column:
        return F.try_element_at("r.values", F.lit(key))

    return each.select(
        F.coalesce("r.id", F.concat_ws(":", "record_id", F.col("seq").cast("string"))).alias("response_id"),
        "record_id", F.col("r.user_id").alias("user_id"), F.col("r.status").alias("status"),
        V.unwrap_value(value("quality_score")).alias("quality_score"),
        V.unwrap_categories(value("error_categories")).alias("error_categories"),
        V.unwrap_value(value("corrected_text_sr")).alias("corrected_text"),
        V.unwrap_value(value("comment")).alias("comment"), "updated_at",
        F.col("seq").cast("long").alias("seq"))


def category_values(responses: DataFrame) -> DataFrame:
    """(response_id, category) of every chosen category."""
    chosen = F.array_compact(V.category_list("error_categories"))
    return responses.select("response_id", F.explode(chosen).alias("category"))
