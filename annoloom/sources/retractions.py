"""Responses with an append-only log of retractions, read as of any version since the last compaction.

Adding responses and retracting them write only the rows concerned, each with the version of its commit. A response counts
as of a version if it was added by then and not retracted at or after its addition by then, so a response that is
given again after a retraction counts again. Compaction writes the rows that count as a new base without a log.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from annoloom.sources import generations, tables

KEY = "response_id"
LOG = f"{KEY} string, _version long"


def _schema(state: generations.Manifest) -> StructType:
    return StructType.fromJson(json.loads(state.facts["schema"]))


def _append(spark: SparkSession, path: str, part: str, rows: DataFrame) -> generations.Manifest:
    """Commit ``rows`` as one more folder of ``part``, with the number of that commit as their version."""
    def change(state: generations.Manifest | None):
        version = (state.version if state else 0) + 1
        folder = generations.new_folder(part)
        rows.withColumn("_version", F.lit(version).cast("long")).write.parquet(f"{path}/{folder}")
        parts = dict(state.parts) if state else {"base": [], "log": []}
        facts = dict(state.facts) if state else {"schema": rows.schema.json(), "from": version}
        return parts | {part: [*parts[part], folder]}, facts

    return generations.update(spark, path, change)


def add_responses(spark: SparkSession, path: str, responses: DataFrame) -> generations.Manifest:
    """Add responses, or make the table; a response that already counts is replaced. The last row by ``seq`` counts."""
    state = generations.latest(spark, path)
    rows = responses if state is None else responses.select(*_schema(state).names)
    return _append(spark, path, "base", tables.last_rows(rows, "seq", KEY))


def retract(spark: SparkSession, path: str, gone: DataFrame) -> generations.Manifest:
    """Append the ids of ``gone`` to the log; nothing else is read or written."""
    if generations.latest(spark, path) is None:
        raise FileNotFoundError(f"no responses at {path}")
    return _append(spark, path, "log", gone.filter(F.col(KEY).isNotNull()).select(KEY).distinct())


def responses_as_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Responses that count as of ``version``, by default the last one.

    Both sides are cut to one row per id before they meet, so no id can make a task large.
    """
    state = generations.latest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no responses at {path}")
    at, first = state.version if version is None else version, state.facts["from"]
    if not first <= at <= state.version:
        raise ValueError(f"version {at} is not in {first} to {state.version}")
    schema = _schema(state)
    base = generations.read_part(spark, state, "base", StructType([*schema.fields]).add("_version", LongType()))
    log = generations.read_part(spark, state, "log", LOG)
    added = base.filter(F.col("_version") <= at)
    if len(state.parts["base"]) > 1:
        added = tables.last_rows(added, "_version", KEY)
    gone = (log.filter(F.col("_version") <= at).groupBy(KEY).agg(F.max("_version").alias("_gone")))
    return (added.join(gone, KEY, "left").filter(F.col("_gone").isNull() | (F.col("_gone") < F.col("_version")))
            .select(*schema.names))


def compact(spark: SparkSession, path: str, keep_old: bool = False) -> generations.Manifest:
    """Write the responses that count as a new base with an empty log. Earlier versions can no longer be read."""
    def change(state: generations.Manifest | None):
        if state is None:
            raise FileNotFoundError(f"no responses at {path}")
        version, folder = state.version + 1, generations.new_folder("base")
        (responses_as_of(spark, path, state.version).withColumn("_version", F.lit(version).cast("long"))
         .write.parquet(f"{path}/{folder}"))
        return {"base": [folder], "log": []}, {**state.facts, "from": version}

    state = generations.update(spark, path, change)
    if not keep_old:
        generations.drop_before(spark, state)
    return state
