"""Tables written in a total order, with the positions that each of their files holds.

Rows are range-partitioned, sorted and written once, whole, by tasks that write several files each. How many rows a file has says which positions
are in it, so a page of a report opens only the files that hold it, and the place of every row is known without any rank
over the rows. The table of files has at most ``MOST_FILES`` rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from annoloom.sources import generations, tables

ROWS_PER_FILE = 250_000
ROWS_PER_TASK = 250_000   # tasks write several files where files are smaller
MOST_FILES = 50_000
FILES = "file string, rows long, before long"


def write_ordered(spark: SparkSession, path: str, df: DataFrame, keys: Sequence[Column],
                  rows_per_file: int = ROWS_PER_FILE) -> generations.Manifest:
    """Store ``df`` at ``path`` in the order of ``keys``, which must tell rows apart, as a new generation."""
    tasks, per_file = tables.file_plan(df.count(), rows_per_file, ROWS_PER_TASK, MOST_FILES)

    def write(_: generations.Manifest | None):
        folder, table = generations.new_folder("rows"), generations.new_folder("files")
        (df.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).write.option("maxRecordsPerFile", per_file)
         .parquet(f"{path}/{folder}"))
        stored = spark.read.schema(df.schema).parquet(f"{path}/{folder}")
        # names are part-<task>-<job>-c<file of the task>; as numbers, since c1000 comes after c101
        place = [F.regexp_extract("file", pattern, 1).cast("long") for pattern in (r"^part-(\d+)-", r"-c(\d+)\.")]
        earlier = W.orderBy(*place, "file").rowsBetween(W.unboundedPreceding, -1)       # a table of bounded size
        (stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
         .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).write.parquet(f"{path}/{table}"))
        return {"rows": [folder], "files": [table]}, {"schema": df.schema.json()}

    return generations.update(spark, path, write)


def read_ordered(spark: SparkSession, path: str, first: int = 1, last: int | None = None) -> DataFrame:
    """The rows from position ``first`` to ``last``, both included, with ``position``; other files are not opened."""
    state = generations.latest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = StructType.fromJson(json.loads(state.facts["schema"]))
    files = generations.read_part(spark, state, "files", FILES).filter(F.col("before") + F.col("rows") >= first)
    if last is not None:
        files = files.filter(F.col("before") < last)
    names = [r["file"] for r in files.select("file").collect()]                 # at most MOST_FILES
    if not names:
        return generations.no_rows(spark, schema.add("position", "long"))
    folder = state.folders("rows")[0]
    rows = spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in names]).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    placed = (rows.join(F.broadcast(files.select(F.col("file").alias("_file"), "before")), "_file")
              .withColumn("position", F.col("before") + F.col("_index") + 1).drop("_file", "_index", "before"))
    inside = F.col("position") >= first
    return placed.filter(inside if last is None else inside & (F.col("position") <= last))


def read_page(spark: SparkSession, path: str, number: int, size: int = 20) -> DataFrame:
    """Page ``number``, counted from 1, of ``size`` rows."""
    return read_ordered(spark, path, (number - 1) * size + 1, number * size)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of the stored table, from its table of files."""
    state = generations.latest(spark, path)
    return generations.read_part(spark, state, "files", FILES).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
