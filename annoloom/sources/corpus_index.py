"""A corpus stored in the order of its ids, of which a lookup opens only the files that can hold a needed id.

The rows are range-partitioned and sorted by id, and a task writes several files; each file holds one range and has Parquet bloom filters on its ids. A
table of these ranges (file, first id, last id, rows) is stored beside them, at most ``MOST_FILES`` rows however
large the corpus is. Needed ids are mapped to files by binary search over the ranges' first ids, in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annoloom.sources import generations, tables, texts

ROWS_PER_FILE = 500_000
ROWS_PER_TASK = 500_000   # tasks write several files where files are smaller
MOST_FILES = 50_000       # rows of the range table, and file names that a lookup brings to the driver
PUSHED_IDS = 1000         # needed ids that are also handed to the scan, for statistics and bloom filters
RANGES = "file string, first_id string, last_id string, rows long"


def build_index(spark: SparkSession, path: str, corpus: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> generations.Manifest:
    """Store ``corpus`` at ``path``, the last row of an id first made the only one, and commit it with its ranges."""
    latest = texts.latest_texts(corpus.select(*texts.KEYS, "title", "text", "seq")).drop("seq")
    rows = corpus.count()
    tasks, per_file = tables.file_plan(rows, rows_per_file, ROWS_PER_TASK, MOST_FILES)

    def write(state: generations.Manifest | None):
        folder, ranges = generations.new_folder("rows"), generations.new_folder("ranges")
        (latest.repartitionByRange(tasks, "id").sortWithinPartitions("id", "benchmark", "config").write
         .option("parquet.bloom.filter.enabled#id", "true").option("parquet.enable.dictionary#id", "false")
         .option("parquet.bloom.filter.expected.ndv#id", str(min(per_file, max(rows, 1))))
         .option("maxRecordsPerFile", per_file).parquet(f"{path}/{folder}"))
        stored = spark.read.schema(texts.LOOKUP).parquet(f"{path}/{folder}")
        (stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("rows"))
         .coalesce(1).write.parquet(f"{path}/{ranges}"))            # at most MOST_FILES rows
        return {"rows": [folder], "ranges": [ranges]}, {}

    return generations.update(spark, path, write)


def _last_at_most(sorted_values: Column, value: Column, steps: int) -> Column:
    """The 1-based place of the last of ``sorted_values`` that is at most ``value``, 0 if there is none."""
    def halve(state: Column, _: Column) -> Column:
        middle = ((state["low"] + state["high"] + 1) / 2).cast("int")
        right = F.element_at(sorted_values, F.greatest(middle, F.lit(1))) <= value
        done = state["low"] == state["high"]
        return F.struct(F.when(done | ~right, state["low"]).otherwise(middle).alias("low"),
                        F.when(done | right, state["high"]).otherwise(middle - 1).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.size(sorted_values).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["low"]


def files_of(spark: SparkSession, state: generations.Manifest, needed: DataFrame) -> list[str]:
    """Files that can hold one of the needed ids.

    A range partition has all rows of an id, and its files follow one another: an id is in the last range that starts at or
    before it and, where it is that range's first id, maybe in the ranges before that end with it.
    """
    ranges = generations.read_part(spark, state, "ranges", RANGES)
    numbered = ranges.withColumn("number", F.row_number().over(W.orderBy("first_id", "last_id")))      # a table of bounded size
    firsts = numbered.agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "first_id"))), lambda r: r["first_id"])).scalar()
    place = _last_at_most(F.col("firsts"), F.col("id"), MOST_FILES.bit_length() + 1)
    least = (needed.select("id").distinct().withColumn("firsts", firsts).select(place.alias("number"), "id")
             .groupBy("number").agg(F.min("id").alias("least")))
    found = numbered.join(least, "number").filter(F.col("least") <= F.col("last_id"))
    ends = found.filter(F.col("least") == F.col("first_id")).select(F.col("first_id").alias("last_id"))
    both = found.select("file").unionByName(ranges.join(ends, "last_id", "left_semi").select("file"))
    return sorted({r["file"] for r in both.collect()})        # at most MOST_FILES names, twice


def indexed_lookup(spark: SparkSession, path: str, needed: DataFrame) -> DataFrame:
    """Rows of the stored corpus whose key is in ``needed``, from the files that can hold one.

    The same rows as :func:`texts.corpus_lookup` on the corpus itself. Few needed ids are handed to the scan as well.
    """
    state = generations.latest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no index at {path}")
    folder = state.folders("rows")[0]
    files = files_of(spark, state, needed)
    if not files:
        return generations.no_rows(spark, texts.LOOKUP).select(*texts.KEYS, "title", "text")
    rows = spark.read.schema(texts.LOOKUP).parquet(*[f"{folder}/{f}" for f in files])
    ids = [r["id"] for r in needed.select("id").distinct().limit(PUSHED_IDS + 1).collect()]
    if len(ids) <= PUSHED_IDS:
        rows = rows.filter(F.col("id").isin(ids))
    found = rows.join(needed.select(*texts.KEYS), texts.KEYS, "left_semi")
    return found.select(*texts.KEYS, *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "text")])
