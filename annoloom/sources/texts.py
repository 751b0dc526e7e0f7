"""Text tables by (id, benchmark, config): reading, lookup by needed ids, coverage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from annoloom import schema as S
from annoloom.functions import text as TX
from annoloom.sources import generations
from annoloom.sources.files import number_lines, read_lines

KEYS = ["id", "benchmark", "config"]     # most distinct first, for sorts and joins
ROWS_PER_FILE = 200_000
#: Stated, not inferred: a benchmark named 007 is a name and not the number 7.
LOOKUP = "id string, title string, text string, benchmark string, config string"


TEXT_ROWS = "_id string, id string, title string, text string, seq long"
RELEVANCE_ROWS = ("`query-id` string, `corpus-id` string, `positive-corpus-ids` array<string>, "
                  "seq long")


def read_in_order(spark: SparkSession, path: str, fmt: str, ddl: str) -> DataFrame:
    """The columns of ``ddl`` that the files have, and ``seq``: the place of a row in its files.

    Later rows have larger numbers, within a file by row and between files by name; a ``seq``
    column of the files themselves goes before. JSON is parsed by the given schema, without a
    pass to infer one; a column of Parquet files keeps its type and is cast.
    """
    wanted = StructType.fromDDL(ddl)
    if fmt == "parquet":
        found = spark.read.parquet(path)
        rows = found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in found.columns
                              else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted],
                            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    else:
        lines = read_lines(spark, path)
        rows = (number_lines(lines.filter(~TX.is_blank("value")), lines)
                .select(F.from_json("value", ddl).alias("r"), "file", F.col("line_no").alias("place"))
                .select("r.*", "file", "place"))
    files = rows.select("file").distinct().withColumn("number", F.row_number().over(W.orderBy("file")))
    place = F.col("number").cast("long") * F.lit(1 << 40) + F.col("place")
    return rows.join(files, "file").withColumn("seq", F.coalesce("seq", place)).drop("file", "place", "number")


def read_texts(spark: SparkSession, paths: Mapping[tuple[str, str], str],
               fmt: str = "parquet") -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Union of the text tables at ``paths``, keyed by (benchmark, config).

    Ids come from ``_id`` or ``id``. Row order is kept in ``seq``. A path that cannot be read does
    not stop the others; its key is returned as failed.
    """
    parts, failed = [], []
    for (benchmark, config), path in paths.items():
        try:
            df = read_in_order(spark, path, fmt, TEXT_ROWS)
        except AnalysisException:
            failed.append((benchmark, config))
            continue
        parts.append(df.select(
            F.lit(benchmark).alias("benchmark"), F.lit(config).alias("config"),
            F.coalesce("_id", "id").alias("id"), "title", "text", "seq"))
    union = None
    for part in parts:
        union = part if union is None else union.unionByName(part)
    return union, failed


def read_relevance(spark: SparkSession, benchmark: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Relevance of one benchmark as (benchmark, query_id, corpus_id, seq), from either layout.

    A row is one pair (``query-id``, ``corpus-id``), or a query with its list
    (``positive-corpus-ids``), of which the last row of a query counts. Ids are strings; order is
    that of the rows or of the list.
    """
    rows = read_in_order(spark, path, fmt, RELEVANCE_ROWS).withColumnRenamed("query-id", "query_id")
    pairs = rows.filter(F.col("positive-corpus-ids").isNull()).select(
        "query_id", F.col("corpus-id").alias("corpus_id"), "seq")
    w = W.partitionBy("query_id").orderBy(F.desc("seq"))
    lists = (rows.filter(F.col("positive-corpus-ids").isNotNull())
             .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 1)
             .select("query_id", F.posexplode("positive-corpus-ids").alias("seq", "corpus_id"))
             .select("query_id", "corpus_id", F.col("seq").cast("long").alias("seq")))
    return pairs.unionByName(lists).select(F.lit(benchmark).alias("benchmark"), "query_id", "corpus_id", "seq")


def benchmark_table(spark: SparkSession,
                    names: tuple[str, ...] = S.BENCHMARKS) -> DataFrame:
    """The listed benchmarks in their order; progress tables show exactly these."""
    return spark.createDataFrame(list(zip(names, range(len(names)))),
                                 "benchmark string, position int")


def latest_texts(texts: DataFrame) -> DataFrame:
    """One row per (id, benchmark, config): the last one wins."""
    w = W.partitionBy(*KEYS).orderBy(F.col("seq").desc())
    return (texts.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= 1).drop("_rn"))


def corpus_lookup(corpus: DataFrame, needed: DataFrame) -> DataFrame:
    """Rows of ``corpus`` whose key is in ``needed``; only id, title and text are read.

    A semi-join on the scan: with a needed table that is small enough for a broadcast no
    other corpus row leaves the scan, otherwise both sides are shuffled by id once and
    the last-row window and later joins on the same keys reuse that partitioning.
    """
    kept = corpus.select(*KEYS, "title", "text", "seq").join(
        needed.select(*KEYS), KEYS, "left_semi")
    return latest_texts(kept).select(
        *KEYS, TX.text_or_empty("title").alias("title"), TX.text_or_empty("text").alias("text"))


def materialised_lookup(spark: SparkSession, path: str, corpus: DataFrame,
                        needed: DataFrame, refresh_missing: bool = False) -> DataFrame:
    """Lookup kept as Parquet at ``path``, partitioned by benchmark and config.

    The first call scans the corpus and commits what it found. Later calls only read that
    table; with ``refresh_missing`` the ids it lacks are fetched and added first. Only committed folders are
    read: what a killed or slower writer left does not count, and a first call after it scans again.
    """
    wanted = needed.select(*KEYS).distinct()

    def add(state: generations.Manifest | None):
        if state is not None and not refresh_missing:
            return None
        lacking = wanted if state is None else missing_ids(wanted, stored_lookup(spark, state))
        folder = generations.new_folder("lookup")
        found = by_key_range(corpus_lookup(corpus, lacking), lacking.count())
        found.write.partitionBy("benchmark", "config").parquet(f"{path}/{folder}")
        return {"lookup": [*(state.parts["lookup"] if state else ()), folder]}, {}

    state = generations.update(spark, path, add)
    return stored_lookup(spark, state).join(wanted, KEYS, "left_semi")


def stored_lookup(spark: SparkSession, state: generations.Manifest) -> DataFrame:
    """All rows of a committed lookup; each folder is a partitioned table of its own."""
    parts = [spark.read.schema(LOOKUP).parquet(folder) for folder in state.folders("lookup")]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.select(*KEYS, "title", "text")


def by_key_range(found: DataFrame, rows: int) -> DataFrame:
    """Rows in as many tasks as ``rows`` asks for, each with one range of keys, so that a partition gets files
    in proportion to its rows."""
    order = ("benchmark", "config", "id")
    return found.repartitionByRange(max(1, -(-rows // ROWS_PER_FILE)), *order).sortWithinPartitions(*order)


def _found(needed: DataFrame, lookup: DataFrame) -> DataFrame:
    """Needed keys that ``lookup`` has. The lookup is cut to the needed keys where it is
    read, so its other ids take no part in the distinct or in later joins."""
    return lookup.select(*KEYS).join(needed.select(*KEYS), KEYS, "left_semi").distinct()


def lookup_coverage(needed: DataFrame, lookup: DataFrame) -> DataFrame:
    """Needed, found and missing ids per benchmark and config."""
    found = _found(needed, lookup).withColumn("_hit", F.lit(1))
    return (needed.select(*KEYS).distinct().join(found, KEYS, "left")
            .groupBy("benchmark", "config").agg(
                F.count(F.lit(1)).alias("needed"), F.count("_hit").alias("found"),
                F.count_if(F.col("_hit").isNull()).alias("missing")))


def missing_ids(needed: DataFrame, lookup: DataFrame) -> DataFrame:
    """Needed ids without a source text."""
    return needed.select(*KEYS).distinct().join(_found(needed, lookup), KEYS, "left_anti")
