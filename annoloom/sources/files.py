"""Validated ingest of pair files: JSON lines and CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annoloom import schema as S
from annoloom.functions import text as TX

INVALID = "invalid JSON"
MISSING = "missing required fields"

_STRICT = {"allowSingleQuotes": "false"}


def _single_json_value(line: Column) -> Column:
    """True when the line is exactly one JSON value.

    Spark's JSON expressions stop reading at the end of the first value, so text after
    it goes unnoticed. Read as the only element of an array *and* as a member followed by
    another one, a line passes both only if nothing follows its first value.
    """
    alone = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>", _STRICT)
    member = F.from_json(F.concat(F.lit('{"v":'), line, F.lit(',"end":1}')),
                         "struct<end:int>", _STRICT)
    return F.coalesce((F.size(alone) == 1) & (member["end"] == 1), F.lit(False))


def check_lines(lines: DataFrame) -> DataFrame:
    """Add ``reason`` to non-blank lines of column ``value``; null means accepted.

    A required key must be there; its value may be null.
    """
    body = lines.withColumn("value", TX.strip("value")).filter(F.col("value") != "")
    keys = F.json_object_keys("value")
    has_all = F.lit(True)
    for key in S.PAIR_FILE_KEYS:
        has_all = has_all & F.coalesce(F.array_contains(keys, key), F.lit(False))
    return body.withColumn(
        "reason", F.when(~_single_json_value(F.col("value")), INVALID).when(~has_all, MISSING))


def parse_pairs(lines: DataFrame) -> DataFrame:
    """Fields of accepted lines; ``raw`` keeps the whole object with its extra keys."""
    key_id, key_source, key_target = S.PAIR_FILE_KEYS
    ddl = ", ".join(f"{k} string" for k in S.PAIR_FILE_KEYS)
    rest = [c for c in lines.columns if c not in ("value", "reason")]
    parsed = lines.withColumn("p", F.from_json("value", ddl))
    return parsed.select(*rest, F.col(f"p.{key_id}").alias("id"),
                         F.col(f"p.{key_source}").alias("source_text"),
                         F.col(f"p.{key_target}").alias("target_text"),
                         F.col("value").alias("raw"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file, the split they were read in and a row id."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"))


def number_lines(some: DataFrame, every: DataFrame) -> DataFrame:
    """Replace split and row id of ``some`` lines by their line number in the file.

    Row ids are consecutive within a split, and a table with one row per split of
    ``every`` line tells how many lines come before it. So only the lines that are to be
    numbered are joined; the others are merely counted where they are read.
    """
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = (every.groupBy("file", "split")
              .agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
              .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .select("file", "split", "first", "offset"))
    number = F.col("offset") + F.col("row") - F.col("first") + 1
    return (some.join(splits, ["file", "split"]).withColumn("line_no", number)
            .drop("split", "row", "first", "offset"))


def ingest_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected lines with file, line number and reason)."""
    lines = read_lines(spark, path)
    checked = check_lines(lines)
    good = parse_pairs(checked.filter(F.col("reason").isNull()).drop("split", "row"))
    rejects = number_lines(checked.filter(F.col("reason").isNotNull()), lines)
    return good, rejects.select("file", "line_no", "reason", "value")


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field of a CSV file goes on in another line: some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def ingest_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Rows of a CSV file with a header that has the required columns.

    A short row is kept with nulls; extra columns are kept. Large files are split by lines over many tasks, unless
    a quoted field holds a line break: that is looked for first, and then each file is one task.
    ``multi_line`` says so without the look.
    """
    if multi_line is None:
        multi_line = has_broken_lines(spark, path)
    df = (spark.read.option("header", True).option("multiLine", multi_line)
          .option("enforceSchema", False)       # a file with other columns is an error, not shifted fields
          .option("quote", '"').option("escape", '"').csv(path))
    absent = [k for k in S.PAIR_FILE_KEYS if k not in df.columns]
    if absent:
        raise ValueError(f"{MISSING}: {', '.join(absent)}")
    key_id, key_source, key_target = S.PAIR_FILE_KEYS
    extra = [c for c in df.columns if c not in S.PAIR_FILE_KEYS]
    return df.select(F.col(key_id).alias("id"), F.col(key_source).alias("source_text"),
                     F.col(key_target).alias("target_text"), *extra)


def pair_records(pairs: DataFrame, source_tag: str = "manual") -> DataFrame:
    """Ingested pairs as records to upsert."""
    return pairs.select(
        F.col("id").alias("record_id"), F.col("id").alias("task_id"),
        F.lit(source_tag).alias("source_dataset"),
        TX.text_or_empty("source_text").alias("source_text"),
        TX.text_or_empty("target_text").alias("target_text"),
        F.lit("pending").alias("status"))
