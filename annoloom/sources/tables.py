"""Writing tables: modes, upsert, JSON lines, report bundle."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# How a table is created: name here -> Spark save mode.
WRITE_MODES = {
    "append": "append",           # create, or add to what is there
    "create": "errorifexists",    # fail when it exists
    "keep": "ignore",             # leave an existing table alone
    "recreate": "overwrite",      # drop and write
}


SMALL_TASKS = 500         # tasks with fewer rows than they could take

_SCOPE: ContextVar[str | None] = ContextVar("annoloom_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scope for staged tables: all that is staged inside it is deleted at its end.

    Results that read staged tables must be written or collected inside the scope. Outside of any
    scope, staged tables stay until the shared folder is cleaned.
    """
    path = shared_dir(spark, "scratch")
    token = _SCOPE.set(path)
    try:
        yield path
    finally:
        _SCOPE.reset(token)
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share (``spark.checkpoint.dir``).

    A machine-local folder is used only on a local master without that setting.
    """
    base = _SCOPE.get() or (spark.conf.get("spark.checkpoint.dir", None)
                            or spark.sparkContext.getCheckpointDir())
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="annoloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a narrow result that several steps use: it is computed once, survives the loss of
    an executor, and as a table it has a known size that join planning can go by. For long texts ``zstd`` takes less disk.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted now.

    Spark deletes them when the driver's JVM happens to collect the plans that they belong to; between the large steps of one
    job it is asked to, so that the disk holds those of one step and not of all.
    """
    spark._jvm.System.gc()


def file_plan(rows: int, rows_per_file: int, rows_per_task: int, most_files: int) -> tuple[int, int]:
    """(tasks, rows per file) to write ``rows``: at most ``most_files`` files; beyond ``SMALL_TASKS`` a task writes several.

    What a write sends to the driver and its fixed cost grow with the tasks, so small files are no reason for more of them.
    """
    wanted = min(-(-rows // rows_per_file), SMALL_TASKS)
    tasks = min(max(wanted, -(-rows // max(rows_per_file, rows_per_task)), 1), max(most_files // 2, 1))
    return tasks, max(rows_per_file, -(-rows // max(most_files - tasks, 1)))


def write_table(df: DataFrame, path: str, mode: str = "create",
                partition_by: tuple[str, ...] = ()) -> None:
    """Write Parquet; ``recreate`` replaces the whole table, never only partitions of it."""
    writer = df.write.mode(WRITE_MODES[mode])
    if mode == "recreate":
        writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def last_rows(rows: DataFrame, order: str, key: str = "record_id") -> DataFrame:
    """One row per key, the last by ``order``; earlier ones are dropped in the map tasks already."""
    w = W.partitionBy(key).orderBy(F.col(order).desc())
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 1).drop("_rn")


def upsert(existing: DataFrame, new: DataFrame, order: str, key: str = "record_id") -> DataFrame:
    """New ids added, same ids replaced, others untouched.

    Within ``new`` the last row of an id by the column ``order`` wins, so an id is never there
    twice. Write the result to a new path: a table must not be overwritten while it is read.
    """
    new = last_rows(new, order, key)
    untouched = existing.join(new.select(key), key, "left_anti")
    return untouched.unionByName(new, allowMissingColumns=True)


def only_benchmark(df: DataFrame, benchmark: str, benchmarks: DataFrame) -> DataFrame:
    """Rows of one benchmark; a name that is not listed is an error, not an empty result."""
    if benchmarks.filter(F.col("benchmark") == benchmark).isEmpty():
        raise ValueError(f"unknown benchmark {benchmark!r}")
    return df.filter(F.col("benchmark") == benchmark)


def as_named(schema: StructType, partition: str = "benchmark") -> StructType:
    """The schema with a partition column that is read as text, however its values look."""
    return StructType([StructField(f.name, StringType()) if f.name == partition else f for f in schema])


def upsert_benchmark(spark: SparkSession, path: str, new: DataFrame, benchmark: str,
                     benchmarks: DataFrame, order: str) -> None:
    """Rerun one benchmark of a table partitioned by ``benchmark``.

    Only that partition is read. The merged partition is written next to the table first, then put in its place and
    deleted there, so a job that fails while merging leaves the table as it was. Readers may see the partition
    change under them: ``buckets.upsert_bucketed`` commits an upsert at once.
    """
    schema = as_named(spark.read.parquet(path).schema)
    existing = only_benchmark(spark.read.schema(schema).parquet(path), benchmark, benchmarks)
    merged = upsert(existing, new.filter(F.col("benchmark") == benchmark), order) \
        .select(*existing.columns)
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    merged.write.partitionBy("benchmark").parquet(staged)
    (spark.read.schema(as_named(merged.schema)).parquet(staged).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("benchmark").parquet(path))
    _delete(spark, staged)


def write_jsonl(df: DataFrame, path: str, drop: tuple[str, ...] = (), compression: str = "none") -> None:
    """JSON lines with nulls kept and non-ASCII text verbatim."""
    df.drop(*drop).write.option("ignoreNullFields", "false").option("compression", compression).json(path)


def write_bundle(tables: Mapping[str, DataFrame], path: str) -> None:
    """Several tables of one report as compressed JSON under one directory."""
    for name, df in tables.items():
        write_jsonl(df, f"{path.rstrip('/')}/{name}", compression="gzip")
        release(df.sparkSession)
