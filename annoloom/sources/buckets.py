"""Tables dealt into buckets by a hash of their key, of which an upsert rewrites only the buckets it touches.

Every bucket is a folder; a manifest lists the folder of each bucket. An upsert merges its rows into new folders for the
touched buckets and commits a manifest that takes the other buckets over as they are, so readers see all of it or nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from annoloom.operators import heavy
from annoloom.sources import generations, tables

ROWS_PER_BUCKET = 500_000
MOST_BUCKETS = 20_000     # entries of a manifest


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _thinned(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``rows`` with one row left, the last by ``order``, of each key that has more than a fair share of them.

    Rows meet once, by bucket; a key with very many versions is cut to its last in the map tasks before that.
    """
    hot = [r["_key"] for r in heavy.heavy_keys(rows, [key]).select("_key").collect()]      # at most MOST_HEAVY numbers
    if not hot:
        return rows
    is_hot = F.xxhash64(key).isin(hot)
    return rows.filter(~is_hot).unionByName(tables.last_rows(rows.filter(is_hot), order, key))


def _write(spark: SparkSession, path: str, old: DataFrame, new: DataFrame, key: str, order: str, buckets: int) -> dict[str, list[str]]:
    """Write, bucket by bucket into a new folder, the last row by ``order`` of each key of ``new`` and the rows of ``old``
    whose keys ``new`` lacks; the folder of each bucket that has rows. All rows are shuffled once."""
    folder = generations.new_folder("rows")
    both = (old.withColumn("_new", F.lit(False)).unionByName(
        _thinned(new, key, order).withColumns({"_new": F.lit(True), "_order": F.col(order)}), allowMissingColumns=True)
        .select(*old.columns, "_new", "_order").withColumn("_bucket", bucket_of(key, buckets)).repartition("_bucket"))
    newest = W.partitionBy("_bucket", key).orderBy(F.desc("_new"), F.desc("_order"))
    placed = both.withColumns({"_rn": F.row_number().over(newest), "_replaced": F.first("_new").over(newest)})
    kept = F.when(F.col("_new"), F.col("_rn") == 1).otherwise(~F.col("_replaced") | F.col(key).isNull())
    (placed.filter(kept).drop("_new", "_order", "_rn", "_replaced").sortWithinPartitions("_bucket", key)
     .write.partitionBy("_bucket").parquet(f"{path}/{folder}"))
    return {name.partition("=")[2]: [f"{folder}/{name}"] for name in generations.folders_in(spark, f"{path}/{folder}")
            if name.startswith("_bucket=")}


def create_bucketed(spark: SparkSession, path: str, rows: DataFrame, key: str, order: str,
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> generations.Manifest:
    """Store ``rows`` at ``path``, of each key the last by ``order``; an existing table is an error."""
    buckets = min(MOST_BUCKETS, max(1, -(-rows.count() // rows_per_bucket)))
    parts = _write(spark, path, generations.no_rows(spark, rows.schema), rows, key, order, buckets)
    return generations.commit(spark, path, None, parts, {"key": key, "buckets": buckets, "schema": rows.schema.json()})


def _schema(state: generations.Manifest) -> StructType:
    return StructType.fromJson(json.loads(state.facts["schema"]))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows."""
    state = generations.latest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    folders = state.folders()
    schema = _schema(state)
    return spark.read.schema(schema).parquet(*folders) if folders else generations.no_rows(spark, schema)


def upsert_bucketed(spark: SparkSession, path: str, new: DataFrame, order: str, keep_old: bool = False) -> generations.Manifest:
    """Add new keys and replace known ones; of a key that ``new`` has twice the last by ``order`` counts.

    Only the buckets of ``new`` are read and written. What they replace is deleted once the new state is committed,
    unless ``keep_old``, for readers that still use it.
    """
    def change(state: generations.Manifest | None):
        if state is None:
            raise FileNotFoundError(f"no table at {path}")
        key, buckets, schema = state.facts["key"], state.facts["buckets"], _schema(state)
        hit = [str(r[0]) for r in new.select(bucket_of(key, buckets)).distinct().collect()]     # at most MOST_BUCKETS
        if not hit:
            return None
        known = [f"{path}/{f}" for b in hit for f in state.parts.get(b, ())]
        old = spark.read.schema(schema).parquet(*known) if known else generations.no_rows(spark, schema)
        return {**state.parts, **_write(spark, path, old, new, key, order, buckets)}, state.facts

    state = generations.update(spark, path, change)
    if not keep_old:
        generations.drop_before(spark, state)
    return state
