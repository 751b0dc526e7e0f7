"""Annotation-shaped views over the test tables.

Every view covers its whole input tables with whole texts. ``oracle.py`` states the same
views as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from annoloom import schema as S
from annoloom.functions import text as TX

FLAGS = ("A", "N", "R")          # the benchmarks of the retrieval views


_SCHEMAS: dict[str, StructType] = {}      # read from each table's files once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# ---- annotation tables ----

def _doc_target() -> Column:
    """A "translation" of the whole text; very short documents have none."""
    return F.when(F.col("n_chars") < 120, "").otherwise(
        F.concat(F.lit("[sr] "), "text"))


def _record_id(doc: Column) -> Column:
    return F.concat(F.lit("rec_"), doc.cast("string"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per document; benchmark is its source, status follows its language."""
    kind = F.when(F.col("n_chars") < 800, "query").otherwise("passage")
    status = (F.when(F.col("lang") == "de", "pending")
              .when(F.col("lang") == "es", "discarded").otherwise("completed"))
    return table(spark, sf_dir, "documents").select(
        _record_id(F.col("doc_id")).alias("record_id"),
        F.col("source").alias("benchmark"), kind.alias("record_type"),
        TX.task_key(kind, F.col("doc_id").cast("string")).alias("task_id"),
        F.col("text").alias("source_text"), _doc_target().alias("target_text"),
        status.alias("status"))


def benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of the documents and one benchmark without any record."""
    names = table(spark, sf_dir, "documents").select(F.col("source").alias("benchmark")) \
        .distinct()
    empty = spark.range(1).select(F.lit("src999").alias("benchmark"))
    return names.unionByName(empty).withColumn(
        "position", F.regexp_extract("benchmark", "([0-9]+)", 1).cast("int"))


def _answers(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    status = (F.when(F.col("event_type") == "error", "discarded")
              .when(F.col("event_type") == "view", "draft").otherwise("submitted"))
    labels = F.array(F.lit(None).cast("string"), *[F.lit(c) for c in S.SCORE_LABELS],
                     F.lit("n/a"))
    score = F.get(labels, k % 7)
    names = F.array(*[F.lit(c) for c in S.ERROR_CATEGORIES])
    categories = F.when(k % 10 == 9, F.array(F.lit(S.NO_ERROR_LABEL))).otherwise(
        F.array(F.get(names, k % 9), F.get(names, (k + 4) % 9)))
    return events.select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("response_id"),
        F.col("event_id").alias("seq"), "event_id", "event_type", k.alias("k"),
        F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("updated_at"),
        status.alias("status"), score.alias("quality_score"),
        categories.alias("error_categories"),
        F.when(F.col("event_type") == "purchase", "checked").alias("comment"))


def responses(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """One response per event; ten consecutive events answer one document.

    Events meet their document by the record id, so that what follows by record needs no second shuffle of the texts.
    """
    base = _answers(table(spark, sf_dir, "events")).withColumn("record_id", _record_id(F.expr("event_id div 10")))
    if not with_text:
        return base.drop("event_id", "event_type", "k")
    targets = table(spark, sf_dir, "documents").select(_record_id(F.col("doc_id")).alias("record_id"), _doc_target().alias("target"))
    corrected = (F.when(F.col("k") % 4 == 0, "No corrections")
                 .when(F.col("k") % 4 == 1, F.col("target"))
                 .when(F.col("k") % 4 == 2, "")
                 .otherwise(F.concat("target", F.lit(" "), "event_type")))
    return (base.join(targets, "record_id").withColumn("corrected_text", corrected)
            .drop("event_id", "event_type", "k", "target"))


def calibration_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty consecutive events answer one calibration record, so annotators overlap."""
    group = F.expr("event_id div 50").cast("string")
    return (_answers(table(spark, sf_dir, "events"))
            .withColumn("record_id", F.concat(F.lit("cal_"), group))
            .drop("event_id", "event_type", "k"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known users: those with a sizeable sign-up. The others keep their id as name."""
    known = (table(spark, sf_dir, "events")
             .filter((F.col("event_type") == "signup") & (F.col("value") >= 100))
             .select("user_id").distinct())
    return known.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("ann_"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
        .alias("username"),
        F.when(F.col("user_id") == 0, "owner").otherwise("annotator").alias("role"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workspace members: users with a large purchase."""
    return (table(spark, sf_dir, "events")
            .filter((F.col("event_type") == "purchase") & (F.col("value") >= 100))
            .select(F.col("user_id").cast("string").alias("user_id")).distinct())


def turn_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One first-generation record per conversation turn; system turns have no task id."""
    turn = F.concat_ws("_", F.lit("turn"), F.col("conv_id").cast("string"),
                       F.col("turn").cast("string"))
    return table(spark, sf_dir, "conversations").select(
        turn.alias("record_id"), "conv_id", "turn", "role",
        F.when(F.col("role") != "system", F.concat(F.lit("task_"), turn)).alias("task_id"),
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("benchmark"),
        F.col("role").alias("record_type"), F.col("text").alias("source_text"),
        F.col("text").alias("target_text"), F.lit("completed").alias("status"))


def turn_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per turn: a marker, nothing, the same text, local edits, or the text
    of the next turn."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    following = t.select("conv_id", (F.col("turn") - 1).alias("turn"),
                         F.col("text").alias("next_text"))
    kind = (F.col("conv_id") + F.col("turn")) % 5
    corrected = (F.when(kind == 0, "Bez ispravki").when(kind == 1, "")
                 .when(kind == 2, F.col("text"))
                 .when(kind == 3, F.replace("text", F.lit("en"), F.lit("é")))
                 .otherwise(F.coalesce("next_text", "text")))
    turn = F.concat_ws("_", F.lit("turn"), F.col("conv_id").cast("string"),
                       F.col("turn").cast("string"))
    return t.join(following, ["conv_id", "turn"], "left").select(
        F.concat(F.lit("r_"), turn).alias("response_id"), turn.alias("record_id"),
        F.col("conv_id").cast("string").alias("user_id"), F.col("turn").alias("seq"),
        F.when(F.col("role") == "system", "draft").otherwise("submitted").alias("status"),
        F.when(F.col("turn") < 6, F.concat(F.lit(""), (F.col("turn") % 5 + 1).cast("string")))
        .alias("quality_score"), corrected.alias("corrected_text"))


# ---- retrieval tables ----

def _each_benchmark() -> Column:
    return F.explode(F.array(*[F.lit(f) for f in FLAGS])).alias("benchmark")


def target_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target queries are orders; the target corpus is parts and, never needed, customers.

    A handful of parts have an empty text.
    """
    orders, part, customer = (table(spark, sf_dir, n) for n in ("orders", "part", "customer"))
    queries = orders.select(
        _each_benchmark(), F.lit("queries").alias("config"),
        F.col("o_orderkey").cast("string").alias("id"), F.lit(None).cast("string").alias("title"),
        F.concat_ws(" ", F.lit("order"), "o_orderpriority").alias("text"),
        F.col("o_custkey").alias("seq"))
    parts = part.select(
        _each_benchmark(), F.lit("corpus").alias("config"),
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
        F.lit(None).cast("string").alias("title"),
        F.when(F.col("p_size") == 1, "").otherwise(F.col("p_name")).alias("text"),
        F.col("p_partkey").alias("seq"))
    people = customer.select(
        _each_benchmark(), F.lit("corpus").alias("config"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit(None).cast("string").alias("title"), F.col("c_name").alias("text"),
        F.col("c_custkey").alias("seq"))
    return queries.unionByName(parts).unionByName(people)


def source_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source texts; open orders and one brand are not in it, some titles and texts are
    blank, and each part has an older version that a later one replaces."""
    orders, part = (table(spark, sf_dir, n) for n in ("orders", "part"))
    queries = orders.filter(F.col("o_orderstatus") != "P").select(
        _each_benchmark(), F.lit("queries").alias("config"),
        F.col("o_orderkey").cast("string").alias("id"), F.lit(None).cast("string").alias("title"),
        F.concat(F.lit(" \n"), "o_orderstatus", F.lit("\t")).alias("text"),
        F.lit(0).cast("long").alias("seq"))
    published = part.filter(F.col("p_brand") != "Brand#13")

    def corpus(text: Column, seq: int) -> DataFrame:
        return published.select(
            _each_benchmark(), F.lit("corpus").alias("config"),
            F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
            F.when(F.col("p_size") < 13, "").otherwise(F.col("p_brand")).alias("title"),
            text.alias("text"), F.lit(seq).cast("long").alias("seq"))

    older = corpus(F.col("p_name"), 1)
    newer = corpus(F.when(F.col("p_retailprice") < 950, "").otherwise(F.col("p_type")), 2)
    return queries.unionByName(older).unionByName(newer)


def relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat relevance: the lines of an order in line order. ``seq`` is unique per order."""
    seq = (F.col("l_linenumber").cast("long") * F.lit(10 ** 18)
           + F.col("l_partkey") * F.lit(10 ** 8) + F.col("l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("benchmark"),
        F.col("l_orderkey").cast("string").alias("query_id"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("corpus_id"),
        seq.alias("seq"))


def needed_corpus(needed: DataFrame) -> DataFrame:
    return needed.select("benchmark", F.lit("corpus").alias("config"), "id")


def query_table(spark: SparkSession, sf_dir: str, target: bool) -> DataFrame:
    """Queries by customer id, so ids repeat; the latest order is the last target row."""
    text = F.concat_ws(" ", "o_orderpriority", F.col("o_orderdate").cast("date").cast("string")) \
        if target else F.concat_ws(" ", "o_orderstatus", F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("query_id"), text.alias("query"),
        F.col("o_orderkey").alias("seq"))


def bundles(spark: SparkSession, sf_dir: str, target: bool, as_list: bool = False) -> DataFrame:
    """One bundle per document: its lines. Long lines are selected; the target side drops
    blank lines, so its lists can be shorter."""
    lines = F.split("text", "\n")
    if target:
        lines = F.filter(F.transform(lines, lambda x: F.translate(x, "aeiou", "eioua")),
                         lambda x: F.length(x) > 40)
    chosen = lambda x: (F.length(x) > 300).cast("int")
    if as_list:
        passages = F.transform(lines, lambda x: F.struct(
            x.alias("passage_text"), chosen(x).alias("is_selected")))
    else:
        passages = F.struct(lines.alias("passage_text"),
                            F.transform(lines, chosen).alias("is_selected"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("query_id"), passages.alias("passages"),
        F.col("doc_id").alias("seq"))
