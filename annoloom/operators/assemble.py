"""Pair assembly: relevance, capped positives, source and target texts by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annoloom.functions import text as TX
from annoloom.operators.facts import positioned
from annoloom.operators.heavy import spread_join
from annoloom.sources.texts import KEYS, corpus_lookup, latest_texts

MAX_POSITIVES = 10

# Keys are listed with the most distinct one first: Spark's sorts compare an eight-byte
# prefix of the first key before anything else, and a benchmark name alone decides little.


# ---- relevance ----

def flatten_relevance(lists: DataFrame) -> DataFrame:
    """List form to (query, corpus) rows; the last row of a query wins.

    Columns in: benchmark, query_id, positive_ids, seq. ``seq`` out is the list position.
    """
    w = W.partitionBy("query_id", "benchmark").orderBy(F.col("seq").desc())
    last = lists.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 1)
    return last.select("benchmark", "query_id",
                       F.posexplode("positive_ids").alias("pos", "corpus_id")) \
        .select("benchmark", "query_id", F.col("corpus_id").cast("string"),
                F.col("pos").cast("long").alias("seq"))


def cap_positives(relevance: DataFrame, max_positives: int = MAX_POSITIVES) -> DataFrame:
    """First ``max_positives`` list positions per query, repeats included.

    The rank filter keeps at most that many rows per query in each map task before the
    shuffle, so a query with very many positives moves only its head.
    """
    w = W.partitionBy("query_id", "benchmark").orderBy("seq")
    return (relevance.withColumn("position", F.row_number().over(w))
            .filter(F.col("position") <= max_positives))


def relevance_lists(relevance: DataFrame) -> DataFrame:
    """Flat form to one row per query with all its positives in order, repeats included."""
    items = F.sort_array(F.collect_list(F.struct("seq", "corpus_id")))
    return (relevance.groupBy("benchmark", "query_id")
            .agg(F.transform(items, lambda x: x["corpus_id"]).alias("positive_ids")))


CHUNK = 10_000            # ids of one row of chunked lists


def relevance_chunks(relevance: DataFrame, size: int = CHUNK) -> DataFrame:
    """Whole lists in rows of at most ``size`` ids: (benchmark, query_id, chunk, first, corpus_ids).

    ``chunk`` counts from 0, ``first`` is the place of the chunk's first id in its list, from 1. Ranks come from the
    positions in one global order less the smallest of the query, so a query with very many positives is neither
    one row nor one task.
    """
    order = ("benchmark", "query_id", "seq", "corpus_id")
    placed = positioned(relevance.select(*order), *[F.col(c) for c in order])
    query = ["benchmark", "query_id"]
    starts = placed.groupBy(*query).agg(F.min("position").alias("_start"))
    ranked = spread_join(placed, starts, query, deal_by=["position"]).withColumn("_rank", F.col("position") - F.col("_start"))
    items = F.array_sort(F.collect_list(F.struct("_rank", "corpus_id")))
    return (ranked.groupBy(*query, F.floor(F.col("_rank") / size).alias("chunk")).agg(items.alias("_items"))
            .select(*query, "chunk", (F.col("chunk") * size + 1).alias("first"),
                    F.transform("_items", lambda x: x["corpus_id"]).alias("corpus_ids")))


def relevance_of_chunks(chunks: DataFrame) -> DataFrame:
    """Chunked lists back to rows (benchmark, query_id, corpus_id, seq) with the place in the list as ``seq``."""
    return (chunks.select("benchmark", "query_id", "first", F.posexplode("corpus_ids").alias("at", "corpus_id"))
            .select("benchmark", "query_id", "corpus_id", (F.col("first") + F.col("at")).cast("long").alias("seq")))


def capped_lists(relevance: DataFrame, max_positives: int = MAX_POSITIVES) -> DataFrame:
    """Flat form to one row per query with its first positives in order.

    Only capped rows are collected, so no list is longer than ``max_positives``.
    """
    items = F.sort_array(F.collect_list(F.struct("position", "corpus_id")))
    return (cap_positives(relevance, max_positives)
            .groupBy("benchmark", "query_id")
            .agg(F.transform(items, lambda x: x["corpus_id"]).alias("positive_ids")))


def cap_lists(lists: DataFrame, max_positives: int = MAX_POSITIVES) -> DataFrame:
    return lists.withColumn("positive_ids", F.slice("positive_ids", 1, max_positives))


def needed_passages(relevance: DataFrame,
                    max_positives: int = MAX_POSITIVES) -> DataFrame:
    """Distinct passage ids within the cap of any query, per benchmark."""
    return (cap_positives(relevance, max_positives)
            .select("benchmark", F.col("corpus_id").alias("id")).distinct())


def relevance_stats(relevance: DataFrame) -> DataFrame:
    """Positive pairs and queries per benchmark; pairs are summed per query first."""
    per_query = relevance.groupBy("benchmark", "query_id").agg(
        F.count(F.lit(1)).alias("n"))
    return per_query.groupBy("benchmark").agg(
        F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("queries"))


# ---- pairs ----

def candidates(needed: DataFrame, targets: DataFrame, sources: DataFrame) -> DataFrame:
    """Every target query and every needed passage with its formatted source text and its
    target text, empty when absent.

    ``needed`` is :func:`needed_passages`. It is narrow and meets both corpora, so stage
    it as a table first (``sources.tables.stage``): Spark then knows its true size and,
    when that is small enough, prunes the corpus scans by broadcast before any text is
    shuffled. All benchmarks go through the same joins; the benchmark is part of the key.
    """
    in_queries, in_corpus = F.col("config") == "queries", F.col("config") == "corpus"
    ids = needed.select("id", "benchmark", F.lit("corpus").alias("config"))
    target_text = F.col("text").alias("target_text")
    source_text = TX.format_source("title", "text").alias("source_text")

    queries = latest_texts(targets.filter(in_queries)).select(*KEYS, target_text)
    query_sources = corpus_lookup(sources.filter(in_queries), targets.filter(in_queries))
    passages = ids.join(corpus_lookup(targets.filter(in_corpus), ids)
                        .select(*KEYS, target_text), KEYS, "left")
    passage_sources = corpus_lookup(sources.filter(in_corpus), ids)

    both = (queries.join(query_sources.select(*KEYS, source_text), KEYS, "left")
            .unionByName(passages.join(passage_sources.select(*KEYS, source_text),
                                       KEYS, "left")))
    record_type = F.when(in_queries, "query").otherwise("passage")
    return both.select("benchmark", record_type.alias("record_type"), "id",
                       TX.text_or_empty("source_text").alias("source_text"),
                       TX.text_or_empty("target_text").alias("target_text"))


def _complete() -> Column:
    return (F.col("source_text") != "") & (F.col("target_text") != "")


def assemble_pairs(needed: DataFrame, targets: DataFrame, sources: DataFrame) -> DataFrame:
    """Records for all candidates whose source and target text are both there.

    The target text is also the suggested correction.
    """
    return candidates(needed, targets, sources).filter(_complete()).select(
        TX.record_key("benchmark", "record_type", "id").alias("record_id"),
        "benchmark", "record_type", TX.task_key("record_type", "id").alias("task_id"),
        "source_text", "target_text", F.col("target_text").alias("suggested_text"),
        F.lit("pending").alias("status"))


def pair_skips(needed: DataFrame, targets: DataFrame, sources: DataFrame) -> DataFrame:
    """Wanted, built and skipped records per benchmark and type."""
    return candidates(needed, targets, sources).groupBy("benchmark", "record_type").agg(
        F.count(F.lit(1)).alias("wanted"),
        F.count_if(_complete()).alias("built"),
        F.count_if(~_complete()).alias("skipped"))


def query_pairs(source: DataFrame, target: DataFrame) -> DataFrame:
    """Queries paired by id: source duplicates are kept, the last target of an id wins.

    Columns in: query_id, query and, for the target, seq.
    """
    w = W.partitionBy("query_id").orderBy(F.col("seq").desc())
    last = (target.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 1)
            .select("query_id", F.col("query").alias("translated")))
    return source.join(last, "query_id").select(
        F.concat(F.lit("query_"), F.col("query_id").cast("string")).alias("id"),
        F.col("query").alias("source_text"), F.col("translated").alias("target_text"))


def bundle_arrays(bundles: DataFrame) -> DataFrame:
    """Either passage layout to two plain arrays, ``passages`` and ``selected``."""
    kind = bundles.schema["passages"].dataType.typeName()
    if kind == "array":
        texts = F.transform("passages", lambda p: F.coalesce(p["passage_text"], F.lit("")))
        chosen = F.transform("passages", lambda p: F.coalesce(p["is_selected"], F.lit(0)))
    else:
        texts, chosen = F.col("passages.passage_text"), F.col("passages.is_selected")
    return bundles.withColumns({"texts": texts, "selected": chosen}).drop("passages")


def passage_pairs(source: DataFrame, target: DataFrame) -> DataFrame:
    """One passage per query: the first selected one, else the first.

    An index past the end of the target list falls back to the first passage.
    """
    w = W.partitionBy("query_id").orderBy(F.col("seq").desc())
    last = (bundle_arrays(target).withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= 1).select("query_id", F.col("texts").alias("t_texts")))
    src = bundle_arrays(source).select("query_id", F.col("texts").alias("s_texts"), "selected")
    joined = src.join(last, "query_id").filter((F.size("s_texts") > 0) & (F.size("t_texts") > 0))
    found = F.coalesce(F.array_position("selected", 1), F.lit(0)).cast("int")
    first = F.greatest(found - 1, F.lit(0))
    index = F.when(first < F.size("t_texts"), first).otherwise(0)
    picked = joined.withColumn("idx", index)

    def pick(texts: str) -> Column:
        return F.when(F.col("idx") < F.size(texts), F.get(texts, F.col("idx"))) \
            .otherwise(F.get(texts, F.lit(0)))

    pairs = picked.select(
        F.concat_ws("_", F.lit("passage"), F.col("query_id").cast("string"),
                    F.col("idx").cast("string")).alias("id"),
        pick("s_texts").alias("source_text"), pick("t_texts").alias("target_text"))
    return pairs.filter(~TX.is_blank("source_text") & ~TX.is_blank("target_text"))
