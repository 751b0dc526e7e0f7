"""Annotation facts: responses joined to their records and annotators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annoloom import schema as S
from annoloom.functions import scores as SC
from annoloom.functions import text as TX
from annoloom.functions.values import category_list
from annoloom.operators.heavy import side_join
from annoloom.sources import tables

SHORT_ID = 8      # characters of a user id shown for an unknown user


def one_per_user(users: DataFrame) -> DataFrame:
    """(user_id, username), once per id: the last row by ``seq`` if there is one, else the
    largest name. A repeated id must not repeat its responses."""
    name = F.max_by("username", "seq") if "seq" in users.columns else F.max("username")
    return users.groupBy("user_id").agg(name.alias("username"))


def resolve_annotators(responses: DataFrame, users: DataFrame,
                       short: bool = True) -> DataFrame:
    """Add ``annotator``: the user's name, else the id (its first 8 characters if short).

    A response without a user id is ``unknown`` in the long form. The user table is measured: a small one is
    broadcast, so responses are not shuffled by user; else the responses of busy users are dealt over cells.
    """
    names = one_per_user(users)
    fallback = F.col("user_id")
    fallback = (F.substring(fallback, 1, SHORT_ID) if short
                else F.coalesce(F.nullif(fallback, F.lit("")), F.lit("unknown")))
    named = side_join(responses, names, ["user_id"], "left", source=users.select("user_id", "username"))
    return (named
            .withColumn("annotator", F.coalesce("username", fallback))
            .drop("username"))


def latest_response(responses: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Last write wins per key.

    ``row_number <= 1`` lets Spark keep one row per key in every map task before the
    shuffle, so a key with very many rewrites does not move them all.
    """
    w = W.partitionBy(*keys).orderBy(F.col(order).desc())
    return (responses.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= 1).drop("_rn"))


def done_responses(records: DataFrame, responses: DataFrame) -> DataFrame:
    """Submitted and discarded responses on records that are no longer pending."""
    done = (records.filter(F.col("status").isin(*S.DONE_STATUSES))
            .select("record_id"))
    return (responses.filter(F.col("status").isin("submitted", "discarded"))
            .join(done, "record_id", "left_semi"))


def annotation_facts(records: DataFrame, responses: DataFrame, users: DataFrame,
                     texts: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per submitted or discarded response on a completed or discarded record, with the columns ``keep`` of it.

    Everything that depends on one side only is worked out before the join. With
    ``texts=False`` the rows carry no texts: whether a correction repeats the machine
    translation is then told by a digest of each, so a roll-up shuffles a few bytes per
    response however long the texts are.
    """
    named = resolve_annotators(_answers(responses, texts), users)
    joined = named.join(_done_records(records, texts, keep), "record_id")
    repeats = (F.col("_stripped") == TX.strip("target_text") if texts
               else F.col("_digest") == F.col("_target_digest"))
    flagged = F.col("_suspect") & (F.col("_excused") | F.coalesce(repeats, F.lit(False)))
    names = ["response_id", "record_id", "annotator", "benchmark", "record_type", "task_id",
             "status", "score", "score_text", "score_label", "quality_score"]
    if texts:
        names += ["source_text", "target_text", "correction", "comment"]
    return joined.select(*names, "categories", "date", flagged.alias("flagged"), *keep)


def _answers(responses: DataFrame, texts: bool) -> DataFrame:
    """Response side of the facts; ``_suspect`` rows are low scores that may be flagged,
    ``_excused`` of them already contradict themselves without a look at the record."""
    submitted = F.col("status") == "submitted"

    def if_submitted(value: Column, otherwise: Column) -> Column:
        return F.when(submitted, value).otherwise(otherwise)

    label = F.coalesce(F.nullif("quality_score", F.lit("")), F.lit("?"))
    correction = if_submitted(TX.text_or_empty("corrected_text"), F.lit(""))
    given = responses.filter(F.col("status").isin("submitted", "discarded")).select(
        "response_id", "record_id", "user_id", "status", "quality_score",
        if_submitted(SC.score_digit("quality_score"), F.lit(None)).alias("score"),
        if_submitted(SC.score_text("quality_score"), F.lit("-")).alias("score_text"),
        if_submitted(TX.strip(label), F.lit("Discarded")).alias("score_label"),
        if_submitted(category_list("error_categories"),
                     F.array().cast("array<string>")).alias("categories"),
        F.coalesce(F.date_format("updated_at", "yyyy-MM-dd HH:mm"), F.lit("")).alias("date"),
        correction.alias("correction"),
        if_submitted(TX.text_or_empty("comment"), F.lit("")).alias("comment"))
    stripped = TX.strip("correction")
    suspect = F.coalesce(F.col("score") <= SC.LOW_SCORE, F.lit(False))
    excused = SC.is_marker(stripped) | F.array_contains("categories", S.NO_ERROR_LABEL)
    out = given.withColumns({"_suspect": suspect, "_excused": suspect & excused})
    open_case = F.col("_suspect") & ~F.col("_excused")
    if texts:
        return out.withColumn("_stripped", F.when(open_case, stripped))
    return (out.withColumn("_digest", F.when(open_case, F.md5(stripped)))
            .drop("correction", "comment"))


def _done_records(records: DataFrame, texts: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    target = TX.text_or_empty("target_text")
    content = ([TX.text_or_empty("source_text").alias("source_text"),
                target.alias("target_text")] if texts
               else [F.md5(TX.strip(target)).alias("_target_digest")])
    return (records.filter(F.col("status").isin(*S.DONE_STATUSES))
            .select("record_id",
                    F.coalesce("benchmark", F.lit("Unknown")).alias("benchmark"),
                    F.coalesce("record_type", F.lit("unknown")).alias("record_type"),
                    TX.text_or_empty("task_id").alias("task_id"), *content, *keep))


def newest_keys() -> list[Column]:
    """Newest minute first; ties in a fixed order."""
    return [F.desc("date"), F.col("record_id"), F.col("annotator"), F.col("response_id")]


def sort_keys(column: str, descending: bool = False) -> list[Column]:
    """Any column; scores sort as numbers with non-scores and 0 as 99."""
    key = (F.coalesce(F.nullif("score", F.lit(0)), F.lit(99)) if column == "score"
           else F.coalesce(F.col(column).cast("string"), F.lit("")))
    return [key.desc() if descending else key.asc(), F.col("record_id"), F.col("annotator"), F.col("response_id")]


def newest_first(facts: DataFrame) -> DataFrame:
    return facts.orderBy(*newest_keys())


def sort_annotations(facts: DataFrame, column: str, descending: bool = False) -> DataFrame:
    return facts.orderBy(*sort_keys(column, descending))


def positioned(facts: DataFrame, *keys: Column) -> DataFrame:
    """Add ``position`` 1..n in the order of ``keys``, without bringing the rows together.

    Rows are range-partitioned and sorted; a row's position is its place in its partition plus the
    rows of the partitions before, which are counted. Sort narrow facts and join texts by id. The
    sorted rows are a table in the shared folder, so that both passes see the same partitions.
    """
    spark = facts.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (facts.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
              .withColumn("_id", F.monotonically_increasing_id()))
    placed = tables.stage(placed.withColumn("_part", F.shiftright("_id", 33)), "positions")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    return (placed.join(offsets, "_part")
            .withColumn("position", (F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("long"))
            .drop("_part", "_id", "_first", "_before"))


def search_annotations(facts: DataFrame, annotator: str | None = None,
                       benchmark: str | None = None, record_type: str | None = None,
                       score: str | None = None, flagged_only: bool = False,
                       query: str | None = None) -> DataFrame:
    """AND of the given predicates; ``query`` is a case-insensitive substring of any of
    the text columns or of the categories joined by blanks."""
    exact = {"annotator": annotator, "benchmark": benchmark,
             "record_type": record_type, "score_text": score}
    out = facts
    for name, value in exact.items():
        if value:
            out = out.filter(F.col(name) == value)
    if flagged_only:
        out = out.filter("flagged")
    needle = (query or "").lower().strip()
    if needle:
        texts = [F.col(c) for c in ("source_text", "target_text", "correction", "comment",
                                    "annotator", "benchmark")]
        texts.append(F.array_join("categories", " "))
        hit = F.lit(False)
        for t in texts:
            hit = hit | F.lower(t).contains(needle)
        out = out.filter(hit)
    return out


def filter_choices(facts: DataFrame) -> DataFrame:
    """Distinct annotators and benchmarks, one pass over the facts."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value"))
                      for c in ("annotator", "benchmark")])
    return facts.select(F.explode(pairs).alias("p")).select("p.*").distinct()
