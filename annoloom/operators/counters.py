"""Stored counters of progress, kept up to date by signed deltas of what has changed.

Counters are one narrow table (scope, a, b, c, n). ``record`` rows count records by benchmark, type and status; ``answer``
rows count the answers that progress looks at by user, kind (score, skip or unrated label) and score. A change is given as
the slice of records and responses that it concerns, before and after; its deltas are the counters of the slice after it
less those before it. Merging adds deltas to the stored counters, so a report after a change costs the change and
not the whole of the responses, and equals a full recount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom.functions import scores as SC
from annoloom.functions import text as TX
from annoloom.operators.facts import done_responses, resolve_annotators
from annoloom.operators.progress import progress_of_counts

KEYS = ["scope", "a", "b", "c"]


def counters(records: DataFrame, responses: DataFrame) -> DataFrame:
    """The counters of whole tables or of a slice: records with all their responses."""
    label = F.nullif(TX.strip("quality_score"), F.lit(""))
    score = SC.score_digit("quality_score")
    kind = (F.when(F.col("status") == "discarded", "skip").when(label.isNull(), F.lit(None))
            .when(score.isNull(), "unrated").otherwise("score"))
    answers = (done_responses(records, responses)
               .select(F.lit("answer").alias("scope"), F.col("user_id").alias("a"), kind.alias("b"),
                       F.when(kind == "score", score.cast("string")).alias("c"))
               .filter(F.col("b").isNotNull()))
    states = records.select(F.lit("record").alias("scope"), F.col("benchmark").alias("a"), F.col("record_type").alias("b"),
                            F.col("status").alias("c"))
    return states.unionByName(answers).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))


def slice_of(records: DataFrame, responses: DataFrame, touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records whose id is in ``touched`` (record_id), and their responses."""
    ids = touched.select("record_id").distinct()
    return records.join(ids, "record_id", "left_semi"), responses.join(ids, "record_id", "left_semi")


def deltas(before: tuple[DataFrame, DataFrame], after: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Signed changes of the counters between two states (records, responses) of one slice."""
    gone = counters(*before).withColumn("n", -F.col("n"))
    return merge(gone, counters(*after))


def merge(stored: DataFrame, change: DataFrame) -> DataFrame:
    """Counters with signed changes added; those that fall to nothing go."""
    return stored.unionByName(change).groupBy(*KEYS).agg(F.sum("n").alias("n")).filter(F.col("n") != 0)


def benchmark_progress(stored: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """:func:`progress.benchmark_progress` from counters."""
    rows = stored.filter(F.col("scope") == "record").select(
        F.col("a").alias("benchmark"), F.col("b").alias("record_type"), F.col("c").alias("status"), "n")
    return progress_of_counts(rows, benchmarks)


def annotator_progress(stored: DataFrame, users: DataFrame) -> DataFrame:
    """:func:`progress.annotator_progress` from counters."""
    n, kind = F.col("n"), F.col("b")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    columns = {"total": total(kind.isin("score", "skip")),
               **{f"s{i}": total((kind == "score") & (F.col("c") == str(i))) for i in range(1, 6)},
               "skipped": total(kind == "skip"), "unrated": total(kind == "unrated"),
               "submitted": total(kind.isin("score", "unrated"))}
    by_id = (stored.filter(F.col("scope") == "answer").groupBy(F.col("a").alias("user_id"))
             .agg(*[c.alias(name) for name, c in columns.items()]))
    return (resolve_annotators(by_id, users).groupBy("annotator").agg(*[F.sum(c).alias(c) for c in columns])
            .orderBy(F.desc("submitted"), "annotator"))

