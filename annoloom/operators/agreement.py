"""Agreement between annotators who rated the same records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annoloom.functions import agreement as AG
from annoloom.functions import scores as SC
from annoloom.functions.values import category_list
from annoloom.operators.facts import latest_response, positioned, resolve_annotators
from annoloom.operators.heavy import side_join, spread_join
from annoloom.sources import tables

RATERS_PER_CELL = 256     # raters of one record that meet all its others in one task
ASKED_PER_BLOCK = 256     # annotators asked about that meet all others of a block in one task
OTHERS_PER_BLOCK = 4096
FEW_LABELS = 32           # so many labels are bits of one number


def label_set(categories: str) -> Column:
    """The distinct labels chosen, in order; nulls inside a list do not count."""
    return F.array_sort(F.array_distinct(F.array_compact(category_list(categories))))


def ratings(responses: DataFrame, users: DataFrame) -> DataFrame:
    """Last submitted rating per record and annotator, whatever the record's status.

    The rows are narrowed to a score and the set of chosen labels before they are shuffled.
    """
    narrow = (responses.filter(F.col("status") == "submitted")
              .select("record_id", "user_id", "seq",
                      SC.score_digit("quality_score").alias("score"),
                      label_set("error_categories").alias("labels")))
    return latest_response(resolve_annotators(narrow, users), ["record_id", "annotator"]) \
        .select("record_id", "annotator", "score", "labels")


def shared_records(rated: DataFrame) -> DataFrame:
    """Records with at least two annotators and how many they have."""
    return (rated.groupBy("record_id").agg(F.count(F.lit(1)).alias("raters"))
            .filter(F.col("raters") >= 2))


def co_rated(rated: DataFrame) -> DataFrame:
    """Ratings on records with at least two annotators; those of a record with very many are dealt over cells."""
    return spread_join(rated, shared_records(rated), ["record_id"], deal_by=["annotator"])


def rating_pairs(rated: DataFrame, raters_per_cell: int = RATERS_PER_CELL) -> DataFrame:
    """Both ratings of every two annotators (a before b) on every record they share.

    The result has one row per pair and record by definition, so it must be aggregated
    straight away: the rows stream from the join into the partial sums and are never
    written. A record with many raters is split by its measured size: its left side
    is dealt over several cells and its right side repeated in each, which bounds the
    pairs any task makes for one record by ``raters_per_cell`` times its raters. Records
    up to that size keep a single cell and are not repeated.
    """
    # Adaptive execution merges partitions by their input bytes, but this join multiplies
    # its input; an explicit count keeps the pairs spread over that many tasks.
    tasks = int(rated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = F.ceil(F.col("raters") / raters_per_cell).cast("int")
    sized = co_rated(rated).withColumn("cells", cells).drop("raters")
    left = sized.select(
        "record_id", F.pmod(F.xxhash64("annotator"), F.col("cells")).cast("int").alias("cell"),
        F.col("annotator").alias("annotator_a"), F.col("score").alias("score_a"),
        F.col("labels").alias("labels_a")).repartition(tasks, "record_id", "cell")
    right = sized.select(
        F.col("record_id"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"),
        F.col("annotator").alias("annotator_b"), F.col("score").alias("score_b"),
        F.col("labels").alias("labels_b"))
    return (left.join(right, ["record_id", "cell"])
            .filter(F.col("annotator_a") < F.col("annotator_b")))


def pairwise_agreement(rated: DataFrame, k: int = 5) -> DataFrame:
    """Kappa, exact agreement and mean difference per pair with scored shared records."""
    scored = rating_pairs(rated).filter(
        F.col("score_a").isNotNull() & F.col("score_b").isNotNull())
    sums = scored.groupBy("annotator_a", "annotator_b").agg(
        *AG.kappa_sums("score_a", "score_b", k),
        F.count_if(F.col("score_a") == F.col("score_b")).alias("same"),
        F.sum(F.abs(F.col("score_a") - F.col("score_b"))).alias("apart"))
    return (sums.withColumn("kappa", AG.weighted_kappa(k))
            .select("annotator_a", "annotator_b", F.col("k_n").alias("shared"),
                    "kappa", AG.kappa_status(k).alias("kappa_status"),
                    AG.kappa_band("kappa").alias("band"),
                    (F.col("same") * 100.0 / F.col("k_n")).alias("exact_pct"),
                    (F.col("apart") / F.col("k_n")).alias("mean_diff")))


def asked_pairs(asked: DataFrame, annotators: DataFrame, asked_per_block: int = ASKED_PER_BLOCK,
                others_per_block: int = OTHERS_PER_BLOCK, but: DataFrame | None = None) -> DataFrame:
    """Every annotator of ``asked`` with every other, a before b, once, without the pairs of ``but`` (one, other).

    Two that are both asked about are listed by the first of them; see :func:`_pairs_between`.
    """
    placed, apart = _placed(asked, annotators), None
    if but is not None:
        a, b = (placed.select(F.col("annotator").alias(n), F.col("position").alias(p)) for n, p in (("one", "a"), ("other", "b")))
        apart = but.join(a, "one").join(b, "other").select("a", "b")
    return _pairs_between(placed, apart, asked_per_block, others_per_block)


def _placed(asked: DataFrame, annotators: DataFrame) -> DataFrame:
    """(annotator, kind, position): those asked about that are no annotators (0), annotators asked about (1), the others (2).

    Positions are 1..n in the order of kind and name, so the others of one asked about are the annotators with a greater
    position, and each pair has one place.
    """
    asked, annotators = (rows.select("annotator").filter("annotator is not null").distinct() for rows in (asked, annotators))
    kind = F.when(F.col("listed").isNull(), 0).when(F.col("asked"), 1).otherwise(2)
    both = (annotators.withColumn("listed", F.lit(True)).join(asked.withColumn("asked", F.lit(True)), "annotator", "full")
            .select("annotator", kind.alias("kind")))
    return tables.stage(positioned(both, F.col("kind"), F.col("annotator")), "placed")


def _pairs_between(placed: DataFrame, apart: DataFrame | None, asked_per_block: int = ASKED_PER_BLOCK,
                   others_per_block: int = OTHERS_PER_BLOCK) -> DataFrame:
    """Pairs of those asked about among ``placed`` with the annotators after them, without the positions ``apart`` (a, b).

    Positions are cut into blocks of others, and those asked about into blocks of rows. Of a block, one asked about is
    left with the gaps between the positions that ``apart`` has for it there. A gap is a few numbers and all that is
    shuffled; a cell of two blocks has the names as two lists, and a gap becomes a slice of one. So a pair appears only
    when it is final: pairs are neither shuffled nor compared with one another.
    """
    tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strangers, ones, last = placed.agg(F.count_if(F.col("kind") == 0), F.count_if(F.col("kind") <= 1), F.count(F.lit(1))).first()
    rows, columns = (max(1, -(-n // size)) for n, size in ((ones, asked_per_block), (last - strangers, others_per_block)))
    row = F.expr(f"(a - 1) div {asked_per_block}").alias("row")
    column = F.expr(f"(b - {strangers + 1}) div {others_per_block}").alias("column")
    before = F.col("column") * others_per_block + strangers         # the position before a block of others
    end = F.least(before + others_per_block, F.lit(last)) + 1       # and the one after it

    first = F.least(F.expr(f"(greatest(a, {strangers}) - {strangers}) div {others_per_block}"), F.lit(columns - 1))
    cuts = (placed.filter(F.col("kind") <= 1).select(F.col("position").alias("a"))
            .select("a", row, F.explode(F.sequence(first, F.lit(columns - 1).cast("long"))).alias("column"))
            .select("a", "row", "column", end.alias("b")))
    if apart is not None:
        cuts = cuts.unionByName(apart.filter((F.col("a") <= ones) & (F.col("a") < F.col("b")) & (F.col("b") > strangers))
                                .select("a", row, column, "b"))
    begin = F.coalesce(F.lag("b").over(W.partitionBy("row", "column", "a").orderBy("b")), F.greatest("a", F.lit(strangers), before))
    # an explicit count keeps adaptive execution from merging tasks, whose rows multiply
    gaps = (cuts.repartition(tasks, "row", "column").withColumn("begin", begin)
            .select("row", "column", (F.col("a") - F.col("row") * asked_per_block).cast("int").alias("at"),
                    (F.col("begin") - before + 1).cast("int").alias("start"), (F.col("b") - F.col("begin") - 1).cast("int").alias("n"))
            .filter(F.col("n") > 0))

    def names(some: DataFrame, block: Column, name: str) -> DataFrame:
        listed = F.array_sort(F.collect_list(F.struct("position", "annotator")))
        return some.groupBy(block).agg(F.transform(listed, lambda x: x["annotator"]).alias(name))

    others = names(placed.filter(F.col("kind") >= 1).withColumn("b", F.col("position")), column, "others")
    used = F.least(F.floor((end - 2) / asked_per_block), F.lit(rows - 1))      # nobody in a later row is before the block's end
    cells = (others.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), used.cast("long"))))
             .join(names(placed.filter(F.col("kind") <= 1).withColumn("a", F.col("position")), row, "ones"), "row"))
    return (gaps.join(cells, ["row", "column"])
            .select(F.element_at("ones", F.col("at")).alias("one"), F.slice("others", F.col("start"), F.col("n")).alias("rest"))
            .select("one", F.explode("rest").alias("other"))
            .select(F.least("one", "other").alias("annotator_a"), F.greatest("one", "other").alias("annotator_b")))


def _scored_pairs(rated: DataFrame) -> DataFrame:
    """Distinct annotator pairs with a record that both have scored."""
    return (rating_pairs(rated)
            .filter(F.col("score_a").isNotNull() & F.col("score_b").isNotNull())
            .select("annotator_a", "annotator_b").distinct())


def overlap_counts(rated: DataFrame) -> DataFrame:
    """For each annotator, how many others share a scored record with them and how many do not.

    One row per annotator: the pairs without overlap are counted, not listed.
    """
    annotators = co_rated(rated).select("annotator").distinct()
    both = F.array("annotator_a", "annotator_b")
    peers = (_scored_pairs(rated).select(F.explode(both).alias("annotator"))
             .groupBy("annotator").agg(F.count(F.lit(1)).alias("n")))
    others = annotators.agg(F.count(F.lit(1)) - 1).scalar()
    n = F.coalesce("n", F.lit(0))
    return (annotators.join(peers, "annotator", "left").withColumn("others", others)
            .select("annotator", n.alias("with_overlap"), (F.col("others") - n).alias("without_overlap")))


def pairs_without_overlap(rated: DataFrame, asked: DataFrame) -> DataFrame:
    """Annotator pairs with no record that both have scored, for the annotators ``asked`` about.

    Of all annotators there are quadratically many such pairs; :func:`overlap_counts` has their
    numbers. Here each one asked about is listed with the others, a before b.
    """
    annotators = co_rated(rated).select("annotator").distinct()
    wanted = annotators.join(asked.select("annotator").distinct(), "annotator", "left_semi")
    placed = _placed(wanted, annotators)
    # positions stand for names, in an order in which the first of two is the one that lists the pair
    scored = side_join(rated.filter(F.col("score").isNotNull()).select("record_id", "annotator", "score"),
                       placed.select("annotator", "position"), ["annotator"], deal_by=["record_id"])
    scored = tables.stage(scored.select("record_id", F.col("position").alias("annotator"), "score",
                                        F.lit(None).cast("array<string>").alias("labels")), "scored")
    return _pairs_between(placed, _scored_pairs(scored).toDF("a", "b"))


def calibration_distribution(rated: DataFrame) -> DataFrame:
    """Scores per annotator on records with at least two annotators."""
    return (co_rated(rated).filter(F.col("score").isNotNull()).groupBy("annotator").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("score") == i).alias(f"s{i}") for i in range(1, 6)],
        F.avg("score").alias("avg_score")).orderBy("annotator"))


def category_agreement(rated: DataFrame) -> DataFrame:
    """Share of the shared records on which a pair agrees about each label seen.

    Agreeing means both chose the label or neither did. The labels are those of the co-rated
    records. Every pair and record gives one row and one more for each label that only one of
    the two chose; these are counted in one aggregation, map-side first. A pair is then repeated once for each label
    number and joined to the numbered labels; labels on which it never differs are the ones its counts lack. No row
    carries the list of all labels. Up to ``FEW_LABELS`` labels are counted as bits instead, see :func:`_few_labels`.
    """
    seen = co_rated(rated).select(F.explode("labels").alias("category")).distinct()
    few = [r["category"] for r in seen.limit(FEW_LABELS + 1).collect()]
    if 0 < len(few) <= FEW_LABELS and None not in few:
        return _few_labels(rated, sorted(few))
    differ = F.concat(F.array_except("labels_a", "labels_b"), F.array_except("labels_b", "labels_a"))
    counts = (rating_pairs(rated)
              .select("annotator_a", "annotator_b",
                      F.explode(F.array_append(differ, F.lit(None).cast("string"))).alias("label"))
              .groupBy("annotator_a", "annotator_b", "label").agg(F.count(F.lit(1)).alias("n")))
    of_label = F.struct("label", "n")
    per_pair = counts.groupBy("annotator_a", "annotator_b").agg(
        F.max(F.when(F.col("label").isNull(), F.col("n"))).alias("shared"),
        F.map_from_entries(F.collect_list(F.when(F.col("label").isNotNull(), of_label))).alias("apart"))
    numbered = positioned(seen, F.col("category"))
    last = numbered.agg(F.coalesce(F.max("position"), F.lit(0))).first()[0]
    if not last:
        numbers = F.array().cast("array<bigint>")
    else:
        numbers = F.sequence(F.lit(1).cast("long"), F.lit(last))
    agreed = F.col("shared") - F.coalesce(F.try_element_at("apart", F.col("category")), F.lit(0))
    return (per_pair.select("annotator_a", "annotator_b", "shared", "apart", F.explode(numbers).alias("position"))
            .join(numbered, "position")
            .select("annotator_a", "annotator_b", "category", "shared", agreed.alias("agreed"),
                    (agreed * 100.0 / F.col("shared")).alias("agreement_pct")))


def _few_labels(rated: DataFrame, names: Sequence[str]) -> DataFrame:
    """:func:`category_agreement` where ``names`` are all labels: a rating's labels are the bits of one number.

    The bits in which two ratings differ are summed per label in one aggregation by pair, map-side first; a pair and record is one
    narrow row, a pair is shuffled as one row of counts, and each label becomes a row only in the result.
    """
    bits = sum((F.when(F.array_contains("labels", n), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, n in enumerate(names)),
               F.lit(0).cast("long"))
    coded = rated.withColumn("labels", F.when(F.col("labels").isNotNull(), bits))
    pairs = rating_pairs(coded).select("annotator_a", "annotator_b", F.col("labels_a").bitwiseXOR(F.col("labels_b")).alias("differ"))
    sums = pairs.filter(F.col("differ").isNotNull()).groupBy("annotator_a", "annotator_b").agg(
        F.count(F.lit(1)).alias("shared"),
        *[F.sum(F.shiftright("differ", i).bitwiseAND(F.lit(1).cast("long"))).alias(f"d{i}") for i in range(len(names))])
    of_label = F.array(*[F.struct(F.lit(n).alias("category"), (F.col("shared") - F.col(f"d{i}")).alias("agreed"))
                         for i, n in enumerate(names)])
    return (sums.select("annotator_a", "annotator_b", "shared", F.explode(of_label).alias("l"))
            .select("annotator_a", "annotator_b", "l.category", "shared", "l.agreed",
                    (F.col("l.agreed") * 100.0 / F.col("shared")).alias("agreement_pct")))


def kappa_by(ratings_df: DataFrame, a: str, b: str, keys: Sequence[str] = (),
             k: int = 5) -> DataFrame:
    """Kappa between any two rating columns for any grouping; null ratings do not count."""
    both = ratings_df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    sums = both.groupBy(*keys).agg(*AG.kappa_sums(a, b, k))
    return (sums.withColumn("kappa", AG.weighted_kappa(k))
            .select(*keys, F.col("k_n").alias("n"), "kappa",
                    AG.kappa_status(k).alias("kappa_status"),
                    AG.kappa_band("kappa").alias("band")))
