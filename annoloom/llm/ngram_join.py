"""N-gram Jaccard self-join by vertical partitioning, and the components of its links.

1. Blocks (``blocks``): in how many documents each shingle of a document occurs, as a power of two. A link needs an
   overlap of at least the threshold times a document's own set, so a document with fewer shared shingles
   links with nothing. The others go on; documents with equal sets become one class.
2. Shingles have a global order: by that power of two, rare ones first, then by hash. Of each set only the first
   ``n - ceil(t * n) + 1`` shingles can be the first common one of a link (prefix filter); shingles of one document
   take places there but lead nowhere. The blocks write each set's leading shingles and, cut into ``FRAGMENTS``, its
   shared ones: the order is cut at powers of two, and each part into ranges of the hash.
3. In a first round each leading shingle pairs its classes with one leader, the one with the largest
   shared part, and the overlaps are counted. In a second, classes that are still in different
   components are paired, unless sizes, shared counts or the partial overlaps with the leader
   (a common shingle is inside its set or outside) already rule a link out. Both rounds together test every pair that could
   join two components, and never all pairs within a group.
4. Pairs are verified by vertical partitions: the partial overlap of a pair is counted in each fragment of the global
   order on its own and summed per pair. Only sets of classes in a pair are moved.

Links inside one component that would not change it are not counted by ``ngram_join``; its components are
those of all links at the threshold. ``ngram_links`` verifies and returns every link between classes.

Odd input: a null or empty text, or one without words, has an empty set and is linked with nothing; a
text with fewer words than a shingle is one shingle of its own length. Repeated rows are equal
documents. Classes have numbers of their own, in the order of their smallest ids, so rows with a null
id and different texts with one id take part like any other; a row's component is the smallest id that it
reaches. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annoloom.llm.blocks import DOCS_PER_BLOCK, Grams, gathered_levels, hashed_blocks, shared_levels
from annoloom.operators.heavy import spread_join
from annoloom.sources import tables

N = 5
PERCENT = 75
#: How the global order is cut: (first level, ranges of the hash) of each group of levels, rare shingles first.
CUTS = ((1, 2), (2, 2), (4, 4), (7, 8))
FRAGMENTS = sum(ranges for _, ranges in CUTS)
CLASSES_PER_CELL = 256    # classes of one shingle that meet all its others in one task
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))      # A-Z to a-z

_SETS = ("row long, doc_id long, text_key binary, n_shingles long, n_shared long, set_key binary, lead array<long>, "
         "parts array<array<long>>")


def fragment_of(level: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The fragment that a shared shingle is in: its group of levels, and its range of the hash in there."""
    group = np.searchsorted(np.array([first for first, _ in CUTS]), level, side="right") - 1
    ranges = np.array([n for _, n in CUTS])
    bits = np.log2(ranges).astype(np.uint64)[group]
    return (np.cumsum(ranges) - ranges)[group] + (h >> (np.uint64(64) - bits)).astype(np.int64)


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def shingle_sets(docs: DataFrame, n: int, percent: int, docs_per_block: int, id_col: str,
                 text_col: str, text_key: Column | None = None) -> DataFrame:
    """One row per document; its leading and its shared shingles only where enough of it is shared for a link,
    and once for each set of a block."""
    key = F.lit(None) if text_key is None else text_key
    blocked, text_bytes = hashed_blocks(docs, id_col, text_col, docs_per_block, key.cast("binary").alias("text_key"))

    def sets_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
        """The distinct shingles of each document (hash, document), by document and hash."""
        found = Grams(((t or "").encode().translate(LOWER) for t in texts), n, True)
        order = np.argsort(found.doc, kind="stable")        # those of very short texts come last
        h, d = found.hashes[order], found.doc[order]
        edges = np.searchsorted(d, np.arange(len(texts) + 1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            h[a:b].sort()                                   # a document at a time, in place
        own = np.ones(len(h), dtype=bool)
        own[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        return h[own], d[own]

    def distinct(ids: list, texts: list) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(sets_of(texts)[0], return_counts=True)

    def finish(key: tuple, ours: pa.Table, answers: pa.Table) -> pa.Table:
        h, d = sets_of(ours.column("text").to_pylist())
        size = ours.num_rows
        level = gathered_levels(answers)[np.unique(h, return_inverse=True)[1]] if len(h) else np.zeros(0, dtype=np.uint8)
        edges = np.searchsorted(d, np.arange(size + 1))
        n_set = np.diff(edges)
        n_shared = np.bincount(d[level > 0], minlength=size)
        alive = (n_set > 0) & (100 * n_shared >= percent * n_set)
        keys, seen, writes = [None] * size, set(), np.zeros(size, dtype=bool)
        for i in np.flatnonzero(alive):
            keys[i] = hashlib.sha1(h[edges[i]:edges[i + 1]].tobytes()).digest()
            writes[i] = keys[i] not in seen
            seen.add(keys[i])
        used = (level > 0) & writes[d]
        h, d, level = h[used], d[used], level[used]
        fragment = fragment_of(level, h)
        order = np.argsort(d * 64 + level, kind="stable")   # each set in the global order; hashes are in order already
        lead_of, leading = d[order], h[order].view(np.int64)
        slot = d * FRAGMENTS + fragment
        order = np.argsort(slot, kind="stable")
        h, d, slot = h[order].view(np.int64), d[order], slot[order]
        begins = np.searchsorted(d, np.arange(size + 1))
        prefix = n_shared - least_overlap(n_set, percent) + 1
        first = np.arange(len(d)) - begins[lead_of] < prefix[lead_of]
        leading, lead_of = leading[first], lead_of[first]
        ends = np.searchsorted(slot, np.arange(size * FRAGMENTS + 1))
        inner = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h))
        parts = pa.ListArray.from_arrays(_offsets(np.arange(size + 1) * FRAGMENTS, writes), inner)
        lead = pa.ListArray.from_arrays(_offsets(np.searchsorted(lead_of, np.arange(size + 1)), writes), pa.array(leading))
        rows = (np.int64(key[0].as_py()) << np.int64(32)) + np.arange(size)
        return pa.table([pa.array(rows), ours.column("doc_id"), ours.column("text_key"), pa.array(n_set, pa.int64()),
                         pa.array(n_shared, pa.int64()), pa.array(keys, pa.binary()), lead, parts],
                        names=["row", "doc_id", "text_key", "n_shingles", "n_shared", "set_key", "lead", "parts"])

    answers = shared_levels(blocked, distinct, text_bytes)
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda key, ours, theirs: finish(key, ours, theirs), _SETS)


def _offsets(at: np.ndarray, there: np.ndarray) -> pa.Array:
    """List offsets with nulls where there is no list."""
    return pa.array(at, pa.int32(), mask=np.append(~there, False))


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, o, parts): set sizes and overlap of the pairs (a, b), in all and by fragment.

    Of ``sets`` (rep, n, parts) only those in a pair are moved, a fragment's array at a time; of a fragment that
    one of the two has nothing in there is no row to compare.
    """
    both = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    cut = (sets.join(both, "rep", "left_semi").select("rep", "n", F.posexplode("parts").alias("fragment", "part"))
           .filter(F.size("part") > 0))
    left = cut.select(F.col("rep").alias("a"), F.col("n").alias("na"), "fragment", F.col("part").alias("pa"))
    right = cut.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "fragment", F.col("part").alias("pb"))
    partial = F.size(F.array_intersect("pa", "pb"))
    return (pairs.join(left, "a").join(right, ["b", "fragment"])
            .select("a", "b", "na", "nb", "fragment", partial.alias("common"))
            .groupBy("a", "b", "na", "nb")
            .agg(F.sum("common").alias("o"), *[F.sum(F.when(F.col("fragment") == f, F.col("common")).otherwise(0)).cast("int")
                                              .alias(f"o{f}") for f in range(FRAGMENTS)])
            .select("a", "b", "na", "nb", "o", F.array(*[f"o{f}" for f in range(FRAGMENTS)]).alias("parts")))


def linked(counted: DataFrame, percent: int) -> DataFrame:
    """The pairs whose Jaccard similarity reaches the threshold."""
    return counted.filter((100 + percent) * F.col("o") >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, label): the smallest node reachable by links, for nodes that have a link.

    Labels spread along links, and each round also follows the label's own label, so that long
    chains shorten by half. Every round is a table in the shared folder.
    """
    edges = tables.stage(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = tables.stage(edges.groupBy(F.col("a").alias("rep")).agg(
        F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["rep"]).groupBy(F.col("a").alias("rep")) \
            .agg(F.min("label").alias("near"))
        jump = labels.select(F.col("rep").alias("label"), F.col("label").alias("far"))
        after = tables.stage(
            labels.join(near, "rep", "left").join(jump, "label", "left")
            .select("rep", "label", F.least("label", "near", "far").alias("now")), "labels")
        changed = not after.filter(F.col("now") != F.col("label")).isEmpty()
        labels = after.select("rep", F.col("now").alias("label"))
        if not changed:
            return labels


def possible(n_a: Column, s_a: Column, n_b: Column, s_b: Column, percent: int) -> Column:
    """Overlap cannot exceed either shared count, nor the smaller set."""
    most = F.least(s_a, s_b, n_a, n_b)
    return (100 + percent) * most >= percent * (n_a + n_b)


def remaining_pairs(here: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes with a common leading shingle in different components that may have a link.

    ``here`` has the entries of shingles whose classes are in several components; classes outside a shingle's largest
    component meet all others. A pair needs to be found only at its first common shingle, where it shares no more than what either set
    has from that place on; so a frequent shingle far back in two sets pairs them no more. The classes of a frequent
    shingle are dealt over cells by their number, so the pairs that a task tests for one shingle are bounded by a cell times its classes.
    """
    tasks = int(here.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = F.ceil(F.col("size") / CLASSES_PER_CELL).cast("int")
    rest = (F.col("s") - F.col("place")).alias("rest")
    # no partner is smaller than the smallest class of the shingle; an explicit count keeps adaptive execution from merging tasks
    small = (here.filter((F.col("label") != F.col("big"))
                         & ((100 + percent) * rest >= percent * (F.col("n") + F.col("least"))))
             .select("h", F.pmod(F.hash("rep"), cells).alias("cell"), "rep", "n", rest, "parts", "inner", "label", "big")
             .repartition(tasks, "h", "cell"))
    other = here.select("h", F.explode(F.sequence(F.lit(0), cells - 1)).alias("cell"), F.col("rep").alias("rep2"), F.col("n").alias("n2"),
                        rest.alias("rest2"), F.col("parts").alias("parts2"), F.col("inner").alias("inner2"), F.col("label").alias("label2"))
    # in each fragment, what two sets share is inside the leader's set, or outside and shared with some class
    around = sum((F.least(F.col("inner")[f], F.col("inner2")[f])
                  + F.least(F.col("parts")[f] - F.col("inner")[f], F.col("parts2")[f] - F.col("inner2")[f])
                  for f in range(FRAGMENTS)), F.lit(0))
    return (small.join(other, ["h", "cell"])
              .filter((F.col("label") != F.col("label2"))
                      & ((F.col("label2") == F.col("big")) | (F.col("rep") < F.col("rep2")))
                      & possible(F.col("n"), F.col("rest"), F.col("n2"), F.col("rest2"), percent)
                      & F.coalesce((100 + percent) * around >= percent * (F.col("n") + F.col("n2")), F.lit(True)))
              .select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")))


def class_components(sets: DataFrame, percent: int) -> DataFrame:
    """(rep, label) of the classes that some link joins; ``sets`` is a staged table of ``class_sets``."""
    sizes = F.transform("parts", lambda p: F.size(p))
    entries = tables.stage(sets.select("rep", "n", "s", F.posexplode("lead").alias("place", "h")), "prefixes")

    # of a shingle's classes the one with the largest shared part leads; a shingle of one class leads nowhere
    lead = tables.stage(entries.groupBy("h").agg(
        F.max(F.struct((F.col("s") / F.col("n")).alias("part"), (-F.col("rep")).alias("rep"), "n", "s"))
        .alias("l"), F.count(F.lit(1)).alias("m")).filter(F.col("m") > 1)
        .select("h", (-F.col("l.rep")).alias("lead"), F.col("l.n").alias("ln"), F.col("l.s").alias("ls")), "leaders")
    led = tables.stage(spread_join(entries, lead, ["h"], deal_by=["rep"]), "led")
    first = tables.stage(
        led.filter((F.col("rep") != F.col("lead")) & possible(F.col("n"), F.col("s"), F.col("ln"), F.col("ls"), percent))
        .select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct(), "pairs")
    counted = tables.stage(overlaps(first, sets), "overlaps")
    links = linked(counted, percent)
    labels = components(sets, links)

    # of a shingle's classes, those outside its largest component are paired with all others
    labelled = tables.stage(
        led.select("rep", "n", "s", "place", "h", "lead").join(labels, "rep", "left")
        .withColumn("label", F.coalesce("label", "rep")), "labelled")
    per_label = labelled.groupBy("h", "label").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
    mixed = tables.stage(
        per_label.groupBy("h").agg(F.max(F.struct("m", "label")).alias("big"), F.count(F.lit(1)).alias("labels"),
                                   F.min("least").alias("least"), F.sum("m").alias("size"))
        .filter(F.col("labels") > 1).select("h", F.col("big.label").alias("big"), "least", "size"), "mixed")
    if mixed.isEmpty():
        return labels
    # each entry there with its partial overlaps with the leader of its shingle, where they were counted
    with_leader = counted.select("a", "b", F.col("parts").alias("inner")) \
        .union(counted.select(F.col("b"), F.col("a"), "parts")).toDF("lead", "rep", "inner")
    inner = F.when(F.col("lead") == F.col("rep"), F.col("parts")).otherwise(F.col("inner"))
    here = tables.stage(
        spread_join(labelled, mixed, ["h"], deal_by=["rep"])
        .join(sets.select("rep", sizes.alias("parts")), "rep").join(with_leader, ["lead", "rep"], "left")
        .select("rep", "n", "s", "place", "parts", "h", inner.alias("inner"), "label", "big", "least", "size"), "mixed-entries")
    second = tables.stage(remaining_pairs(here, percent).distinct().join(counted, ["a", "b"], "left_anti"), "pairs")
    more = tables.stage(linked(overlaps(second, sets), percent), "links")
    if more.isEmpty():
        return labels
    return components(sets, links.union(more))


def numbered_classes(staged: DataFrame) -> DataFrame:
    """(set_key, least, copies, row, rep) of the classes that may have links.

    ``least`` is the smallest id, null where no row has one, and ``row`` a row that has the set. ``rep`` numbers the
    classes in the order of ``least``, nulls last, so the smallest number of a component is the class with its
    smallest id.
    """
    tasks = int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = (F.asc_nulls_last("least"), F.asc("set_key"))
    classes = (staged.filter(F.col("set_key").isNotNull())
               .groupBy("set_key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"),
                                       F.min(F.when(F.col("lead").isNotNull(), F.col("row"))).alias("row")))
    return tables.stage(classes.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
                        .withColumn("rep", F.monotonically_increasing_id()), "classes")


def class_sets(staged: DataFrame, classes: DataFrame) -> DataFrame:
    """(rep, n, s, lead, parts) of every class."""
    written = staged.filter(F.col("lead").isNotNull()).select(
        "row", F.col("n_shingles").alias("n"), F.col("n_shared").alias("s"), "lead", "parts")
    return tables.stage(written.join(classes.select("row", "rep"), "row").drop("row"), "sets")


def placed_classes(staged: DataFrame, percent: int) -> DataFrame:
    """(set_key, least, copies, component, component_id): the number and the smallest id of each class's component."""
    classes = numbered_classes(staged)
    labels = class_components(class_sets(staged, classes), percent)
    ids = classes.select(F.col("rep").alias("label"), F.col("least").alias("component_id"))
    return (classes.join(labels.join(ids, "label"), "rep", "left")
            .select("set_key", "least", "copies", F.coalesce("label", "rep").alias("component"),
                    F.coalesce("component_id", "least").alias("component_id")))


def ngram_links(docs: DataFrame, n: int = N, percent: int = PERCENT, docs_per_block: int = DOCS_PER_BLOCK,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every link between two classes: (set_key, other_key, class_id, other_id, copies, other_copies, overlap).

    Each pair of classes that a link joins is there once. All classes that share a leading shingle are compared, so time
    and result grow with the square of a group of different near copies; copies of one set are one class.
    """
    staged = tables.stage(shingle_sets(docs, n, percent, docs_per_block, id_col, text_col), "shingles")
    classes = numbered_classes(staged)
    sets = class_sets(staged, classes)
    entries = tables.stage(sets.select("rep", "n", F.explode("lead").alias("h")), "prefixes")
    other = entries.toDF("b", "n2", "h")
    pairs = tables.stage(
        entries.withColumnRenamed("rep", "a").join(other, "h")
        .filter((F.col("a") < F.col("b")) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")))
        .select("a", "b").distinct(), "pairs")
    found = overlaps(pairs, sets).filter((100 + percent) * F.col("o") >= percent * (F.col("na") + F.col("nb")))
    one = classes.select(F.col("rep").alias("a"), "set_key", F.col("least").alias("class_id"), "copies")
    two = one.toDF("b", "other_key", "other_id", "other_copies")
    return found.join(one, "a").join(two, "b").select(
        "set_key", "other_key", "class_id", "other_id", "copies", "other_copies", F.col("o").alias("overlap"))


def ngram_join(docs: DataFrame, n: int = N, percent: int = PERCENT, docs_per_block: int = DOCS_PER_BLOCK,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document, and its class as ``class_id``.

    ``class_id`` is the smallest id with an equal set; empty sets are equal to no other.
    """
    staged = tables.stage(shingle_sets(docs, n, percent, docs_per_block, id_col, text_col), "shingles")
    placed = tables.stage(placed_classes(staged, percent).select("set_key", "least", "component_id"), "placed")
    rows = staged.select("doc_id", "n_shingles", "set_key")
    return (spread_join(rows, placed, ["set_key"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("least", "doc_id").alias("class_id")))


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT, docs_per_block: int = DOCS_PER_BLOCK,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each component, with all its columns: one with the smallest id.

    Rows are told apart by id and text; of rows that are equal in both, any one stays. A row with a null
    id stays only where no equal or similar one has an id. Rows with an empty set all stay.

    The first row of a component is found among the first rows of its classes; rows meet their class, with the
    copies of a large one dealt over cells, and no join is keyed by the component.
    """
    doc_id, text_key = F.col(id_col).cast("long"), F.unhex(F.sha1(F.col(text_col)))
    staged = tables.stage(shingle_sets(docs, n, percent, docs_per_block, id_col, text_col, text_key), "shingles")
    alive = staged.filter(F.col("set_key").isNotNull())
    placed = placed_classes(staged, percent).select("set_key", "component", "copies")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    first_of_class = alive.groupBy("set_key").agg(F.min(order).alias("first"))
    of_class = tables.stage(placed.join(first_of_class, "set_key"), "firsts")
    winners = of_class.groupBy("component").agg(F.min("first").alias("first"), F.sum("copies").alias("size")) \
        .filter(F.col("size") > 1).withColumnRenamed("first", "wins")
    # classes of components with more than one row, and their first row if the component's is theirs
    judged = tables.stage(spread_join(of_class, winners, ["component"], deal_by=["set_key"])
                          .select("set_key", F.when(F.col("first") == F.col("wins"), F.col("wins")).alias("wins")), "winners")
    rows = spread_join(alive.select("doc_id", "text_key", "set_key"), judged, ["set_key"])
    stays = F.col("doc_id").eqNullSafe(F.col("wins.doc_id")) & (F.col("text_key") == F.col("wins.text_key"))
    fate = tables.stage(rows.select(F.col("doc_id").alias("fate_id"), F.col("text_key").alias("fate_key"),
                                    F.coalesce(stays, F.lit(False)).alias("stays"))
                        .groupBy("fate_id", "fate_key", "stays").agg(F.count(F.lit(1)).alias("copies")), "fate")

    def among(some: DataFrame, how: str) -> DataFrame:
        # rows to drop grow with the documents, so both sides are shuffled at every size and none is broadcast
        some = some.hint("merge")
        return docs.join(some, doc_id.eqNullSafe(some["fate_id"]) & (text_key == some["fate_key"]), how)

    again = fate.filter(F.col("stays") & (F.col("copies") > 1)).select("fate_id", "fate_key")
    out = among(fate.filter(~F.col("stays") | (F.col("copies") > 1)).select("fate_id", "fate_key"), "left_anti")
    if again.isEmpty():
        return out
    number = "_number"
    while number in docs.columns:
        number = f"_{number}"
    place = F.row_number().over(W.partitionBy(doc_id, text_key).orderBy(doc_id))
    return out.unionByName(among(again, "left_semi").withColumn(number, place)
                           .filter(F.col(number) <= 1).drop(number))
