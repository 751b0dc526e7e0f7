"""Search by trigrams, ordered tables and their pages, chunked lists, written shuffles."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from annoloom.operators import assemble, facts, sampling, search_index
from annoloom.sources import generations, ordered, tables
from tests.test_operators import rows
from tests.test_stores import scan_metrics

WIDE = ("response_id string, record_id string, annotator string, benchmark string, record_type string, score_text string, "
        "source_text string, target_text string, correction string, comment string, categories array<string>, flagged boolean")


# ---- trigram search ----

@pytest.fixture(scope="module")
def annotations(spark):
    draw = random.Random(9)
    text = lambda n: "".join(draw.choices("abcč ŠĐ", k=draw.randint(0, n)))
    recs = {f"rec{i}": (text(30), text(30), draw.choice(["A", "bench", "ča"])) for i in range(60)}
    recs["rec0"] = ("", "a", "A")
    recs["rec1"] = ("İstanbul ab", "x" * 5000 + "needle", "A")
    data = []
    for i in range(200):
        rec = draw.choice(list(recs))
        source, target, bench = recs[rec]
        data.append((f"r{i}", rec, draw.choice(["ana", "bo", "č"]), bench, "query", "1", source, target, text(20), text(3),
                     draw.choice([[], ["ab", "c"], [None, "šab"]]), i % 2 == 0))
    return tables.stage(spark.createDataFrame(data, WIDE).repartition(4), "wide")


@pytest.fixture(scope="module")
def search_path(spark, annotations, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("search") / "i")
    records = annotations.select("record_id", "source_text", "target_text", "benchmark").distinct()
    search_index.build_index(spark, path, records, annotations)
    return path


def needles():
    draw = random.Random(10)
    some = ["".join(draw.choices("abcč šđ", k=draw.randint(1, 6))) for _ in range(25)]
    return [*some, "a", "č", "ab", "needle", "xxxneedle", "zzz", "q", "", "  ", "ab c", "BENCH", "İstanbul", "i̇s", "%", "_"]


def test_no_hit_is_lost(spark, annotations, search_path):
    """Recall 1.0 for needles of any length; every result is that of the search without an index."""
    hits = 0
    for needle in needles():
        want = rows(facts.search_annotations(annotations, query=needle), "response_id")
        assert rows(search_index.indexed_search(spark, search_path, annotations, needle), "response_id") == want, needle
        hits += len(want)
    assert hits > 500
    got = search_index.indexed_search(spark, search_path, annotations, "ab", flagged_only=True, annotator="ana")
    assert rows(got) == rows(facts.search_annotations(annotations, query="ab", flagged_only=True, annotator="ana"))


def test_texts_are_shuffled_once(spark, tmp_path, monkeypatch):
    """Postings come from the one exchange that makes texts distinct, and the session's settings are as before."""
    records = spark.createDataFrame([(f"r{i}", f"text {i}", "cilj", "A") for i in range(30)],
                                    "record_id string, source_text string, target_text string, benchmark string")
    own = spark.createDataFrame([("a", "c", "", "ana", ["x"])],
                                "response_id string, correction string, comment string, annotator string, categories array<string>")
    monkeypatch.setattr(search_index, "CHARS_PER_SEGMENT", 20)
    monkeypatch.setattr(search_index, "CHARS_PER_ROUND", 100)
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    options = type(records.write).options
    monkeypatch.setattr(type(records.write), "options", lambda self, **o: seen.append(self._df) or options(self, **o))
    state = search_index.build_index(spark, str(tmp_path / "i"), records, own)
    text = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in text and "Aggregate" in text
    stored = spark.read.parquet(*state.folders("postings"))
    assert len(state.folders("postings")) == 3 and len(stored.inputFiles()) > 5 and stored.distinct().count() == stored.count() > 100
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert {r.id for r in search_index.candidates(spark, str(tmp_path / "i"), "text 7").collect()} == {"r7"}


def test_candidates_are_few(spark, annotations, search_path):
    found = search_index.candidates(spark, search_path, "needle").collect()
    assert [(r.field, r.id) for r in found] == [("target_text", "rec1")]
    assert search_index.candidates(spark, search_path, "needlf").count() == 0
    with pytest.raises(FileNotFoundError):
        search_index.candidates(spark, search_path + "-none", "a")


def test_grams(spark):
    df = spark.createDataFrame([("AbcAbc",), ("ab",), ("",), (None,), ("\U0001F600ab",)], "t string")
    assert [r[0] for r in df.select(search_index.grams(F.col("t"))).collect()] == [
        ["abc", "bca", "cab"], ["ab"], [], [], ["\U0001F600ab"]]


# ---- ordered tables ----

@pytest.fixture(scope="module")
def numbers(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ordered") / "rows-table")
    df = spark.range(5000).select(F.col("id"), F.repeat(F.lit("x"), 50).alias("text")).repartition(6)
    ordered.write_ordered(spark, path, df, [F.desc("id")], rows_per_file=300)
    return path


def test_positions_follow_the_order(spark, numbers):
    got = rows(ordered.read_ordered(spark, numbers), "position", "id")
    assert sorted(got) == [(p, 5000 - p) for p in range(1, 5001)]
    assert ordered.row_count(spark, numbers) == 5000


@pytest.mark.parametrize("page", [1, 2, 125, 250])
def test_a_page_opens_one_file(spark, numbers, page):
    df = ordered.read_page(spark, numbers, page, 20)
    opened, read = scan_metrics(df)
    assert opened <= 2 and read <= 1500
    assert sorted(rows(df, "position", "id")) == [(p, 5000 - p) for p in range(20 * page - 19, 20 * page + 1)]


def test_pages_beyond_the_end_and_empty_tables(spark, numbers, tmp_path):
    assert ordered.read_page(spark, numbers, 251, 20).count() == 0
    assert sorted(rows(ordered.read_ordered(spark, numbers, 4999), "id")) == [(0,), (1,)]
    path = str(tmp_path / "none")
    with pytest.raises(FileNotFoundError):
        ordered.read_page(spark, path, 1)
    ordered.write_ordered(spark, path, spark.range(0), [F.col("id")])
    assert ordered.read_page(spark, path, 1).count() == 0 and ordered.row_count(spark, path) == 0
    ordered.write_ordered(spark, path, spark.range(3), [F.col("id")])        # a newer order replaces the older
    assert sorted(rows(ordered.read_ordered(spark, path))) == [(0, 1), (1, 2), (2, 3)]
    assert generations.latest(spark, path).version == 2


# ---- written shuffles ----

def test_shuffled_table_is_the_seeded_order(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.lit("long text").alias("text"))
    path = str(tmp_path / "s")
    state = sampling.write_shuffled(spark, path, df, "id", rows_per_file=100)
    got = rows(ordered.read_ordered(spark, path), "position", "id")
    want = sorted((str(i) for i in range(2000)), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert sorted(got) == list(enumerate(want, 1))
    assert generations.read_part(spark, state, "files", ordered.FILES).count() > 10
    assert sorted(got) == sorted(rows(sampling.shuffled_order(df, "id"), "position", "id"))


def test_ranking_moves_no_texts(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("text")).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    seen, stage = [], tables.stage

    def watched(part, name):
        seen.append((name, part.columns))
        return stage(part, name)

    with pytest.MonkeyPatch.context() as monkey:
        monkey.setattr(tables, "stage", watched)
        placed = sampling.shuffled_order(df, "id")
    assert placed.count() == 100 and seen and all("text" not in columns for _, columns in seen)
    nulls = spark.createDataFrame([(None, "a"), ("1", "b")], "id string, text string")
    assert rows(sampling.shuffled_order(nulls, "id"), "text") == [("a",), ("b",)]


# ---- chunked lists ----

FLAT = "benchmark string, query_id string, corpus_id string, seq long"


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_chunks_are_the_whole_lists(spark, size):
    draw = random.Random(11)
    data = [(b, f"q{q}", f"d{draw.randint(0, 9)}", s) for b in "AB" for q in range(12) for s in range(draw.choice([1, 2, 3, 7, 20]))]
    df = spark.createDataFrame(draw.sample(data, len(data)), FLAT)
    chunks = assemble.relevance_chunks(df, size)
    lists = {(r.benchmark, r.query_id): r.positive_ids for r in assemble.relevance_lists(df).collect()}
    got = {}
    for r in sorted(chunks.collect(), key=lambda r: (r.benchmark, r.query_id, r.chunk)):
        found = got.setdefault((r.benchmark, r.query_id), [])
        assert r.first == len(found) + 1 and r.chunk == len(found) // size and len(r.corpus_ids) <= size
        found += r.corpus_ids
    assert got == lists
    back = assemble.relevance_lists(assemble.relevance_of_chunks(chunks))
    assert {(r.benchmark, r.query_id): r.positive_ids for r in back.collect()} == lists
    assert assemble.relevance_chunks(df.limit(0)).count() == 0


def test_a_query_with_a_million_positives(spark):
    """No row and no task holds its list."""
    n = 1_000_000
    hot = spark.range(n).select(F.lit("A").alias("benchmark"), F.lit("hot").alias("query_id"),
                                F.col("id").cast("string").alias("corpus_id"), (n - F.col("id")).alias("seq"))
    cold = spark.range(1000).select(F.lit("A").alias("benchmark"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("query_id"),
                                    F.lit("d").alias("corpus_id"), F.col("id").alias("seq"))
    chunks = tables.stage(assemble.relevance_chunks(hot.unionByName(cold), 10_000), "chunks")
    of_hot = chunks.filter("query_id = 'hot'")
    assert of_hot.count() == 100 and of_hot.agg(F.max(F.size("corpus_ids"))).first()[0] == 10_000
    assert of_hot.filter("chunk = 0").first()["corpus_ids"][:2] == [str(n - 1), str(n - 2)]
    assert chunks.agg(F.sum(F.size("corpus_ids"))).first()[0] == n + 1000


def test_small_files_are_not_a_task_each(spark, tmp_path):
    """What a write sends to the driver grows with its tasks; file names past 999 of one task keep their order."""
    assert tables.file_plan(0, 10, 100, 50) == (1, 10)
    tasks, per_file = tables.file_plan(20_000_000, 500, 250_000, 50_000)
    assert tasks == tables.SMALL_TASKS and per_file == 500
    tasks, per_file = tables.file_plan(100_000_000, 500, 250_000, 50_000)
    assert tasks <= 500 and 100_000_000 / per_file + tasks <= 50_000
    with pytest.MonkeyPatch.context() as monkey:
        monkey.setattr(tables, "SMALL_TASKS", 1)
        path = str(tmp_path / "t")
        state = ordered.write_ordered(spark, path, spark.range(1100).repartition(3), [F.desc("id")], rows_per_file=1)
    files = generations.read_part(spark, state, "files", ordered.FILES)
    assert files.count() == 1100 and files.select(F.regexp_extract("file", r"^part-(\d+)-", 1)).distinct().count() == 1
    assert sorted(rows(ordered.read_ordered(spark, path, 991, 1010), "position", "id")) == [(p, 1100 - p) for p in range(991, 1011)]


def test_postings_are_not_shuffled(spark, annotations, tmp_path):
    """Each segment is sorted on its own; its texts are in no other."""
    records = annotations.select("record_id", "source_text", "target_text", "benchmark").distinct()
    with pytest.MonkeyPatch.context() as monkey:
        monkey.setattr(search_index, "CHARS_PER_SEGMENT", 2000)
        state = search_index.build_index(spark, str(tmp_path / "i"), records, annotations)
    postings = generations.read_part(spark, state, "postings", search_index.POSTINGS).withColumn("file", F.col("_metadata.file_name"))
    assert postings.select("file").distinct().count() > 2
    assert postings.groupBy("text_key").agg(F.count_distinct("file").alias("n")).filter("n > 1").isEmpty()
    assert search_index.candidates(spark, str(tmp_path / "i"), "needle").count() == 1
