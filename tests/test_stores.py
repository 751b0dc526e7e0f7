"""Stored tables: committed generations, buckets, the retraction log, the id-clustered corpus, counters."""

import random

import pytest
from pyspark.sql import functions as F

from annoloom.operators import counters, progress
from annoloom.sources import buckets, corpus_index, generations, retractions, tables, texts
from tests.test_operators import RECORDS, RESPONSES, TEXTS, make_records, make_responses, rows


def files_of(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


# ---- generations ----

def test_only_committed_folders_count(spark, tmp_path):
    path = str(tmp_path / "t")
    assert generations.latest(spark, path) is None and generations.versions(spark, path) == []
    spark.range(3).write.parquet(f"{path}/a")
    spark.range(9).write.parquet(f"{path}/never")
    first = generations.commit(spark, path, None, {"rows": ["a"]}, {"n": 3})
    assert generations.latest(spark, path) == first and first.facts == {"n": 3}
    assert generations.read_part(spark, first, "rows", "id long").count() == 3
    assert generations.read_part(spark, first, "none", "id long").count() == 0
    with pytest.raises(generations.Conflict):
        generations.commit(spark, path, None, {"rows": ["never"]})
    assert generations.latest(spark, path) == first


def test_a_slower_writer_starts_again_on_the_new_state(spark, tmp_path):
    path, seen = str(tmp_path / "t"), []

    def change(state):
        seen.append(state.version if state else 0)
        folder = generations.new_folder("rows")
        spark.range(1).write.parquet(f"{path}/{folder}")
        if len(seen) == 1:
            generations.commit(spark, path, None, {"rows": ["other"]})
        return {"rows": [*(state.parts["rows"] if state else ()), folder]}, {}

    state = generations.update(spark, path, change)
    assert seen == [0, 1] and state.version == 2 and state.parts["rows"][0] == "other"
    assert len(generations.folders_in(spark, path)) == 2         # the manifests, and one folder: the first try's is gone


def test_old_generations_are_dropped_and_foreign_folders_left(spark, tmp_path):
    path = str(tmp_path / "t")
    for name in ("a", "b", "c", "at-work"):
        spark.range(1).write.parquet(f"{path}/{name}")
    state = None
    for parts in (["a", "b"], ["b", "c"]):
        state = generations.commit(spark, path, state, {"rows": parts})
    generations.drop_before(spark, state)
    assert generations.folders_in(spark, path) == [generations.MANIFESTS, "at-work", "b", "c"]
    with pytest.raises(generations.Conflict):                   # a number is never given twice
        generations.commit(spark, path, None, {"rows": ["at-work"]})
    with pytest.MonkeyPatch.context() as monkey:
        monkey.setattr(generations, "KEPT_MANIFESTS", 1)
        generations.drop_before(spark, state)
    assert generations.versions(spark, path) == [2] and generations.latest(spark, path) == state


# ---- buckets ----

def test_an_upsert_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"), F.lit(0).alias("o"))
    state = buckets.create_bucketed(spark, path, old.unionByName(old.limit(10)), "k", "o", rows_per_bucket=100)
    assert len(state.parts) == 11 and buckets.read_bucketed(spark, path).count() == 1000
    before = files_of(tmp_path / "t")
    new = spark.createDataFrame([("5", "x", 1), ("5", "y", 2), ("new", "z", 1)], "k string, v string, o int")
    after_state = buckets.upsert_bucketed(spark, path, new, "o")
    got = {r.k: r.v for r in buckets.read_bucketed(spark, path).collect()}
    assert len(got) == 1001 and got["5"] == "y" and got["new"] == "z" and got["6"] == "old"
    hit = {b for b in after_state.parts if after_state.parts[b] != state.parts.get(b)}
    assert 1 <= len(hit) <= 2
    after = files_of(tmp_path / "t")
    same = {f for b in state.parts if b not in hit for f in before if f.startswith(state.parts[b][0] + "/")}
    assert same and all(after[f] == before[f] for f in same)
    gone = {f for b in hit for f in before if f.startswith(state.parts[b][0] + "/")}
    assert gone and not gone & after.keys()                      # nothing that was replaced or staged is left
    listed = {f for folders in after_state.parts.values() for f in folders}
    assert all(any(f.startswith(x + "/") for x in listed) for f in after)


def test_buckets_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k string, v string, o int")
    buckets.create_bucketed(spark, path, empty, "k", "o")
    assert buckets.read_bucketed(spark, path).count() == 0
    buckets.upsert_bucketed(spark, path, empty, "o")
    buckets.upsert_bucketed(spark, path, spark.createDataFrame([(None, "n", 1), ("a", None, 1)], empty.schema), "o")
    assert rows(buckets.read_bucketed(spark, path)) == [("a", None, 1), (None, "n", 1)]
    with pytest.raises(generations.Conflict):
        buckets.create_bucketed(spark, path, empty, "k", "o")
    with pytest.raises(FileNotFoundError):
        buckets.read_bucketed(spark, str(tmp_path / "none"))


# ---- retractions ----

ANSWERS = "response_id string, status string, seq long"


def test_every_version_can_be_read(spark, tmp_path):
    path = str(tmp_path / "r")
    retractions.add_responses(spark, path, spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("b", "y", 3), ("c", "x", 4)], ANSWERS))
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "response_id string")
    retractions.retract(spark, path, ids("a", "a", "zz", None))
    before = files_of(tmp_path / "r")
    retractions.add_responses(spark, path, spark.createDataFrame([("a", "again", 5), ("d", "x", 6)], ANSWERS))
    retractions.retract(spark, path, ids("b"))
    assert before.items() <= files_of(tmp_path / "r").items()    # appending rewrites nothing
    want = {1: {"a": "x", "b": "y", "c": "x"}, 2: {"b": "y", "c": "x"}, 3: {"a": "again", "b": "y", "c": "x", "d": "x"},
            4: {"a": "again", "c": "x", "d": "x"}}
    as_of = lambda v=None: {r.response_id: r.status for r in retractions.responses_as_of(spark, path, v).collect()}
    assert {v: as_of(v) for v in want} == want and as_of() == want[4]
    retractions.compact(spark, path)
    assert as_of() == want[4] and len(generations.latest(spark, path).parts["log"]) == 0
    assert len(generations.folders_in(spark, path)) == 2         # the manifests and one base
    with pytest.raises(ValueError):
        as_of(4)
    retractions.retract(spark, path, ids("d"))
    assert as_of(5) == want[4] and as_of() == {"a": "again", "c": "x"}
    with pytest.raises(FileNotFoundError):
        retractions.retract(spark, str(tmp_path / "none"), ids("a"))


# ---- corpus index ----

@pytest.fixture(scope="module")
def corpus(spark):
    data = [("b", "corpus", f"{i:05d}", None if i % 9 == 0 else f"t{i}", f"text {i}" * 20, 1) for i in range(4000)]
    data += [("b", "corpus", f"{i:05d}", "newer", None, 2) for i in range(0, 4000, 40)]
    data += [("c", "queries", f"{i:05d}", "", "q", 1) for i in range(0, 4000, 100)]
    return spark.createDataFrame(data, TEXTS).repartition(4)


@pytest.fixture(scope="module")
def index(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    return path, corpus_index.build_index(spark, path, corpus, rows_per_file=200)


def scan_metrics(df):
    """Files and rows that the executed plan's scans of text rows took."""
    df.collect()
    todo, files, read = [df._jdf.queryExecution().executedPlan()], 0, 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        elif name.startswith("Scan parquet") and "rows-" in node.toString():
            files += node.metrics().apply("numFiles").value()
            read += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return files, read


@pytest.mark.parametrize("ids", [["00000"], ["00007", "00040", "03999", "none", ""], ["zzz"], [], [f"{i:05d}" for i in range(0, 4000, 3)]])
def test_indexed_lookup_equals_the_lookup(spark, corpus, index, ids):
    needed = spark.createDataFrame([("b", "corpus", i) for i in ids] + [("c", "queries", i) for i in ids],
                                   "benchmark string, config string, id string")
    assert rows(corpus_index.indexed_lookup(spark, index[0], needed)) == rows(texts.corpus_lookup(corpus, needed))


def test_few_ids_open_few_files(spark, index):
    path, state = index
    ranges = generations.read_part(spark, state, "ranges", corpus_index.RANGES)
    files = ranges.count()
    assert files >= 15 and ranges.agg(F.sum("rows")).first()[0] == 4040
    needed = spark.createDataFrame([("b", "corpus", i) for i in ("00007", "00008", "02000")],
                                   "benchmark string, config string, id string")
    opened, read = scan_metrics(corpus_index.indexed_lookup(spark, path, needed))
    assert 0 < opened <= 2 and read <= 600


def test_the_stored_ids_have_bloom_filters(spark, index):
    hadoop = spark._jvm.org.apache.parquet.hadoop
    folder = index[1].folders("rows")[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = [f.getPath() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path) if f.getPath().getName().endswith("parquet")]
    source = hadoop.util.HadoopInputFile.fromPath(files[0], spark._jsc.hadoopConfiguration())
    reader = hadoop.ParquetFileReader.open(source)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    offsets = {columns.get(i).getPath().toDotString(): columns.get(i).getBloomFilterOffset() for i in range(columns.size())}
    reader.close()
    assert offsets["id"] > 0 and offsets["text"] <= 0


# ---- counters ----

def test_counters_follow_any_change(spark):
    draw = random.Random(8)
    users = spark.createDataFrame([("u1", "ana"), ("u2", "bo")], "user_id string, username string")
    marks = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "benchmark string, position int")

    def state(n):
        recs = [(f"r{i}", draw.choice("ABX"), draw.choice(["query", "passage"]), "t", draw.choice(["pending", "completed", "discarded"]))
                for i in range(n)]
        answers = [(f"r{draw.randint(0, n)}", draw.choice(["u1", "u2", "u3", None]), draw.choice(["submitted", "discarded", "draft"]),
                    draw.choice(["1 – a", "3", "n/a", "", None, "7"]), [], "") for _ in range(3 * n)]
        return recs, answers

    recs, answers = state(40)
    before = make_records(spark, recs), make_responses(spark, answers)
    # records 0 to 9 change their status, 10 to 14 and their answers go, new ones come
    later_recs = [(*r[:4], "completed") if i < 10 else r for i, r in enumerate(recs) if not 10 <= i < 15] + [("r99", "C", "query", "t", "completed")]
    later = [a for a in answers if a[0] not in {f"r{i}" for i in range(10, 15)}][::-1][3:][::-1] + [("r99", "u2", "submitted", "5", [], "")]
    after = make_records(spark, later_recs), make_responses(spark, later)
    touched = spark.createDataFrame([(f"r{i}",) for i in [*range(15), 99]] + [(a[0],) for a in answers[-40:]], "record_id string")
    stored = tables.stage(counters.counters(*before), "c")
    change = counters.deltas(counters.slice_of(*before, touched), counters.slice_of(*after, touched))
    merged = counters.merge(stored, change)
    assert rows(merged) == rows(counters.counters(*after))
    assert rows(counters.benchmark_progress(merged, marks)) == rows(progress.benchmark_progress(after[0], marks))
    assert rows(counters.annotator_progress(merged, users)) == rows(progress.annotator_progress(*after, users))
    undone = counters.merge(merged, change.withColumn("n", -F.col("n")))
    assert rows(undone) == rows(stored)
    assert counters.merge(stored, stored.withColumn("n", -F.col("n"))).count() == 0


def test_counters_of_nothing(spark):
    none = spark.createDataFrame([], RECORDS), spark.createDataFrame([], RESPONSES)
    assert counters.counters(*none).count() == 0 and counters.deltas(none, none).count() == 0


def test_an_id_whose_rows_cross_files(spark, tmp_path):
    """A task writes several files, so the rows of an id may end one file and begin the next."""
    data = [(b, "corpus", f"{i:03d}", "t", f"{b}{i}", 1) for i in range(40) for b in "abcdefg"]
    corpus = spark.createDataFrame(data, TEXTS)
    path = str(tmp_path / "i")
    with pytest.MonkeyPatch.context() as monkey:
        monkey.setattr(tables, "SMALL_TASKS", 2)
        state = corpus_index.build_index(spark, path, corpus, rows_per_file=5)
    files = generations.read_part(spark, state, "ranges", corpus_index.RANGES)
    assert files.count() >= 56 and files.select(F.regexp_extract("file", r"^part-(\d+)-", 1)).distinct().count() <= 2
    for ids in (["000"], ["007", "013", "014"], ["039", "none"]):
        needed = corpus.filter(F.col("id").isin(ids)).select("benchmark", "config", "id")
        assert rows(corpus_index.indexed_lookup(spark, path, needed)) == rows(texts.corpus_lookup(corpus, needed))
        assert len(corpus_index.files_of(spark, state, needed)) <= 3 * len(ids)


def test_bucket_rows_are_shuffled_once(spark, tmp_path):
    """An upsert meets its rows by bucket alone; keys with many versions and null keys keep their meaning."""
    ddl = "k string, v string, o int"
    old = spark.createDataFrame([("a", "old", 0), ("b", "old", 0), (None, "old", 0)], ddl)
    new = spark.createDataFrame([("a", f"v{i}", i) for i in range(300)] + [(None, "n1", 1), (None, "n2", 2), ("c", "x", 0)], ddl)
    path, seen = str(tmp_path / "t"), []
    buckets.create_bucketed(spark, path, old, "k", "o", rows_per_bucket=1)
    with pytest.MonkeyPatch.context() as monkey:
        monkey.setattr(tables, "upsert", lambda *a: seen.append(a) or 1 / 0)
        buckets.upsert_bucketed(spark, path, new, "o")
    assert rows(buckets.read_bucketed(spark, path)) == sorted(
        [("a", "v299", 299), ("b", "old", 0), ("c", "x", 0), (None, "n2", 2), (None, "old", 0)], key=repr)
