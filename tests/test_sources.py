"""Reading, looking up and writing tables in fresh folders."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from annoloom.sources import files, generations, snapshot, tables, texts
from tests.test_operators import TEXTS, rows

LINES = [
    '{"id": "a", "source_text_en": "x", "translated_text_sr": "č"}',
    "",
    '  {"id": 7, "source_text_en": "x", "translated_text_sr": null, "extra": [1, 2]}\t',
    "not json",
    '{"source_text_en": "x", "translated_text_sr": "y"}',
    '{"id": "b", "source_text_en": "x", "translated_text_sr": "y"} trailing',
    '{"id": "c", "source_text_en": "x", "translated_text_sr": "y"}}',
    '{"id": "c", "source_text_en": "x", "translated_text_sr": "y"}] x',
    '{"id": "c", "source_text_en": "x", "translated_text_sr": "y"},"end":1} x',
    '{"id": "c", "source_text_en": "x", "translated_text_sr": "y"}, {"id": "d"}',
    "{'id': 'e', 'source_text_en': 'x', 'translated_text_sr': 'y'}",
    '["id", "source_text_en", "translated_text_sr"]',
    "   ",
    '{"id": "f", "id": "g", "source_text_en": "x", "translated_text_sr": "y"}',
    '{"id": "h", "source_text_en": "x", "translated_text_sr": "y"',
]


def python_reading(lines):
    """What a line-by-line reader with a strict JSON parser accepts and rejects."""
    good, bad = [], []
    for number, line in enumerate(lines, 1):
        line = line.strip()
        if not line:
            continue
        try:
            obj = json.loads(line)
        except json.JSONDecodeError:
            bad.append((number, files.INVALID))
            continue
        if isinstance(obj, dict) and {"id", "source_text_en", "translated_text_sr"} <= obj.keys():
            good.append((str(obj["id"]), obj["source_text_en"], obj["translated_text_sr"]))
        else:
            bad.append((number, files.MISSING))
    return good, bad


def test_jsonl_accepts_and_rejects_like_a_strict_reader(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    good, rejects = files.ingest_jsonl(spark, str(path))
    want_good, want_bad = python_reading(LINES)
    assert rows(good, "id", "source_text", "target_text") == sorted(want_good, key=repr)
    assert rows(rejects, "line_no", "reason") == sorted(want_bad, key=repr)
    kept = good.filter("id = '7'").first()
    assert json.loads(kept["raw"])["extra"] == [1, 2]


def test_line_numbers_across_splits_and_files(spark, tmp_path):
    for name, offset in (("a.jsonl", 0), ("b.jsonl", 3)):
        text = "".join("broken\n" if (i + offset) % 97 == 0 else
                       '{"id": "%d", "source_text_en": "%s", "translated_text_sr": "y"}\n' % (i, "z" * (i % 50))
                       for i in range(3000))
        (tmp_path / name).write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        _, rejects = files.ingest_jsonl(spark, str(tmp_path))
        got = rows(rejects.select(F.regexp_extract("file", "[^/]+$", 0).alias("f"), "line_no"))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [("a.jsonl", i + 1) for i in range(3000) if i % 97 == 0]
    want += [("b.jsonl", i + 1) for i in range(3000) if (i + 3) % 97 == 0]
    assert got == sorted(want, key=repr)


def test_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,source_text_en,translated_text_sr,extra\n1,"a ""q"" \nline",b,e\n2,short\n', encoding="utf-8")
    assert rows(files.ingest_csv(spark, str(path))) == [
        ("1", 'a "q" \nline', "b", "e"), ("2", "short", None, None)]
    path.write_text("id,source_text_en\n1,a\n", encoding="utf-8")
    with pytest.raises(ValueError, match="translated_text_sr"):
        files.ingest_csv(spark, str(path))


def test_read_texts_reports_missing_paths(spark, tmp_path):
    spark.createDataFrame([(5, "T", "x")], "_id int, title string, text string") \
        .write.parquet(str(tmp_path / "c"))
    df, failed = texts.read_texts(spark, {("b", "corpus"): str(tmp_path / "c"),
                                          ("z", "corpus"): str(tmp_path / "none")})
    assert rows(df, "benchmark", "config", "id", "title", "text") == [("b", "corpus", "5", "T", "x")]
    assert failed == [("z", "corpus")]
    assert texts.read_texts(spark, {("z", "q"): str(tmp_path / "none")}) == (None, [("z", "q")])


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_the_last_row_of_an_id_wins_by_file_order(spark, tmp_path, fmt):
    path = str(tmp_path / "c")
    data = [(i % 7, f"t{i}") for i in range(200)]
    spark.createDataFrame(data, "_id int, text string").coalesce(1).write.format(fmt).save(path)
    df, _ = texts.read_texts(spark, {("b", "corpus"): path}, fmt)
    assert rows(texts.latest_texts(df), "id", "text") == sorted(
        ((str(k), t) for k, t in dict(data).items()), key=repr)


def test_both_relevance_layouts(spark, tmp_path):
    pairs, lists = str(tmp_path / "p"), str(tmp_path / "l")
    spark.createDataFrame([(1, 9), (2, 5), (1, 3), (1, 9)], "`query-id` int, `corpus-id` int").coalesce(1).write.json(pairs)
    spark.createDataFrame([(1, [4, 5]), (2, [7]), (1, [6, 6, 4])], "`query-id` int, `positive-corpus-ids` array<int>") \
        .coalesce(1).write.parquet(lists)
    got = texts.read_relevance(spark, "b", pairs, "json")
    assert [(r.query_id, r.corpus_id) for r in got.orderBy("query_id", "seq").collect()] == [
        ("1", "9"), ("1", "3"), ("1", "9"), ("2", "5")]
    got = texts.read_relevance(spark, "b", lists)
    assert [(r.query_id, r.corpus_id) for r in got.orderBy("query_id", "seq").collect()] == [
        ("1", "6"), ("1", "6"), ("1", "4"), ("2", "7")]


def test_snapshot(spark, tmp_path):
    path = tmp_path / "s.json"
    lines = [
        {"id": "i1", "external_id": "e1", "status": "completed", "fields": {"source_text_en": "s"},
         "metadata": {"benchmark": "B"}, "responses": [
             {"id": "r1", "user_id": "u", "status": "submitted",
              "values": {"quality_score": {"value": "2 - x"}, "error_categories": {"value": ["a", None]},
                         "corrected_text_sr": {"value": "c"}}},
             {"user_id": "v", "status": "submitted", "values": {"quality_score": 4, "error_categories": "b"}}]},
        {"id": "i2", "external_id": "", "status": "pending", "metadata": None, "responses": None},
        {"id": "i3", "status": "discarded", "responses": [{"id": "r3", "user_id": None, "status": "discarded"}]}]
    path.write_text("\n".join(json.dumps(x) for x in lines), encoding="utf-8")
    snap = snapshot.read_snapshot(spark, str(path))
    assert rows(snapshot.snapshot_records(snap)) == [
        ("e1", "B", "unknown", "", "s", "", "completed"), ("i2", "Unknown", "unknown", "", "", "", "pending"),
        ("i3", "Unknown", "unknown", "", "", "", "discarded")]
    got = snapshot.snapshot_responses(snap)
    assert rows(got, "response_id", "record_id", "quality_score", "error_categories", "corrected_text", "seq") == [
        ("e1:1", "e1", "4", ["b"], None, 1), ("r1", "e1", "2 - x", ["a", None], "c", 0), ("r3", "i3", None, [], None, 0)]
    assert rows(snapshot.category_values(got)) == [("e1:1", "b"), ("r1", "a")]


def test_materialised_lookup_keeps_what_it_found(spark, tmp_path):
    corpus = spark.createDataFrame([("b", "corpus", str(i), None, f"t{i}", 1) for i in range(10)], TEXTS)
    needed = spark.createDataFrame([("b", "corpus", i) for i in ("1", "2", "77")],
                                   "benchmark string, config string, id string")
    path = str(tmp_path / "lookup")
    first = texts.materialised_lookup(spark, path, corpus, needed)
    assert rows(first, "id", "title", "text") == [("1", "", "t1"), ("2", "", "t2")]
    assert rows(texts.lookup_coverage(needed, first)) == [("b", "corpus", 3, 2, 1)]
    assert rows(texts.missing_ids(needed, first), "id") == [("77",)]
    more = needed.unionByName(spark.createDataFrame([("b", "corpus", "5")], needed.schema))
    assert texts.materialised_lookup(spark, path, corpus, more).count() == 2      # a hit never refetches
    assert texts.materialised_lookup(spark, path, corpus, more, refresh_missing=True).count() == 3
    state = generations.latest(spark, path)
    assert texts.stored_lookup(spark, state).count() == 3 and state.version == 2


def test_a_killed_first_write_is_not_read(spark, tmp_path):
    """Neither Spark's own folder of a killed job nor whole folders that no manifest lists count."""
    corpus = spark.createDataFrame([("b", "corpus", str(i), None, f"t{i}", 1) for i in range(10)], TEXTS)
    needed = corpus.select("benchmark", "config", "id")
    path = str(tmp_path / "lookup")
    (tmp_path / "lookup" / "lookup-dead" / "_temporary" / "0").mkdir(parents=True)
    corpus.limit(2).write.parquet(f"{path}/lookup-whole")
    (tmp_path / "lookup" / generations.MANIFESTS).mkdir()
    (tmp_path / "lookup" / generations.MANIFESTS / "_draft-x").write_text("{")
    assert texts.materialised_lookup(spark, path, corpus, needed).count() == 10
    assert texts.materialised_lookup(spark, path, corpus.limit(0), needed).count() == 10


def test_two_first_writers(spark, tmp_path):
    """The one that is committed first is the table; the other reads it, or adds what it lacks."""
    corpus = spark.createDataFrame([("b", "corpus", str(i), None, f"t{i}", 1) for i in range(10)], TEXTS)
    needed = corpus.select("benchmark", "config", "id")
    path, wins = str(tmp_path / "lookup"), []
    commit = generations.commit

    def late(*args):
        if not wins:
            wins.append(1)
            monkey.setattr(generations, "commit", commit)
            texts.materialised_lookup(spark, path, corpus, needed.filter("id < '5'"))
        return commit(*args)

    with pytest.MonkeyPatch.context() as monkey:
        monkey.setattr(generations, "commit", late)
        assert texts.materialised_lookup(spark, path, corpus, needed).count() == 5
    assert generations.versions(spark, path) == [1]
    assert len([p for p in (tmp_path / "lookup").iterdir() if p.name.startswith("lookup-")]) == 1
    assert texts.materialised_lookup(spark, path, corpus, needed, refresh_missing=True).count() == 10


def test_upsert_is_idempotent_and_last_wins(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "record_id string, v int")
    new = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 4, 1)], "record_id string, v int, o int")
    once = tables.upsert(old, new, order="o").select("record_id", "v")
    assert rows(once) == [("a", 1), ("b", 3), ("c", 4)]
    assert rows(tables.upsert(once, new, order="o").select("record_id", "v")) == rows(once)


def test_scratch_is_deleted(spark):
    with tables.scratch(spark) as path:
        staged = tables.stage(spark.range(5), "x")
        inside = tables.shared_dir(spark, "y")
        assert staged.count() == 5 and inside.startswith(path)
        assert all(f.startswith(("file://" + path, path, "file:" + path)) for f in staged.inputFiles())
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    assert not tables.shared_dir(spark, "z").startswith(path)


def test_write_modes(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    tables.write_table(df, path, "create")
    with pytest.raises(AnalysisException):
        tables.write_table(df, path, "create")
    tables.write_table(spark.range(9), path, "keep")
    assert spark.read.parquet(path).count() == 3
    tables.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    tables.write_table(spark.range(1), path, "recreate")
    assert spark.read.parquet(path).count() == 1


def test_rerun_of_one_benchmark(spark, tmp_path):
    path = str(tmp_path / "records")
    ddl = "record_id string, text string, benchmark string"
    spark.createDataFrame([("a1", "old", "A"), ("a2", "old", "A"), ("b1", "old", "B")], ddl) \
        .write.partitionBy("benchmark").parquet(path)
    dim = spark.createDataFrame([("A",), ("B",)], "benchmark string")
    new = spark.createDataFrame([("a2", "new", "A"), ("a3", "new", "A"), ("b1", "new", "B")], ddl)
    new = new.withColumn("version", F.lit(1))
    tables.upsert_benchmark(spark, path, new, "A", dim, "version")
    assert rows(spark.read.parquet(path), "record_id", "text") == [
        ("a1", "old"), ("a2", "new"), ("a3", "new"), ("b1", "old")]
    assert [p.name for p in tmp_path.iterdir()] == ["records"]            # the merged copy is gone
    with pytest.raises(ValueError, match="unknown benchmark"):
        tables.upsert_benchmark(spark, path, new, "Q", dim, "version")


def test_names_of_digits_stay_names(spark, tmp_path):
    path = str(tmp_path / "records")
    ddl = "record_id string, text string, benchmark string"
    spark.createDataFrame([("a1", "old", "007"), ("a2", "old", "7")], ddl).write.partitionBy("benchmark").parquet(path)
    dim = spark.createDataFrame([("007",), ("7",)], "benchmark string")
    new = spark.createDataFrame([("a1", "new", "007")], ddl).withColumn("version", F.lit(1))
    tables.upsert_benchmark(spark, path, new, "007", dim, "version")
    back = spark.read.schema("record_id string, text string, benchmark string").parquet(path)
    assert rows(back) == [("a1", "new", "007"), ("a2", "old", "7")]
    corpus = spark.createDataFrame([("007", "corpus", "1", None, "t", 1)], TEXTS)
    needed = corpus.select("benchmark", "config", "id")
    for _ in range(2):
        found = texts.materialised_lookup(spark, str(tmp_path / "lookup"), corpus, needed)
        assert rows(found, "benchmark", "id", "text") == [("007", "1", "t")]


def test_csv_is_split_unless_a_field_has_line_breaks(spark, tmp_path):
    head = '"id","source_text_en","translated_text_sr"\n'
    (tmp_path / "plain.csv").write_text(head + '"a","say ""x""","y"\n' * 5)
    (tmp_path / "broken.csv").write_text(head + '"a","x\nz","y"\n')
    assert [files.has_broken_lines(spark, str(tmp_path / f)) for f in ("plain.csv", "broken.csv")] == [False, True]
    assert rows(files.ingest_csv(spark, str(tmp_path / "plain.csv"))) == [("a", 'say "x"', "y")] * 5
    assert rows(files.ingest_csv(spark, str(tmp_path / "broken.csv"))) == [("a", "x\nz", "y")]


def test_a_csv_file_with_other_columns_is_an_error(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("id,source_text_en,translated_text_sr\n1,s,t\n", encoding="utf-8")
    (tmp_path / "d" / "b.csv").write_text("translated_text_sr,id,source_text_en\nt,2,s\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        files.ingest_csv(spark, str(tmp_path / "d")).collect()


def test_jsonl_keeps_nulls_and_letters(spark, tmp_path):
    df = spark.createDataFrame([("č", None, "link")], "a string, b string, annotation_guide_link string")
    tables.write_jsonl(df, str(tmp_path / "o"), drop=("annotation_guide_link",))
    lines = [line for p in (tmp_path / "o").glob("part-*") for line in p.read_text("utf-8").splitlines()]
    assert lines == ['{"a":"č","b":null}']
    tables.write_bundle({"one": df, "two": df}, str(tmp_path / "bundle"))
    assert spark.read.json(str(tmp_path / "bundle" / "two")).count() == 1


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = tables.shared_dir(spark, "x"), tables.shared_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_stage_round_trip(spark):
    df = spark.createDataFrame([("a", [1, 2])], "k string, v array<int>")
    staged = tables.stage(df, "t")
    assert rows(staged) == [("a", [1, 2])]


def test_pair_records(spark):
    df = spark.createDataFrame([("1", None, "y")], "id string, source_text string, target_text string")
    assert rows(files.pair_records(df, "batch")) == [("1", "1", "batch", "", "y", "pending")]


def test_benchmark_table(spark):
    from annoloom.operators import progress
    from tests.test_operators import make_records

    dim = texts.benchmark_table(spark)
    assert dim.count() == 13
    records = make_records(spark, [("a", "NanoNQ", "query", "t", "completed"), ("b", "Else", "query", "t", "pending")])
    got = progress.benchmark_progress(records, dim).collect()
    assert [r["position"] for r in got] == [*range(13), None]
    assert (got[4]["benchmark"], got[4]["pct"]) == ("NanoNQ", 100)
    assert (got[13]["benchmark"], got[13]["total"]) == ("TOTAL", 1)
