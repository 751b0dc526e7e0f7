"""Operators on hand-made rows: traps, invariants and skewed groups."""

import hashlib
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from annoloom import schema as S
from annoloom.operators import (
    agreement, assemble, export, facts, legacy, maintain, progress, quality, sampling,
)
from tests.test_functions import matrix_kappa


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


RECORDS = "record_id string, benchmark string, record_type string, task_id string, " \
          "source_text string, target_text string, status string"
RESPONSES = "response_id string, record_id string, user_id string, status string, " \
            "quality_score string, error_categories array<string>, corrected_text string, " \
            "comment string, updated_at timestamp, seq long"


def make_records(spark, specs):
    return spark.createDataFrame(
        [(i, b, t, f"{t}_{i}", f"src {i}", tgt, st) for i, b, t, tgt, st in specs], RECORDS)


def make_responses(spark, specs):
    out = []
    for n, (rec, user, status, score, cats, text) in enumerate(specs):
        out.append((f"r{n}", rec, user, status, score, cats, text, None, None, n))
    return spark.createDataFrame(out, RESPONSES)


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([("u1", "ana", "annotator"), ("u2", "bo", "annotator"),
                                  ("u0", "root", "owner")], "user_id string, username string, role string")


@pytest.fixture(scope="module")
def small(spark, users):
    records = make_records(spark, [
        ("q1", "A", "query", "meta", "completed"), ("q2", "A", "query", "meta", "pending"),
        ("p1", "A", "passage", "meta", "discarded"), ("p2", "X", "passage", "", "completed"),
        ("p3", None, None, None, "completed")])
    responses = make_responses(spark, [
        ("q1", "u1", "submitted", "1 – a", ["Pravopis"], " meta "),       # unchanged: flagged
        ("q1", "u2", "submitted", "2 – b", [S.NO_ERROR_LABEL], "fixed"),  # no error: flagged
        ("q1", "longuserid", "submitted", "n/a", None, "fixed"),          # "?", unknown user
        ("q1", "u1", "draft", "5", [], "x"),                              # drafts never count
        ("q2", "u1", "submitted", "5", [], "x"),                          # record pending
        ("p1", "u2", "discarded", "1", ["Pravopis"], "meta"),
        ("p2", "u1", "submitted", None, [], ""),                          # no score
        ("p2", "u2", "submitted", "0 zero", ["Pravopis", "Pravopis"], "real"),
        ("p3", "u1", "submitted", "4", [], None),
    ])
    return records, responses, users


@pytest.mark.parametrize("texts", [True, False])
def test_annotation_facts(small, texts):
    got = rows(facts.annotation_facts(*small, texts=texts), "response_id", "annotator", "benchmark",
               "score_text", "score_label", "flagged")
    assert got == [
        ("r0", "ana", "A", "1", "1 – a", True), ("r1", "bo", "A", "2", "2 – b", True),
        ("r2", "longuser", "A", "?", "n/a", False), ("r5", "bo", "A", "-", "Discarded", False),
        ("r6", "ana", "X", "?", "?", False), ("r7", "bo", "X", "0", "0 zero", False),
        ("r8", "ana", "Unknown", "4", "4", False)]


def test_both_fact_forms_agree_on_every_flag(spark, sf_dir):
    from annoloom.plans import adapters as A

    tables = A.records(spark, sf_dir), A.responses(spark, sf_dir), A.users(spark, sf_dir)
    narrow = facts.annotation_facts(*tables, texts=False)
    wide = facts.annotation_facts(*tables)
    shared = [c for c in narrow.columns]
    assert narrow.exceptAll(wide.select(*shared)).count() == 0
    assert narrow.count() == wide.count()


def test_discarded_rows_are_blank(small):
    row = facts.annotation_facts(*small).filter("status = 'discarded'").first()
    assert (row["correction"], row["comment"], row["categories"], row["date"]) == ("", "", [], "")


def test_two_totals_differ(small):
    records, responses, users = small
    table = {r["annotator"]: r for r in
             progress.annotator_progress(records, responses, users).collect()}
    assert (table["ana"]["total"], table["ana"]["unrated"]) == (2, 0)
    assert (table["bo"]["total"], table["bo"]["skipped"], table["bo"]["s2"]) == (3, 1, 1)
    assert (table["longuser"]["total"], table["longuser"]["unrated"]) == (0, 1)
    report = {r["annotator"]: r for r in
              progress.annotator_report(facts.annotation_facts(*small, texts=False)).collect()}
    assert (report["ana"]["total"], report["ana"]["avg_score"]) == (3, 2.5)
    assert (report["longuser"]["total"], report["longuser"]["avg_score"]) == (1, None)
    assert (report["bo"]["discarded"], report["bo"]["flagged"]) == (1, 1)


def test_benchmark_progress_zero_fill_floor_and_unknown(spark, small):
    dim = spark.createDataFrame([("A", 0), ("E", 1)], "benchmark string, position int")
    got = {r["benchmark"]: r for r in progress.benchmark_progress(small[0], dim).collect()}
    assert set(got) == {"A", "E", "TOTAL"}                    # X and null are not listed
    assert (got["A"]["queries_done"], got["A"]["queries_total"], got["A"]["queries_pct"]) == (1, 2, 50)
    assert (got["A"]["done"], got["A"]["total"], got["A"]["pct"]) == (2, 3, 66)
    assert (got["E"]["total"], got["E"]["pct"]) == (0, None)
    assert (got["TOTAL"]["total"], got["TOTAL"]["pct"]) == (3, 66)
    form = {r["benchmark"]: r["pct"] for r in
            progress.report_benchmark_progress(small[0], dim).collect()}
    assert form == {"A": 67, "E": 0}
    empty = progress.benchmark_progress(small[0].limit(0), dim).filter("benchmark = 'TOTAL'").first()
    assert (empty["total"], empty["pct"]) == (0, 0)


def test_category_frequency(small):
    records, responses, _ = small
    assert rows(progress.category_frequency(records, responses)) == sorted([
        (S.NO_ERROR_LABEL, 1, 4, 25), ("Pravopis", 3, 4, 75)], key=repr)


def test_a_null_category_is_no_submission(spark):
    records = make_records(spark, [("a", "A", "query", "t", "completed")])
    responses = make_responses(spark, [("a", "u1", "submitted", "1", ["Pravopis", None], "")])
    assert rows(progress.category_frequency(records, responses)) == [("Pravopis", 1, 1, 100)]


def test_a_repeated_user_does_not_repeat_responses(spark):
    responses = make_responses(spark, [("a", "u1", "submitted", "1", [], "")])
    repeated = spark.createDataFrame([("u1", "old", 1), ("u1", "new", 2)], "user_id string, username string, seq long")
    assert rows(facts.resolve_annotators(responses, repeated), "annotator") == [("new",)]


def test_null_text_is_empty_text_in_duplicates(spark):
    records = spark.createDataFrame(
        [("a", "A", "query", "t", "s1", None, "pending"), ("b", "A", "query", "t", "s2", None, "pending"),
         ("c", "A", "query", "t", "s3", "", "pending")], RECORDS)
    assert quality.duplicate_groups(records, "pair").count() == 0
    assert rows(quality.duplicate_groups(records, "target"), "copies", "first_id") == [(3, "a")]
    assert quality.duplicate_members(records, "target").count() == 3


def test_whole_lists_are_not_cut(spark):
    rel = spark.createDataFrame([("b", "q", f"c{i}", i) for i in range(30)], REL)
    assert assemble.relevance_lists(rel).first()["positive_ids"] == [f"c{i}" for i in range(30)]


def test_report_summary(spark, small):
    dim = spark.createDataFrame([("A", 0)], "benchmark string, position int")
    row = progress.report_summary(small[0], dim, facts.annotation_facts(*small, texts=False)).first()
    assert (row["total_records"], row["total_done"], row["done_pct"]) == (3, 2, 67)
    assert (row["annotators"], row["submissions"], row["flags"]) == (3, 3, 2)
    assert row["avg_score"] == 1.75                           # any digit counts, 0 included


def test_positions_are_those_of_the_sorted_rows(small):
    found = facts.annotation_facts(*small)
    for keys in (facts.newest_keys(), facts.sort_keys("score"), facts.sort_keys("annotator", True)):
        want = [r["response_id"] for r in found.orderBy(*keys).collect()]
        got = facts.positioned(found.select("response_id", "record_id", "annotator", "date", "score"), *keys)
        assert [(r["position"], r["response_id"]) for r in got.orderBy("position").collect()] == \
            list(enumerate(want, start=1))


def test_sort_puts_zero_and_unrated_last(small):
    scores = [r["score_text"] for r in
              facts.sort_annotations(facts.annotation_facts(*small), "score").collect()]
    assert scores[:3] == ["1", "2", "4"] and set(scores[3:]) == {"0", "?", "-"}


def test_search_does_not_match_across_columns(small):
    f = facts.annotation_facts(*small)
    assert facts.search_annotations(f, query="META").count() == 4
    assert facts.search_annotations(f, query="meta fixed").count() == 0
    assert facts.search_annotations(f, query="pravopis", annotator="ana").count() == 1
    assert facts.search_annotations(f, score="?", benchmark="A").count() == 1


def test_newest_first_is_sorted(spark, sf_dir):
    from annoloom.plans import adapters as A

    f = facts.annotation_facts(A.records(spark, sf_dir), A.responses(spark, sf_dir, False)
                               .withColumn("corrected_text", F.lit("")), A.users(spark, sf_dir), texts=False)
    got = [tuple(r) for r in facts.newest_first(f).select("date", "record_id", "annotator").collect()]
    assert got == sorted(sorted(got, key=lambda r: r[1:]), key=lambda r: r[0], reverse=True)


def test_latest_response_on_a_hot_key(spark):
    data = [("hot", i) for i in range(5000)] + [(f"k{i}", i) for i in range(50)]
    got = facts.latest_response(spark.createDataFrame(data, "key string, seq long")
                                .repartition(8), ["key"])
    assert got.count() == 51
    assert got.filter("key = 'hot'").first()["seq"] == 4999


# ---- first generation ----

def test_saved_dashboard_shape(spark, users):
    """100 records, 9 annotations by 2 annotators on 6 tasks, nothing modified."""
    records = make_records(spark, [(f"t{i}", "A", "query", "x", "pending") for i in range(100)])
    specs = [(f"t{i % 6}", "u1" if i < 5 else "u2", "submitted", "5", [], "No corrections")
             for i in range(9)]
    stats = legacy.dashboard_stats(records, make_responses(spark, specs)).first()
    assert (stats["total_records"], stats["completed_records"], stats["total_annotations"]) == (100, 6, 9)
    assert (stats["completion_pct"], stats["modification_pct"], stats["accepted"]) == (6.0, 0, 9)


def test_score_distribution_denominator_has_all_labels(spark):
    specs = [("a", "u", "submitted", s, [], "") for s in ("5", "4", "high", "odd", "", None, "1")]
    got = {r["label"]: (r["n"], round(r["pct"], 2)) for r in
           legacy.score_distribution(make_responses(spark, specs)).collect()}
    assert got == {"high": (3, 60.0), "medium": (0, 0.0), "low": (1, 20.0)}


def test_legacy_statistics_on_no_data(spark, users):
    none = make_responses(spark, [("a", "u", "draft", "5", [], "")])
    assert legacy.modification_rate(none).first()["modified_pct"] is None
    assert legacy.score_distribution(none).filter("n > 0").count() == 0
    assert legacy.tasks_per_annotator(none, users).count() == 0


def test_long_fallback_keeps_the_whole_id(spark, users):
    r = make_responses(spark, [("a", "longuserid", "submitted", "5", [], ""),
                               ("a", None, "submitted", "5", [], "")])
    assert rows(legacy.tasks_per_annotator(r, users)) == [("longuserid", 1), ("unknown", 1)]


# ---- agreement ----

def rating_rows(seed, records, annotators, share):
    rng = random.Random(seed)
    return [(f"rec{r}", f"a{a:03d}", rng.choice([1, 2, 3, 4, 5, None]), rng.sample("xyz", rng.randrange(4)))
            for r in range(records) for a in range(annotators) if rng.random() < share]


RATED = "record_id string, annotator string, score int, labels array<string>"


def brute_pairs(data):
    by_record = {}
    for rec, ann, score, labels in data:
        by_record.setdefault(rec, {})[ann] = (score, labels)
    out = {}
    for raters in by_record.values():
        for a, b in combinations(sorted(raters), 2):
            out.setdefault((a, b), []).append((raters[a], raters[b]))
    return out


@pytest.mark.parametrize("per_cell", [1, 3, 256])
def test_rating_pairs_do_not_depend_on_the_split(spark, per_cell):
    """One record has every rater, as a hot record would; its pairs are still whole."""
    data = rating_rows(3, 12, 9, 0.4)
    data = [d for d in data if d[0] != "rec0"] + [("rec0", f"a{a:03d}", 1 + a % 5, ["x"]) for a in range(40)]
    rated = spark.createDataFrame(data, RATED)
    got = agreement.rating_pairs(rated, raters_per_cell=per_cell) \
        .groupBy("annotator_a", "annotator_b").count()
    want = {k: len(v) for k, v in brute_pairs(data).items()}
    assert {(r[0], r[1]): r[2] for r in got.collect()} == want


def test_pairwise_agreement_against_brute_force(spark):
    data = rating_rows(7, 30, 8, 0.5)
    rated = spark.createDataFrame(data, RATED)
    want = {}
    for pair, shared in brute_pairs(data).items():
        scored = [(x[0], y[0]) for x, y in shared if x[0] is not None and y[0] is not None]
        if scored:
            a, b = zip(*scored)
            want[pair] = (len(scored), matrix_kappa(a, b),
                          100 * sum(x == y for x, y in scored) / len(scored),
                          sum(abs(x - y) for x, y in scored) / len(scored))
    got = agreement.pairwise_agreement(rated).collect()
    assert len(got) == len(want)
    for r in got:
        n, kappa, exact, diff = want[(r["annotator_a"], r["annotator_b"])]
        assert r["shared"] == n
        assert r["exact_pct"] == pytest.approx(exact) and r["mean_diff"] == pytest.approx(diff)
        assert r["kappa"] == (None if kappa is None else pytest.approx(kappa, abs=1e-9))
        assert kappa is None or kappa <= 1


def test_category_agreement(spark):
    data = [("r1", "a", 1, ["Stil X", "y"]), ("r1", "b", None, ["Stil X"]), ("r2", "a", 2, []),
            ("r2", "b", 2, []), ("r3", "c", 5, ["z"])]       # r3 has one rater only
    got = rows(agreement.category_agreement(spark.createDataFrame(data, RATED)))
    assert got == [("a", "b", "Stil X", 2, 2, 100.0), ("a", "b", "y", 2, 1, 50.0)]


def test_category_agreement_over_many_labels(spark):
    """Any number of labels, all of them from the data."""
    names = [f"label {i:03d}" for i in range(150)]
    data = [("r1", "a", 1, names), ("r1", "b", 1, names[:149]), ("r2", "a", 1, []), ("r2", "b", 1, names[:1])]
    got = {r[2]: r[4] for r in rows(agreement.category_agreement(spark.createDataFrame(data, RATED)))}
    assert got == {n: 2 - (n in (names[0], names[149])) for n in names}


def test_label_set(spark):
    df = spark.createDataFrame([(["b", "a", "b", None],), (None,), ([],), (["zz"],)], "c array<string>")
    assert [r[0] for r in df.select(agreement.label_set("c")).collect()] == [["a", "b"], [], [], ["zz"]]


def test_asked_annotators_with_all_others_once(spark):
    names = [f"n{i}" for i in range(45)]
    df = spark.createDataFrame([(n,) for n in names], "annotator string")
    asked = df.filter("annotator in ('n3', 'n7')")
    want = sorted((p for p in combinations(sorted(names), 2) if {"n3", "n7"} & set(p)), key=repr)
    for sizes in ((1, 4), (64, 7), (64, 4096)):
        assert rows(agreement.asked_pairs(asked, df, *sizes)) == want
    assert rows(agreement.asked_pairs(asked.limit(0), df)) == []


def test_pairs_without_overlap(spark):
    data = [("r1", "a", 1, []), ("r1", "b", 1, []), ("r2", "c", None, []), ("r2", "a", 3, []),
            ("r3", "d", 2, [])]
    rated = spark.createDataFrame(data, RATED)
    asked = spark.createDataFrame([("c",), ("d",), ("c",)], "annotator string")
    assert rows(agreement.pairs_without_overlap(rated, asked)) == [("a", "c"), ("b", "c")]
    assert rows(agreement.overlap_counts(rated)) == [("a", 1, 1), ("b", 1, 1), ("c", 0, 2)]


def test_pairs_with_others_by_gaps(spark):
    """Any block sizes, with those asked about that are no annotators, and pairs left out."""
    draw = random.Random(4)
    names = [f"n{draw.randint(0, 999)}é" for _ in range(60)] + ["n", "", "N5"]
    annotators = spark.createDataFrame([(n,) for n in [*names, *names[:9], None]], "annotator string")
    for wanted, sizes in (([*names[:20], "stranger", "a", None], (3, 7)), (names, (256, 4096)), (["zz"], (1, 1))):
        asked = spark.createDataFrame([(n,) for n in wanted], "annotator string")
        but = [(a, b) for a in {*wanted} - {None} for b in {*names} if draw.random() < 0.3]
        gone = {frozenset(p) for p in but} | {frozenset(p[::-1]) for p in but}
        both = spark.createDataFrame([p for x in but for p in (x, x, x[::-1])], "one string, other string")
        met = {tuple(sorted((a, b))) for a in {*wanted} - {None} for b in {*names} - {a}}
        assert rows(agreement.asked_pairs(asked, annotators, *sizes, but=both)) == \
            sorted((p for p in met if frozenset(p) not in gone), key=repr)


def test_pairs_without_overlap_are_slices(spark):
    """A row of a pair is made in generated code from a slice of names; nothing is compared with each name of a block."""
    rated = spark.createDataFrame([("r1", "a", 1, []), ("r1", "b", 1, []), ("r2", "b", 1, []), ("r2", "c", 2, [])], RATED)
    found = agreement.pairs_without_overlap(rated, rated.select("annotator"))
    assert rows(found) == [("a", "c")]
    text = found._jdf.queryExecution().executedPlan().toString()
    last = text[:text.index("Exchange")]
    assert "Generate explode(rest" in last and "array_except" not in last and "lambda" not in last


def test_last_rating_wins_and_drafts_do_not_count(spark, users):
    r = make_responses(spark, [("x", "u1", "submitted", "1", [], ""), ("x", "u1", "submitted", "4", [], ""),
                               ("x", "u1", "draft", "5", [], ""), ("x", "u2", "submitted", "n/a", [], "")])
    assert rows(agreement.ratings(r, users), "annotator", "score") == [("ana", 4), ("bo", None)]
    assert rows(agreement.calibration_distribution(agreement.ratings(r, users)), "annotator", "n") == [("ana", 1)]


# ---- assembly ----

TEXTS = "benchmark string, config string, id string, title string, text string, seq long"
REL = "benchmark string, query_id string, corpus_id string, seq long"


def test_cap_counts_positions_not_distinct_ids(spark):
    rel = spark.createDataFrame([("b", "q", c, i) for i, c in enumerate("aabcd")], REL)
    assert [r["corpus_id"] for r in assemble.cap_positives(rel, 3).orderBy("position").collect()] == ["a", "a", "b"]
    assert rows(assemble.needed_passages(rel, 3), "id") == [("a",), ("b",)]
    assert assemble.capped_lists(rel, 4).first()["positive_ids"] == ["a", "a", "b", "c"]


def test_list_relevance_last_row_wins(spark):
    lists = spark.createDataFrame([("b", "q", ["x"], 1), ("b", "q", ["y", "y", "z"], 2), ("b", "p", [], 1)],
                                  "benchmark string, query_id string, positive_ids array<string>, seq long")
    flat = assemble.flatten_relevance(lists)
    assert rows(flat, "query_id", "corpus_id", "seq") == [("q", "y", 0), ("q", "y", 1), ("q", "z", 2)]
    assert rows(assemble.relevance_stats(flat), "pairs", "queries") == [(3, 1)]


def test_assemble_pairs_rules(spark):
    targets = spark.createDataFrame([
        ("b", "queries", "1", None, "q sr", 1), ("b", "queries", "2", None, "no source", 1),
        ("b", "queries", "3", None, "", 1), ("b", "corpus", "p1", None, "old", 1),
        ("b", "corpus", "p1", None, "p sr", 2), ("b", "corpus", "far", None, "unneeded", 1),
        ("c", "queries", "1", None, "other benchmark", 1)], TEXTS)
    sources = spark.createDataFrame([
        ("b", "queries", "1", None, " q en ", 1), ("b", "queries", "3", None, "x", 1),
        ("b", "corpus", "p1", " T ", None, 1), ("b", "corpus", "p2", None, "t", 1)], TEXTS)
    rel = spark.createDataFrame([("b", "1", "p1", 0), ("b", "1", "p2", 1)], REL)
    needed = assemble.needed_passages(rel)
    got = rows(assemble.assemble_pairs(needed, targets, sources), "record_id", "task_id",
               "source_text", "target_text")
    assert got == [("b_passage_p1", "passage_p1", "T\n\n", "p sr"),
                   ("b_query_1", "query_1", "q en", "q sr")]
    assert rows(assemble.pair_skips(needed, targets, sources)) == [
        ("b", "passage", 2, 1, 1), ("b", "query", 3, 1, 2), ("c", "query", 1, 0, 1)]


def test_query_pairs_keep_left_duplicates(spark):
    en = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "query_id int, query string")
    sr = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "query_id int, query string, seq long")
    assert rows(assemble.query_pairs(en, sr)) == [("query_1", "a", "new"), ("query_1", "b", "new")]


@pytest.mark.parametrize("layout", ["struct", "list"])
def test_passage_pairs(spark, layout):
    cases = [  # texts, selected, target texts
        (1, ["a", "b"], [0, 1], ["x", "y"]), (2, ["a", "b"], [0, 0], ["x", "y"]),
        (3, ["a", "b", "c"], [0, 0, 1], ["x", "y"]), (4, ["a"], [1], []),
        (5, ["a", " "], [0, 1], ["x", "y"]), (6, ["a", "b"], [1, 1], ["x"])]

    def bundle(rows_):
        if layout == "struct":
            ddl = "query_id int, passages struct<passage_text:array<string>,is_selected:array<int>>, seq int"
            return spark.createDataFrame([(q, (t, s), 1) for q, t, s in rows_], ddl)
        ddl = "query_id int, passages array<struct<passage_text:string,is_selected:int>>, seq int"
        return spark.createDataFrame([(q, list(zip(t, s)), 1) for q, t, s in rows_], ddl)

    source = bundle([(q, t, s) for q, t, s, _ in cases])
    target = bundle([(q, t, [0] * len(t)) for q, _, _, t in cases])
    assert rows(assemble.passage_pairs(source, target)) == [
        ("passage_1_1", "b", "y"), ("passage_2_0", "a", "x"), ("passage_3_0", "a", "x"),
        ("passage_6_0", "a", "x")]


# ---- quality ----

def test_duplicates_with_one_hot_text(spark):
    data = [(f"h{i}", "A" if i % 2 else "B", "query", "t", "hot text", "z", "pending") for i in range(3000)]
    data += [(f"w{i}", "C", "query", "t", "twice", f"{i}", "pending") for i in range(2)]
    data += [(f"s{i}", "C", "query", "t", f"single {i}", f"single {i}", "pending") for i in range(10)]
    records = spark.createDataFrame(data, RECORDS).repartition(8)
    assert rows(quality.duplicate_groups(records, "source"), "copies", "first_id", "cross_benchmark") == [
        (2, "w0", False), (3000, "h0", True)]
    assert quality.duplicate_groups(records, "id").count() == 0
    assert quality.duplicate_members(records).count() == 3002
    assert rows(quality.duplicate_summary(records)) == [
        ("id", 3012, 0, 0), ("pair", 3012, 1, 0), ("source", 3012, 1, 1), ("target", 3012, 1, 0)]


# ---- sampling ----

def test_sample_is_exact_and_seeded(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("text")).repartition(7)
    want = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), str(i)) for i in range(5000))[:300]
    assert {r[0] for r in rows(sampling.sample_n(df, "id", 300))} == {i for _, i in want}
    assert rows(sampling.sample_n(df, "id", 300, seed=1)) != rows(sampling.sample_n(df, "id", 300))
    assert sampling.sample_n(df, "id", 9000).count() == 5000
    with pytest.raises(ValueError):
        sampling.first_in_order(df, "id", 5, digits=6)


def test_large_strata_are_cut_exactly(spark):
    dim = spark.createDataFrame([("A", 0)], "benchmark string, position int")
    records = make_records(spark, [(f"q{i}", "A", "query", "t", "pending") for i in range(3000)])
    got = {r["record_id"] for r in sampling.calibration_sample(records, dim, k=1001).collect()}
    want = sorted((hashlib.md5(f"42:q{i}".encode()).hexdigest(), f"q{i}") for i in range(3000))[:1001]
    assert got == {i for _, i in want}


def test_shuffled_order_is_the_md5_order(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    got = [r["id"] for r in sampling.shuffled_order(df, "id").orderBy("position").collect()]
    want = sorted((str(i) for i in range(2000)), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert got == want


def test_calibration_sample_and_empty_strata(spark):
    dim = spark.createDataFrame([("A", 0), ("B", 1)], "benchmark string, position int")
    records = make_records(spark, [(f"q{i}", "A", "query", "t", "pending") for i in range(500)]
                           + [("p", "A", "passage", "", "pending"), ("d", "B", "query", "t", "completed"),
                              ("o", "Z", "query", "t", "pending"), ("n", "A", None, "t", "pending")])
    drawn = sampling.calibration_sample(records, dim, k=2)
    assert rows(drawn.groupBy("benchmark", "record_type").count()) == [("A", "passage", 1), ("A", "query", 2)]
    built = sampling.calibration_records(drawn)                   # the passage has no target
    assert built.count() == 2 and built.filter("record_id like 'cal_q%'").count() == 2
    assert rows(sampling.empty_strata(records, dim)) == [("B", "passage"), ("B", "query")]


def test_required_submissions_and_status(spark, users):
    none = spark.createDataFrame([("u1",)], "user_id string")
    assert sampling.required_submissions(users, none).first()[0] == 2
    records = make_records(spark, [("x", "A", "query", "t", "pending"), ("y", "A", "query", "t", "pending")])
    r = make_responses(spark, [("x", "u1", "submitted", "1", [], ""), ("x", "u2", "draft", "1", [], "")])
    assert rows(sampling.derived_status(records, r, 1)) == [("x", 1, "completed"), ("y", 0, "pending")]
    assert rows(sampling.derived_status(records, r, 2), "status") == [("pending",), ("pending",)]


# ---- maintenance and export ----

def test_preview_and_rest_make_up_the_input(spark, small):
    records, responses, users = small
    everything = {r[0] for r in rows(responses, "response_id")}
    gone = {r[0] for r in rows(maintain.discards_preview(responses, users), "response_id")}
    kept = {r[0] for r in rows(maintain.discards_applied(responses), "response_id")}
    assert gone | kept == everything and not gone & kept and gone == {"r5"}
    targets = spark.createDataFrame([("q1", "ana"), ("q1", "longuser"), ("p2", None), ("q9", None)],
                                    "record_id string, annotator string")
    gone = {r[0] for r in rows(maintain.reopen_preview(responses, users, targets), "response_id")}
    kept = {r[0] for r in rows(maintain.reopen_applied(responses, users, targets), "response_id")}
    assert gone == {"r0", "r2", "r3", "r6", "r7"}
    assert gone | kept == everything and not gone & kept


def test_export_filters(small):
    done = export.completed_annotations(*small)
    assert rows(export.export_annotations(done), "response_id") == [("r0",), ("r1",), ("r2",), ("r6",), ("r7",), ("r8",)]
    assert rows(export.export_annotations(done, min_score=1), "response_id") == [("r0",), ("r1",), ("r8",)]
    assert rows(export.export_annotations(done, require_correction=True), "response_id") == [("r1",), ("r2",), ("r7",)]
    assert rows(export.export_filter_counts(done, 2, True)) == [(6, 1, 5)]
    with_link = done.withColumn("annotation_guide_link", F.lit("x"))
    assert "annotation_guide_link" not in export.export_annotations(with_link).columns


def test_export_legacy(spark, users):
    records = make_records(spark, [("x", "A", "query", "čaša", "pending")]).withColumn(
        "task_id", F.lit(None).cast("string"))
    r = make_responses(spark, [
        ("x", "u1", "submitted", "high", [], " Bez Ispravki "), ("x", "u2", "submitted", "low", [], "casa "),
        ("x", "longuserid", "submitted", "low", [], "čaša"), ("x", "u1", "submitted", None, [], "y"),
        ("x", "u1", "draft", "low", [], "y")])
    out = export.export_legacy(records, r, users, "T0")
    got = rows(out, "id", "annotator_id", "corrected_text_sr", "edit_metadata.was_modified",
               "edit_metadata.edit_distance", "timestamp")
    assert got == [("x", "ana", "Bez ispravki", False, 0, "T0"), ("x", "bo", "casa ", True, 3, "T0"),
                   ("x", "longuserid", "čaša", True, 0, "T0")]
    assert export.export_legacy(records, r, users, "T0", status=None).count() == 4


def test_access_roster(spark, users):
    members = spark.createDataFrame([("u2",), ("u2",), ("u0",)], "user_id string")
    assert rows(progress.access_roster(users, members)) == [("ana", "annotator", False), ("bo", "annotator", True)]


def test_asked_pairs_are_not_shuffled(spark):
    names = [f"n{i:02d}" for i in range(30)]
    df = spark.createDataFrame([(n,) for n in [*names, None]], "annotator string")
    asked = spark.createDataFrame([(n,) for n in ["n03", "n07", "n07", "elsewhere", None]], "annotator string")
    known = spark.createDataFrame([("n03", "n07"), ("n07", "n03"), ("n03", "n01")], "one string, other string")
    every = {tuple(sorted((a, b))) for a in ("n03", "n07", "elsewhere") for b in names if a != b}
    got = agreement.asked_pairs(asked, df, 1, 4, but=known)
    assert rows(got) == sorted(every - {("n03", "n07"), ("n01", "n03")}, key=repr)
    assert "annotator_a" not in "".join(x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x)


def test_few_labels_are_bits(spark):
    """The same numbers as with labels as rows, without a row for each label that differs."""
    data = rating_rows(5, 20, 7, 0.6)
    rated = spark.createDataFrame(data, RATED)
    got = agreement.category_agreement(rated)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_except") == 0
    with pytest.MonkeyPatch.context() as monkey:
        monkey.setattr(agreement, "FEW_LABELS", 0)
        want = rows(agreement.category_agreement(rated))
    assert rows(got) == want and want
