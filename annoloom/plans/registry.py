"""Registered queries: each runs one operator over the whole test tables.

Doubles are rounded to six places and lists are joined into strings so that results can
be compared value by value; the operators themselves keep doubles and arrays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annoloom.functions import scores as SC
from annoloom.functions import text as TX
from annoloom.functions import values as V
from annoloom.operators import (
    agreement, assemble, counters, export, facts, legacy, maintain, progress, quality, sampling, search_index,
)
from annoloom.plans import adapters as A
from annoloom.plans import report
from annoloom.sources import buckets, corpus_index, files, ordered, retractions, snapshot, tables, texts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EXPORTED_AT = "2024-02-01T00:00:00Z"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def joined(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


def _facts(spark: SparkSession, d: str, with_texts: bool = False) -> DataFrame:
    return facts.annotation_facts(A.records(spark, d), A.responses(spark, d), A.users(spark, d),
                                  texts=with_texts)


# ---- sources and sinks ----

def _pair_lines(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines of all documents; some languages are written with a fault."""
    doc = A.table(spark, d, "documents")
    keep_nulls = {"ignoreNullFields": "false"}
    ident = F.col("doc_id").cast("string").alias("id")
    full = F.to_json(F.struct(ident, F.col("text").alias("source_text_en"),
                              F.reverse("text").alias("translated_text_sr"), "source"))
    untranslated = F.to_json(F.struct(ident, F.col("text").alias("source_text_en"),
                                      F.lit(None).cast("string").alias("translated_text_sr")),
                             keep_nulls)
    no_key = F.to_json(F.struct(ident, F.col("text").alias("source_text_en")))
    line = (F.when(F.col("lang") == "fr", untranslated).when(F.col("lang") == "es", no_key)
            .when(F.col("lang") == "de", F.concat(full, F.lit(" trailing")))
            .otherwise(F.concat(F.lit("  "), full, F.lit("\t"))))
    return doc.select(line.alias("value"))


def _ingested(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    path = tables.shared_dir(spark, "pairs-jsonl")
    _pair_lines(spark, d).write.text(path)
    return files.ingest_jsonl(spark, path)


@query
def ingest_jsonl(spark, d):
    good, _ = _ingested(spark, d)
    return good.select("id", "source_text", "target_text",
                       F.get_json_object("raw", "$.source").alias("extra_source"))


@query
def ingest_rejects(spark, d):
    _, rejects = _ingested(spark, d)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"),
                                         F.count_distinct("file", "line_no").alias("places"))


@query
def ingest_csv(spark, d):
    path = tables.shared_dir(spark, "pairs-csv")
    (A.table(spark, d, "documents")
     .select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("source_text_en"),
             F.reverse("text").alias("translated_text_sr"), F.col("source").alias("origin"))
     .write.option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return files.ingest_csv(spark, path)


def _needed(spark: SparkSession, d: str) -> DataFrame:
    """Needed passage ids, staged so that the corpus scan can be pruned by their size."""
    ids = A.relevance(spark, d).select("benchmark", F.col("corpus_id").alias("id")).distinct()
    return tables.stage(A.needed_corpus(ids), "needed")


@query
def corpus_lookup(spark, d):
    return texts.corpus_lookup(A.source_texts(spark, d), _needed(spark, d))


@query
def lookup_coverage(spark, d):
    return texts.lookup_coverage(_needed(spark, d), A.source_texts(spark, d))


@query
def materialised_lookup(spark, d):
    path = tables.shared_dir(spark, "lookup")
    return texts.materialised_lookup(spark, path, A.source_texts(spark, d), _needed(spark, d))


@query
def lookup_after_failure(spark, d):
    """A killed first write left rows behind and a later one was committed; then more ids are needed."""
    path = tables.shared_dir(spark, "lookup")
    corpus, needed = A.source_texts(spark, d), _needed(spark, d)
    torn = corpus.filter(F.col("benchmark") == "A").select("id", F.lit("torn").alias("title"), "text", "benchmark", "config")
    torn.write.partitionBy("benchmark", "config").parquet(f"{path}/lookup-killed")
    texts.materialised_lookup(spark, path, corpus, needed.filter(F.col("benchmark") != "R"))
    return texts.materialised_lookup(spark, path, corpus, needed, refresh_missing=True)


@query
def indexed_lookup(spark, d):
    """The corpus lookup from a stored corpus of which only some files are opened."""
    path = tables.shared_dir(spark, "index")
    corpus_index.build_index(spark, path, A.source_texts(spark, d), rows_per_file=1000)
    return corpus_index.indexed_lookup(spark, path, _needed(spark, d))


@query
def missing_ids(spark, d):
    return texts.missing_ids(_needed(spark, d), A.source_texts(spark, d))


def _reloaded(spark: SparkSession, d: str) -> DataFrame:
    """Discarded records are loaded again, twice each, and pending ones also under new ids."""
    old = A.records(spark, d)
    again = old.filter(F.col("status") == "discarded")
    fresh = (old.filter(F.col("status") == "pending")
             .withColumn("record_id", F.concat(F.lit("new_"), "record_id")))
    versions = [again.withColumns({"status": F.lit("pending"), "benchmark": F.lit("stale"), "version": F.lit(1)}),
                again.withColumns({"status": F.lit("pending"), "benchmark": F.lit("rerun"), "version": F.lit(2)}),
                fresh.withColumn("version", F.lit(1))]
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


@query
def upsert_records(spark, d):
    return tables.upsert(A.records(spark, d), _reloaded(spark, d), "version").drop("version")


@query
def upsert_bucketed(spark, d):
    """The same into a stored table, in two upserts."""
    path = tables.shared_dir(spark, "buckets")
    new = _reloaded(spark, d)
    buckets.create_bucketed(spark, path, A.records(spark, d).withColumn("version", F.lit(0)), "record_id", "version",
                            rows_per_bucket=2000)
    buckets.upsert_bucketed(spark, path, new.filter(F.col("version") == 1), "version")
    buckets.upsert_bucketed(spark, path, new, "version")
    return buckets.read_bucketed(spark, path).drop("version")


def _snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Records with nested responses as JSON lines. Pending ones have no external id, discarded
    ones no metadata; values are wrapped in every second response and bare in the others."""
    path = tables.shared_dir(spark, "snapshot")
    rec = A.records(spark, d)
    odd = F.col("seq") % 2 == 1

    def stored(value: str) -> Column:
        bare = F.to_json(value) if value == "error_categories" else F.col(value)
        wrapped = F.to_json(F.struct(F.col(value).alias("value")), {"ignoreNullFields": "false"})
        return F.when(odd, wrapped).otherwise(bare)

    values = F.create_map(*[c for k, v in (("quality_score", "quality_score"), ("corrected_text_sr", "corrected_text"),
                                           ("error_categories", "error_categories")) for c in (F.lit(k), stored(v))])
    answers = (A.responses(spark, d)
               .select("record_id", F.struct(F.col("response_id").alias("id"), "user_id", "status",
                                             values.alias("values")).alias("r"))
               .groupBy("record_id").agg(F.collect_list("r").alias("responses")))
    pending, gone = F.col("status") == "pending", F.col("status") == "discarded"
    (rec.join(answers, "record_id", "left").select(
        F.when(pending, F.col("record_id")).otherwise(F.concat(F.lit("int_"), "record_id")).alias("id"),
        F.when(~pending, F.col("record_id")).alias("external_id"), "status",
        F.create_map(F.lit("source_text_en"), "source_text", F.lit("translated_text_sr"), "target_text").alias("fields"),
        F.when(~gone, F.create_map(F.lit("benchmark"), "benchmark", F.lit("record_type"), "record_type",
                                   F.lit("task_id"), "task_id")).alias("metadata"), "responses")
     .write.option("compression", "gzip").json(path))
    return snapshot.read_snapshot(spark, path)


@query
def snapshot_records(spark, d):
    return snapshot.snapshot_records(_snapshot(spark, d))


@query
def snapshot_responses(spark, d):
    return snapshot.snapshot_responses(_snapshot(spark, d)) \
        .select("response_id", "record_id", "user_id", "status", "quality_score",
                joined("error_categories"), "corrected_text")


@query
def category_values(spark, d):
    return snapshot.category_values(snapshot.snapshot_responses(_snapshot(spark, d)))


@query
def read_texts(spark, d):
    """Documents as JSON lines, then the shorter ones again in a later file; the last row of an id wins."""
    path = tables.shared_dir(spark, "texts")
    doc = A.table(spark, d, "documents").select(F.col("doc_id").alias("_id"), F.col("source").alias("title"), "text", "n_chars")
    (doc.withColumn("part", F.lit(1)).unionByName(
        doc.filter(F.col("n_chars") < 800).withColumns({"text": F.reverse("text"), "part": F.lit(2)}))
     .drop("n_chars").repartitionByRange("part", "_id").sortWithinPartitions("part", "_id").write.partitionBy("part").json(path))
    found, _ = texts.read_texts(spark, {("b", "corpus"): path}, "json")
    return texts.latest_texts(found).drop("seq")


@query
def read_relevance(spark, d):
    """Pairs and lists: orders of the flag R come as lists, the others as pairs."""
    path = tables.shared_dir(spark, "relevance")
    flat = A.relevance(spark, d)
    lists = assemble.relevance_lists(flat.filter(F.col("benchmark") == "R")).select(
        F.concat_ws(":", "benchmark", "query_id").alias("query-id"), F.col("positive_ids").alias("positive-corpus-ids"))
    pairs = flat.filter(F.col("benchmark") != "R").select(
        F.concat_ws(":", "benchmark", "query_id").alias("query-id"), F.col("corpus_id").alias("corpus-id"), "seq")
    pairs.repartition(8, "query-id").sortWithinPartitions("seq").drop("seq").write.parquet(f"{path}/pairs")
    lists.write.parquet(f"{path}/lists")
    both = texts.read_relevance(spark, "b", f"{path}/pairs").unionByName(
        texts.read_relevance(spark, "b", f"{path}/lists"))
    return assemble.relevance_lists(both).select("query_id", joined("positive_ids"))


@query
def round_trip(spark, d):
    """Records written in each mode and as JSON lines, read back from there."""
    path = tables.shared_dir(spark, "modes")
    rec = A.records(spark, d)
    done, rest = rec.filter(F.col("status") != "pending"), rec.filter(F.col("status") == "pending")
    tables.write_table(rest, f"{path}/t", "create")
    tables.write_table(done, f"{path}/t", "recreate")
    tables.write_table(rest, f"{path}/t", "keep")
    tables.write_table(rest, f"{path}/t", "append")
    tables.write_jsonl(spark.read.schema(rec.schema).parquet(f"{path}/t"), f"{path}/j", drop=("task_id",))
    return spark.read.schema(rec.drop("task_id").schema).json(f"{path}/j")


@query
def one_benchmark(spark, d):
    name = A.benchmarks(spark, d).agg(F.min("benchmark")).first()[0]
    return tables.only_benchmark(A.records(spark, d), name, A.benchmarks(spark, d)) \
        .select("record_id", "benchmark", "source_text")


# ---- facts ----

@query
def annotation_facts(spark, d):
    return _facts(spark, d, True).withColumn("categories", joined("categories"))


@query
def annotation_newest_first(spark, d):
    """The exact place of every annotation in the report's order."""
    return facts.positioned(_facts(spark, d), *facts.newest_keys()) \
        .select("response_id", "record_id", "annotator", "date", "position")


@query
def annotation_search(spark, d):
    found = facts.search_annotations(_facts(spark, d, True), record_type="passage",
                                     flagged_only=True, query=" Grešaka ")
    return found.select("response_id", "record_id", "annotator", "benchmark", "score_text")


@query
def indexed_search(spark, d):
    """The same search by a trigram index over all texts."""
    path = tables.shared_dir(spark, "search")
    wide = tables.stage(_facts(spark, d, True), "wide", compression="zstd")
    tables.release(spark)
    records = A.records(spark, d).withColumn("target_text", TX.text_or_empty("target_text"))
    search_index.build_index(spark, path, records, wide)
    found = search_index.indexed_search(spark, path, wide, " Grešaka ", record_type="passage", flagged_only=True)
    return found.select("response_id", "record_id", "annotator", "benchmark", "score_text")


@query
def report_page(spark, d):
    """The first, the middle and the last page of the report's annotations, from a stored order."""
    path = tables.shared_dir(spark, "pages")
    ordered.write_ordered(spark, path, _facts(spark, d, True), facts.newest_keys(), rows_per_file=500)
    last = -(-ordered.row_count(spark, path) // 20)
    pages = [ordered.read_page(spark, path, n, 20).withColumn("page", F.lit(n)) for n in sorted({1, (last + 1) // 2, last})]
    out = pages[0]
    for page in pages[1:]:
        out = out.unionByName(page)
    return out.select("page", "position", "response_id", "record_id", "annotator", "date", F.md5("source_text").alias("text_key"))


@query
def annotation_sorted(spark, d):
    rows = facts.positioned(_facts(spark, d), *facts.sort_keys("score"))
    return rows.select("response_id", "record_id", "annotator", "score_text", "date", "position")


@query
def filter_choices(spark, d):
    return facts.filter_choices(_facts(spark, d))


@query
def resolve_annotators(spark, d):
    rows = facts.resolve_annotators(A.responses(spark, d, with_text=False), A.users(spark, d))
    return rows.select("response_id", "user_id", "annotator")


@query
def latest_response(spark, d):
    rows = facts.latest_response(A.calibration_responses(spark, d), ["record_id", "user_id"])
    return rows.select("record_id", "user_id", "response_id", "status")


# ---- scalars ----

@query
def format_source(spark, d):
    return A.source_texts(spark, d).select(
        "benchmark", "config", "id", "seq",
        TX.format_source("title", "text").alias("source_text"))


@query
def score_parse(spark, d):
    return A.responses(spark, d, with_text=False).select(
        "response_id", SC.score_digit("quality_score").alias("score"),
        SC.score_text("quality_score").alias("score_text"))


@query
def score_band(spark, d):
    return A.responses(spark, d, with_text=False).select(
        "response_id", SC.score_band(SC.score_digit("quality_score")).alias("band"),
        SC.quality_band("quality_score").alias("label"))


@query
def no_correction(spark, d):
    rows = A.responses(spark, d).join(A.records(spark, d).select("record_id", "target_text"),
                                      "record_id")
    return rows.select("response_id",
                       SC.uncorrected("corrected_text", "target_text").alias("uncorrected"),
                       SC.accepted_legacy("corrected_text").alias("accepted_legacy"))


@query
def flagged(spark, d):
    return _facts(spark, d).filter("flagged").select("response_id", "record_id", "annotator")


@query
def edit_distance(spark, d):
    rows = A.turn_responses(spark, d).join(
        A.turn_records(spark, d).select("record_id", "target_text"), "record_id")
    return rows.select("response_id",
                       TX.edit_distance("target_text", "corrected_text").alias("distance"))


@query
def unwrap_value(spark, d):
    """Event properties as wrapped objects, bare JSON strings and plain text."""
    k = F.get_json_object("props", "$.k")
    raw = (F.when(F.col("event_type") == "error", F.concat(F.lit('{"value": '), k, F.lit("}")))
           .when(F.col("event_type") == "view", F.concat(F.lit('{"value":"'), k, F.lit(' é"}')))
           .when(F.col("event_type") == "click", F.concat(F.lit('"'), k, F.lit('"')))
           .when(F.col("event_type") == "signup", F.lit('{"value": null}'))
           .otherwise(k))
    return A.table(spark, d, "events").select("event_id", V.unwrap_value(raw).alias("value"))


@query
def content_hash(spark, d):
    return A.records(spark, d).select(
        "record_id", TX.content_hash("source_text").alias("source_hash"),
        TX.content_hash("target_text").alias("target_hash"),
        TX.pair_hash("source_text", "target_text").alias("pair_hash"))


# ---- export ----

def _completed(spark: SparkSession, d: str) -> DataFrame:
    return export.completed_annotations(A.records(spark, d), A.responses(spark, d),
                                        A.users(spark, d))


def _exported(df: DataFrame) -> DataFrame:
    return df.withColumn("error_categories", joined("error_categories"))


@query
def export_current(spark, d):
    return _exported(export.export_annotations(_completed(spark, d)))


@query
def export_min_score(spark, d):
    return _exported(export.export_annotations(_completed(spark, d), min_score=3))


@query
def export_require_correction(spark, d):
    return _exported(export.export_annotations(_completed(spark, d), min_score=3,
                                               require_correction=True))


@query
def export_filter_counts(spark, d):
    return export.export_filter_counts(_completed(spark, d), 3, True)


@query
def export_legacy(spark, d):
    rows = export.export_legacy(A.turn_records(spark, d), A.turn_responses(spark, d),
                                A.users(spark, d), EXPORTED_AT)
    return rows.select("id", "corrected_text_sr", "quality_score", "annotator_id", "timestamp",
                       F.col("edit_metadata.was_modified").alias("was_modified"),
                       F.col("edit_metadata.edit_distance").alias("edit_distance"))


# ---- assembly ----

def _retrieval(spark: SparkSession, d: str, cap: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    needed = tables.stage(assemble.needed_passages(A.relevance(spark, d), cap), "needed")
    return needed, A.target_texts(spark, d), A.source_texts(spark, d)


@query
def assemble_pairs(spark, d):
    return assemble.assemble_pairs(*_retrieval(spark, d, 3))


@query
def pair_skips(spark, d):
    return assemble.pair_skips(*_retrieval(spark, d, 3))


@query
def build_counts(spark, d):
    return progress.build_counts(assemble.assemble_pairs(*_retrieval(spark, d, 10)))


@query
def relevance_stats(spark, d):
    return assemble.relevance_stats(A.relevance(spark, d))


@query
def relevance_lists(spark, d):
    return assemble.relevance_lists(A.relevance(spark, d)) \
        .withColumn("positive_ids", joined("positive_ids"))


@query
def relevance_chunks(spark, d):
    """Whole lists in chunks of three."""
    rows = assemble.relevance_chunks(A.relevance(spark, d), 3)
    return rows.select("benchmark", "query_id", "chunk", "first", joined("corpus_ids"))


@query
def capped_lists(spark, d):
    return assemble.capped_lists(A.relevance(spark, d), 3) \
        .withColumn("positive_ids", joined("positive_ids"))


@query
def relevance_flat(spark, d):
    """Whole lists back to rows."""
    lists = assemble.relevance_lists(A.relevance(spark, d)).withColumn("seq", F.lit(0))
    return assemble.flatten_relevance(lists)


@query
def cap_positives(spark, d):
    return assemble.cap_positives(A.relevance(spark, d), 3) \
        .select("benchmark", "query_id", "corpus_id", "position")


@query
def needed_passages(spark, d):
    return assemble.needed_passages(A.relevance(spark, d), 3)


@query
def query_pairs(spark, d):
    return assemble.query_pairs(A.query_table(spark, d, target=False),
                                A.query_table(spark, d, target=True))


@query
def passage_pairs(spark, d):
    return assemble.passage_pairs(A.bundles(spark, d, target=False),
                                  A.bundles(spark, d, target=True))


@query
def passage_pairs_list_layout(spark, d):
    return assemble.passage_pairs(A.bundles(spark, d, target=False, as_list=True),
                                  A.bundles(spark, d, target=True, as_list=True))


# ---- progress ----

@query
def benchmark_progress(spark, d):
    return progress.benchmark_progress(A.records(spark, d), A.benchmarks(spark, d))


@query
def report_benchmark_progress(spark, d):
    return progress.report_benchmark_progress(A.records(spark, d), A.benchmarks(spark, d))


@query
def annotator_progress(spark, d):
    return progress.annotator_progress(
        A.records(spark, d), A.responses(spark, d, with_text=False), A.users(spark, d))


@query
def annotator_report(spark, d):
    rows = progress.annotators_by_volume(progress.annotator_report(_facts(spark, d)))
    return rows.withColumn("avg_score", r6("avg_score"))


@query
def category_frequency(spark, d):
    return progress.category_frequency(A.records(spark, d),
                                       A.responses(spark, d, with_text=False))


@query
def category_by_annotator(spark, d):
    return progress.category_by_annotator(_facts(spark, d))


@query
def report_summary(spark, d):
    rows = progress.report_summary(A.records(spark, d), A.benchmarks(spark, d), _facts(spark, d))
    return rows.withColumn("avg_score", r6("avg_score"))


@query
def report_bundle(spark, d):
    """All tables of a report, published twice and read back from the last one, as rows (section, name, detail, value)."""
    path = tables.shared_dir(spark, "report")
    rec, marks = A.records(spark, d), A.benchmarks(spark, d)
    made = report.report_tables(rec, A.responses(spark, d), A.users(spark, d), marks)
    report.publish(spark, path, {name: df.limit(0) for name, df in made.items()})
    report.publish(spark, path, made)
    found = report.read_report(spark, path)

    def rows(section: str, name: str | None, *measures: str) -> DataFrame:
        given = F.array(*[F.struct(F.lit(m).alias("detail"), F.col(m).cast("double").alias("value")) for m in measures])
        return found[section].select(F.lit(section).alias("section"), (F.col(name) if name else F.lit("")).alias("name"),
                                     F.explode(given).alias("m")).select("section", "name", "m.*")

    parts = [rows("summary", None, "total_records", "total_done", "done_pct", "annotators", "submissions", "avg_score", "flags"),
             rows("benchmarks", "benchmark", "done", "total", "pct"),
             rows("annotators", "annotator", "total", "s1", "s2", "s3", "s4", "s5", "avg_score", "discarded", "flagged"),
             found["categories"].select(F.lit("categories").alias("section"), F.col("annotator").alias("name"),
                                        F.col("category").alias("detail"), F.col("uses").cast("double").alias("value")),
             found["choices"].select(F.lit("choices").alias("section"), F.col("facet").alias("name"),
                                     F.col("value").alias("detail"), F.lit(1.0).alias("value")),
             found["annotations"].select(F.lit("annotations").alias("section"), F.col("response_id").alias("name"),
                                         F.md5(F.concat("source_text", "correction")).alias("detail"), F.lit(1.0).alias("value"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("value", r6("value"))


def _changed(spark: SparkSession, d: str):
    """Records and responses before and after a change, and the records concerned: pending records of the first two
    sources are completed, their drafts submitted, and discarded responses on records of one event type gone."""
    rec, ans = A.records(spark, d), A.responses(spark, d, with_text=False)
    done = (F.col("status") == "pending") & F.col("benchmark").isin("src0", "src1")
    new_rec = rec.withColumn("status", F.when(done, "completed").otherwise(F.col("status")))
    new_ans = (ans.filter(F.col("status") != "discarded")
               .withColumn("quality_score", F.when(F.col("status") == "draft", "5 – x").otherwise(F.col("quality_score")))
               .withColumn("status", F.when(F.col("status") == "draft", "submitted").otherwise(F.col("status"))))
    touched = (rec.filter(done).select("record_id")
               .unionByName(ans.filter(F.col("status").isin("discarded", "draft")).select("record_id")).distinct())
    return (rec, ans), (new_rec, new_ans), tables.stage(touched, "touched")


def _counters_after(spark: SparkSession, d: str) -> DataFrame:
    before, after, touched = _changed(spark, d)
    stored = tables.stage(counters.counters(*before), "counters")
    change = counters.deltas(counters.slice_of(*before, touched), counters.slice_of(*after, touched))
    return tables.stage(counters.merge(stored, change), "counters")


@query
def progress_after_changes(spark, d):
    return counters.benchmark_progress(_counters_after(spark, d), A.benchmarks(spark, d))


@query
def annotators_after_changes(spark, d):
    return counters.annotator_progress(_counters_after(spark, d), A.users(spark, d))


@query
def access_roster(spark, d):
    return progress.access_roster(A.users(spark, d), A.members(spark, d))


@query
def legacy_completion(spark, d):
    rows = legacy.completion(A.records(spark, d), A.responses(spark, d, with_text=False))
    return rows.withColumn("completion_pct", r6("completion_pct"))


@query
def tasks_per_annotator(spark, d):
    return legacy.tasks_per_annotator(A.responses(spark, d, with_text=False), A.users(spark, d))


@query
def score_distribution(spark, d):
    rows = legacy.score_distribution(A.responses(spark, d, with_text=False))
    return rows.withColumn("pct", r6("pct"))


@query
def modification_rate(spark, d):
    rows = legacy.modification_rate(A.responses(spark, d))
    return rows.withColumns({c: r6(c) for c in ("modified_pct", "accepted_pct")})


@query
def score_by_annotator(spark, d):
    return legacy.score_by_annotator(A.responses(spark, d, with_text=False), A.users(spark, d))


@query
def dashboard_stats(spark, d):
    rows = legacy.dashboard_stats(A.records(spark, d), A.responses(spark, d))
    return rows.withColumns({c: r6(c) for c in ("completion_pct", "modification_pct")})


@query
def dashboard_per_annotator(spark, d):
    return legacy.dashboard_per_annotator(A.responses(spark, d), A.users(spark, d))


@query
def sample_annotations(spark, d):
    return legacy.sample_annotations(A.records(spark, d), A.responses(spark, d),
                                     A.users(spark, d))


# ---- agreement ----

def _ratings(spark: SparkSession, d: str) -> DataFrame:
    return tables.stage(agreement.ratings(A.calibration_responses(spark, d), A.users(spark, d)), "ratings")


@query
def pairwise_agreement(spark, d):
    rows = agreement.pairwise_agreement(_ratings(spark, d))
    return rows.withColumns({c: r6(c) for c in ("kappa", "exact_pct", "mean_diff")})


@query
def pairs_without_overlap(spark, d):
    """For the members of the workspace, each with all others."""
    asked = progress.access_roster(A.users(spark, d), A.members(spark, d)).filter("in_workspace")
    return agreement.pairs_without_overlap(_ratings(spark, d), asked.select(F.col("username").alias("annotator")))


@query
def overlap_counts(spark, d):
    return agreement.overlap_counts(_ratings(spark, d))


@query
def calibration_distribution(spark, d):
    return agreement.calibration_distribution(_ratings(spark, d)) \
        .withColumn("avg_score", r6("avg_score"))


@query
def category_agreement(spark, d):
    return agreement.category_agreement(_ratings(spark, d)) \
        .withColumn("agreement_pct", r6("agreement_pct"))


@query
def kappa_grouped(spark, d):
    """Agreement of the two label columns per language, on a two-point scale."""
    labelled = A.table(spark, d, "labels").join(
        A.table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    rated = labelled.select("lang", (F.col("quality") + 1).alias("a"),
                            (F.col("toxic") + 1).alias("b"))
    return agreement.kappa_by(rated, "a", "b", ["lang"], k=2).withColumn("kappa", r6("kappa"))


# ---- quality ----

@query
def dup_ids(spark, d):
    """Conversation turns under their conversation's id."""
    turns = A.turn_records(spark, d).withColumn("record_id", F.col("benchmark"))
    return quality.duplicate_groups(turns, "id").select("key", "copies", "first_id")


@query
def dup_source(spark, d):
    return quality.duplicate_groups(A.records(spark, d), "source")


@query
def dup_target(spark, d):
    return quality.duplicate_groups(A.records(spark, d), "target")


@query
def dup_pairs(spark, d):
    return quality.duplicate_groups(A.records(spark, d), "pair")


@query
def dup_members(spark, d):
    return quality.duplicate_members(A.records(spark, d))


@query
def dup_summary(spark, d):
    return quality.duplicate_summary(A.records(spark, d))


# ---- sampling ----

@query
def calibration_sample(spark, d):
    return sampling.calibration_records(
        sampling.calibration_sample(A.records(spark, d), A.benchmarks(spark, d), k=1))


@query
def calibration_composition(spark, d):
    return sampling.calibration_composition(sampling.calibration_records(
        sampling.calibration_sample(A.records(spark, d), A.benchmarks(spark, d), k=2, seed=7)))


@query
def empty_strata(spark, d):
    return sampling.empty_strata(A.records(spark, d), A.benchmarks(spark, d))


@query
def sample_n(spark, d):
    pairs = assemble.passage_pairs(A.bundles(spark, d, target=False),
                                   A.bundles(spark, d, target=True))
    return sampling.sample_n(pairs, "id", 100)


@query
def shuffled_order(spark, d):
    rows = sampling.shuffled_order(A.records(spark, d), "record_id")
    return rows.select("position", "record_id", "benchmark")


@query
def shuffled_table(spark, d):
    """Records written in a seeded order, read back with the place of each row in the files."""
    path = tables.shared_dir(spark, "shuffled")
    sampling.write_shuffled(spark, path, A.records(spark, d), "record_id", rows_per_file=100)
    return ordered.read_ordered(spark, path).select("position", "record_id", "benchmark", F.md5("source_text").alias("text_key"))


@query
def required_submissions(spark, d):
    return sampling.required_submissions(A.users(spark, d), A.members(spark, d))


@query
def derived_status(spark, d):
    return sampling.derived_status(A.records(spark, d), A.responses(spark, d, with_text=False),
                                   min_submitted=6)


@query
def calibration_status(spark, d):
    """Required submissions of the workspace, applied to the calibration records."""
    answers = A.calibration_responses(spark, d)
    needed = sampling.required_submissions(A.users(spark, d), A.members(spark, d))
    return sampling.derived_status(answers.select("record_id").distinct(), answers, needed)


# ---- maintenance ----

def _reopen_targets(spark: SparkSession, d: str) -> DataFrame:
    """Flagged annotations, and everybody's on discarded records."""
    bad = _facts(spark, d).filter("flagged").select("record_id", "annotator")
    everyone = (A.records(spark, d).filter(F.col("status") == "discarded")
                .select("record_id", F.lit(None).cast("string").alias("annotator")))
    return bad.unionByName(everyone)


@query
def discards_preview(spark, d):
    return maintain.discards_preview(A.responses(spark, d, with_text=False), A.users(spark, d))


@query
def discards_applied(spark, d):
    return maintain.discards_applied(A.responses(spark, d, with_text=False)) \
        .select("response_id", "record_id", "user_id", "status")


@query
def reopen_preview(spark, d):
    return maintain.reopen_preview(A.responses(spark, d, with_text=False), A.users(spark, d),
                                   _reopen_targets(spark, d))


@query
def reopen_applied(spark, d):
    return maintain.reopen_applied(A.responses(spark, d, with_text=False), A.users(spark, d),
                                   _reopen_targets(spark, d)) \
        .select("response_id", "record_id", "user_id", "status")


def _retraction_log(spark: SparkSession, d: str) -> str:
    """Version 1: all responses. 2: discarded ones retracted. 3: every fourth of all given again. 4: drafts retracted."""
    path = tables.shared_dir(spark, "retractions")
    rows = A.responses(spark, d, with_text=False).select("response_id", "record_id", "user_id", "status", "seq")
    retractions.add_responses(spark, path, rows)
    retractions.retract(spark, path, rows.filter(F.col("status") == "discarded"))
    retractions.add_responses(spark, path, rows.filter(F.col("seq") % 4 == 0).withColumn("status", F.lit("again")))
    retractions.retract(spark, path, rows.filter(F.col("status") == "draft"))
    return path


@query
def responses_as_of(spark, d):
    path = _retraction_log(spark, d)
    found = [retractions.responses_as_of(spark, path, v).withColumn("version", F.lit(v)) for v in (1, 2, 3, 4)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3]).drop("seq")


@query
def compacted(spark, d):
    """The log is compacted, then everything that was given again is retracted."""
    path = _retraction_log(spark, d)
    retractions.compact(spark, path)
    retractions.retract(spark, path, retractions.responses_as_of(spark, path).filter(F.col("status") == "again"))
    return retractions.responses_as_of(spark, path).drop("seq")
