"""The pipeline, stage by stage, against the operators' plain versions."""

from collections import Counter

import corpus_pipeline
from annoloom.llm import decontaminate, secret_scan
from annoloom.sources import tables
from tests.llm.test_groups import plain_components
from tests.llm.test_maps import check_packing, plain_spans, word_bpe  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, sf_dir, docs, word_bpe):  # noqa: F811
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing"]
    kept, before = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = tables.stage(stage(spark, before, sf_dir), "test")
        assert after.columns == COLUMNS
        kept[name] = (rows(before), rows(after))
        before = after
    a, b = kept["quality rules"]
    assert 0.85 * len(a) < len(b) < len(a)
    a, b = kept["n-gram Jaccard join"]
    assert set(b) == {c for _, _, c in plain_components(sorted((i, r.text) for i, r in a.items()))}
    a, b = kept["benchmark decontamination"]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    exact = {i for i, r in a.items() if any(x in r.text for x in items)}
    assert exact and exact <= set(a) - set(b) and len(set(a) - set(b)) <= 1.5 * len(exact)
    a, b = kept["secret scans"]
    assert a.keys() == b.keys()
    changed = {i for i in a if a[i].text != b[i].text}
    assert {i for i in a if plain_spans(a[i].text)} <= changed
    for i in b:
        assert not plain_spans(b[i].text)
        assert b[i].n_chars == (len(b[i].text) if i in changed else a[i].n_chars)
        assert (secret_scan.MASK in b[i].text) or i not in changed
    final = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir).collect()
    check_packing(final, {i: r.text for i, r in b.items()}, word_bpe)
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in whole).keys() == b.keys()


def test_odd_rows_pass_every_stage(spark, odd, nothing, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, sf_dir).count() > 0
        assert stage(spark, nothing, sf_dir).count() == 0


def test_item_parts():
    q, a = decontaminate.question_and_answer("What is it? It is so. Yes.")
    assert q == ["what", "is", "it", "it", "is", "so"] and a == ["yes"]
    assert decontaminate.question_and_answer("") == ([], [])
