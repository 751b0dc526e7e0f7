"""Models: held-out accuracy, codes, folds, and odd input."""

import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoloom.llm import language_id, toxicity
from annoloom.llm.queries import QUERIES, TOXIC_CHAIN


@pytest.fixture(scope="module")
def toxic(spark, sf_dir):
    return {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, sf_dir).collect()}


def test_toxic_documents(spark, sf_dir, toxic, texts):
    assert toxic.keys() == texts.keys()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    hits = [toxic[i].toxic for i, y in labels.items() if y]
    clean = [toxic[i].toxic for i, y in labels.items() if not y]
    assert np.mean(hits) > 0.8 and np.mean(clean) < 0.02
    assert all(0 <= p <= 1 for r in toxic.values() for p in (r.low_quality_prob, r.toxic_prob))


def test_toxicity_of_documents_not_learned_from(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumn("low_quality", 1 - F.col("quality"))
    learned = labels.filter("doc_id % 3 != 0")
    model = toxicity.train_chain(docs, learned, TOXIC_CHAIN)
    rest = {r.doc_id: r.toxic for r in labels.filter("doc_id % 3 = 0").collect()}
    got = [(rest[r.doc_id], r.toxic) for r in toxicity.toxicity(docs, model, TOXIC_CHAIN).collect() if r.doc_id in rest]
    assert np.mean([p for y, p in got if y]) > 0.5 and np.mean([p for y, p in got if not y]) < 0.03


def test_chain_without_or_with_one_class(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, a int, b int")
    model = toxicity.train_chain(odd, none, ("a", "b"))
    rows = toxicity.toxicity(odd, model, ("a", "b")).collect()
    assert len(rows) == odd.count() and not any(r.b or r.a_prob or r.b_prob for r in rows)
    one = spark.createDataFrame([(5, 1, None), (9, 1, 0), (12, 1, 0), (13, None, 0), (None, 1, 1)], "doc_id long, a int, b int")
    rows = toxicity.toxicity(odd, toxicity.train_chain(odd, one, ("a", "b")), ("a", "b")).collect()
    assert all(r.a_prob > 0.99 and r.b_prob < 0.01 and not r.b for r in rows)
    assert toxicity.toxicity(nothing, b"", ("a", "b")).count() == 0


def test_best_threshold():
    p, y = np.array([0.9, 0.8, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 1, 0])
    t = toxicity.best_threshold(p, y)
    assert 0.1 < t <= 0.3
    assert toxicity.best_threshold(p, np.zeros(5)) == 1.0


def test_languages_held_out(spark, sf_dir, docs):
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language_id"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == truth.keys()
    held = [r for r in rows if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_the_text_is_used(spark, docs):
    part = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2
    model = language_id.train(docs, part)
    moved = docs.select((F.col("doc_id") + 5).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    a = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    b = {r.doc_id - 5: (r.lang_pred, r.score) for r in language_id.predict(moved, model).collect()}
    assert a == b


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 9])
def test_codewords(k):
    code = language_id.codewords(k)
    assert code.shape[0] == k and set(np.unique(code)) <= {-1, 1}
    for i in range(k):
        for j in range(i):
            assert (code[i] != code[j]).sum() >= max(1, code.shape[1] // 5)
    if k > 1:
        scores = language_id.decode(5.0 * code, code, np.ones(code.shape[1]))
        assert (scores.argmax(axis=1) == np.arange(k)).all()


def test_a_wrong_bit_is_corrected():
    code = language_id.codewords(5)
    margins = 3.0 * code.astype(float)
    margins[:, 2] *= -1
    assert (language_id.decode(margins, code, np.ones(15)).argmax(axis=1) == np.arange(5)).all()


@pytest.mark.parametrize("text,letter", [("½", False), ("²³", False), ("Ⅷ", False), ("12 _ !", False), ("", False), ("½ a", True),
                                         ("ж", True), ("字", True), ("ª", True)])
def test_a_letter_is_a_letter(text, letter):
    assert language_id.has_letter(text) == letter


def test_one_id_on_very_many_rows_is_one_row_of_the_fit(spark, monkeypatch):
    """The sample bounds rows, not only ids: a third of the rows have one id, some are equal."""
    rows = [(7 if i % 3 == 0 else i, f"some words {i % 50} {'de' if i % 2 else 'en'}", "de" if i % 2 else "en") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    seen = []
    for module in (language_id, toxicity):
        monkeypatch.setattr(module, "fit_in_task", lambda features, fit: seen.append(features.count()) or b"")
    language_id.train(df, F.lit(True), sample=500)
    labels = df.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    toxicity.train_chain(df, labels, ("quality", "toxic"), sample=400)
    assert seen == [500, 400]


def test_language_odd_rows(odd, nothing):
    got = [r for r in language_id.predict(odd, b"").collect()]
    assert len(got) == odd.count() and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    model = language_id.train(odd.filter("lang = 'en'"), F.lit(True))
    assert pickle.loads(model)[0] == ["en"]
    got = {(r.doc_id, r.lang_pred) for r in language_id.predict(odd, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (9, "en"), (12, "en")} <= got
    assert language_id.train(nothing, F.lit(True)) == b""
    assert language_id.predict(nothing, model).count() == 0
