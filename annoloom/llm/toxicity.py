"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other. Each model sees the words of a document and the
probabilities that the models before it give. While a chain is trained, a later model must not see
probabilities of earlier ones for rows that these were trained on, so they come from ``FOLDS`` folds,
each predicted by a model of the others (out of fold); the models that are kept use all rows. The
threshold of the last category is the one with the best F1 on out-of-fold probabilities.

Features are the distinct words of a whole text, lower-cased, and their beginnings, hashed; each fit
keeps the ``FEATURES`` that differ most between the classes in its own training rows. Models are
logistic with an L2 penalty. They are fitted on at most ``SAMPLE`` labelled rows, in one task; all
documents are scored, in their own partitions.

Odd input: a null or empty text has no words and gets the score of the intercept. A null label is
left out for its category. A category without rows of both classes gets its share as a constant
probability. Without labelled rows all probabilities are 0 and nothing is toxic. Repeated rows are
scored alike, repeated labels of a document count by their largest values. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom.llm.rows import Memo, arrow_schema, map_texts, record_batch, slices
from annoloom.llm.sampling import bounded_sample, fit_in_task

SAMPLE = 8_000
FOLDS = 4
FEATURES = 2_000
MIN_ROWS = 4            # rows of the training part that a feature must be in
DIMENSIONS = 1 << 19
PREFIXES = (4, 5, 6, 7)
PENALTY = 2e-4
STEPS = 150
MEMO = 200_000

WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    parts = [word] + [f"{word[:n]}-" for n in PREFIXES if len(word) > n]
    return [xxhash.xxh64_intdigest(p) % DIMENSIONS for p in parts]


def distinct_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """Features of the training rows: row numbers and feature ids side by side, and each pair once."""

    def __init__(self, row: np.ndarray, feature: np.ndarray, n: int):
        self.row, self.feature, self.n = row, feature, n
        once = np.unique(row * np.int64(DIMENSIONS) + feature)
        self.pair_row, self.pair_feature = once // DIMENSIONS, once % DIMENSIONS


def choose(rows: Rows, train: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The features whose share of rows differs most between the classes, in standard errors."""
    inside = train[rows.pair_row]
    feature, positive = rows.pair_feature[inside], y[rows.pair_row[inside]] > 0
    pos = np.bincount(feature[positive], minlength=DIMENSIONS)
    every = np.bincount(feature, minlength=DIMENSIONS)
    n_pos, n = (y[train] > 0).sum(), train.sum()
    share = (every + 1) / (n + 2)
    z = (pos / n_pos - (every - pos) / max(n - n_pos, 1)) / np.sqrt(
        share * (1 - share) * (1 / n_pos + 1 / max(n - n_pos, 1)))
    z = np.where(every >= MIN_ROWS, np.abs(z), 0.0)
    best = np.argsort(-z, kind="stable")[:FEATURES]
    return np.sort(best[z[best] > 0])


def fit_logistic(rows: Rows, train: np.ndarray, y: np.ndarray, before: np.ndarray) -> tuple:
    """(features, weights, weights of the earlier probabilities, intercept) from the rows in ``train``."""
    rate = float(y[train].mean()) if train.any() else 0.0
    start = float(np.log((rate + 1e-6) / (1 - rate + 1e-6)))
    k = before.shape[1]
    if not 0 < rate < 1:
        return np.empty(0, dtype=np.int64), np.empty(0), np.zeros(k), start
    features = choose(rows, train, y)
    at = np.searchsorted(features, rows.feature)
    at[at == len(features)] = 0
    inside = train[rows.row] & (features[at] == rows.feature) if len(features) else np.zeros(len(at), dtype=bool)
    row, col = rows.row[inside], at[inside]
    own, extra, n = y[train], before[train], int(train.sum())
    number = np.cumsum(train) - 1
    row = number[row]
    scale = np.sqrt(np.bincount(row, minlength=n).max(initial=1) + k + 1.0)
    rate_of_step = 4.0 / scale ** 2 * 8
    w, e, b = np.zeros(len(features)), np.zeros(k), start
    mw, me, mb = w.copy(), e.copy(), b
    for step in range(STEPS):           # accelerated gradient steps, scaled by each feature's frequency
        z = np.bincount(row, weights=mw[col], minlength=n) + extra @ me + mb
        r = sigmoid(z) - own
        grad = np.bincount(col, weights=r[row], minlength=len(w)) / n + PENALTY * mw
        often = np.bincount(col, minlength=len(w)) / n + 10 * PENALTY
        nw = mw - rate_of_step * grad / often
        ne = me - rate_of_step * (extra.T @ r / n + PENALTY * me)
        nb = mb - rate_of_step * r.mean()
        push = step / (step + 3.0)
        mw, me, mb = nw + push * (nw - w), ne + push * (ne - e), nb + push * (nb - b)
        w, e, b = nw, ne, nb
    return features, w, e, float(b)


def scores(rows: Rows, model: tuple, before: np.ndarray) -> np.ndarray:
    features, w, e, b = model
    z = np.full(rows.n, b) + before @ e
    if len(features):
        at = np.minimum(np.searchsorted(features, rows.feature), len(features) - 1)
        hit = features[at] == rows.feature
        z += np.bincount(rows.row[hit], weights=w[at[hit]], minlength=rows.n)
    return sigmoid(z)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on F1 is best."""
    if not len(y) or not y.any():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(p[order][1:] != p[order][:-1], True)       # equal probabilities stay together
    k = int(np.argmax(np.where(last, f1, -1)))
    low = p[order][k + 1] if k + 1 < len(y) else 0.0
    return float((p[order][k] + low) / 2)


def fit_chain(table: pa.Table, categories: tuple[str, ...]) -> bytes:
    table = table.sort_by("doc_id")
    n = table.num_rows
    sizes = np.array([len(f) for f in table.column("features").to_pylist()], dtype=np.int64)
    feature = table.column("features").combine_chunks().flatten().to_numpy().astype(np.int64)
    rows = Rows(np.repeat(np.arange(n), sizes), feature, n)
    fold = np.array([xxhash.xxh64_intdigest(str(i)) % FOLDS for i in table.column("doc_id").to_pylist()])
    before = np.empty((n, 0))
    models, threshold = [], 1.0
    for name in categories:
        labels = table.column(name).to_pylist()
        known = np.array([v is not None for v in labels], dtype=bool)
        y = np.array([float(v or 0) for v in labels])
        models.append(fit_logistic(rows, known, y, before))
        outside = np.zeros(n)
        for f in range(FOLDS):
            part = fit_logistic(rows, known & (fold != f), y, before)
            outside[fold == f] = scores(rows, part, before)[fold == f]
        threshold = best_threshold(outside[known], y[known])
        before = np.column_stack([before, outside])
    return pickle.dumps((models, threshold))


def train_chain(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], sample: int = SAMPLE,
                id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A chain over the 0/1 columns ``categories`` of ``labels``, in that order.

    Of documents with one id, the one with the least text is learned from, so ``sample`` bounds the rows.
    """
    ddl = "doc_id long, features array<int>, " + ", ".join(f"{c} int" for c in categories)
    one = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")) \
        .agg(*[F.max(F.col(c).cast("int")).alias(c) for c in categories])
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))         # few rows, but long work on each
    chosen = bounded_sample(one, "doc_id", sample)          # so it may be broadcast: at most ``sample`` rows
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi") \
        .groupBy("doc_id").agg(F.min("text").alias("text")).repartition(tasks, "doc_id") \
        .join(F.broadcast(chosen), "doc_id")

    def run(batches):
        schema = arrow_schema(ddl)
        for b in slices(batches):
            ids, texts, *rest = (c.to_pylist() for c in b.columns)
            found = [np.array([f for w in sorted(distinct_words(t)) for f in word_features(w)], dtype=np.int32)
                     for t in texts]
            yield record_batch(schema, [ids, found, *rest])

    return fit_in_task(rows.mapInArrow(run, ddl), lambda table: fit_chain(table, categories))


def toxicity(docs: DataFrame, model: bytes, categories: tuple[str, ...], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The probability of every category, and whether the last one reaches its threshold.

    The last category gives the boolean column of its own name; ``<category>_prob`` are probabilities.
    """
    ddl = f"doc_id long, {categories[-1]} boolean, " + ", ".join(f"{c}_prob double" for c in categories)
    k = len(categories)

    def make():
        models, threshold = pickle.loads(model) if model else ([], 1.0)
        weights: dict[int, np.ndarray] = {}
        for i, (features, w, _, _) in enumerate(models):
            for f, x in zip(features.tolist(), w, strict=True):
                weights.setdefault(f, np.zeros(k))[i] += x
        memo, none = Memo(MEMO), np.zeros(k)

        def compute(words: list[str]) -> list[np.ndarray]:
            out = []
            for word in words:
                hit = [weights[f] for f in word_features(word) if f in weights]
                out.append(sum(hit) if hit else none)
            return out

        def fn(ids, texts):
            words = [distinct_words(t) for t in texts]
            distinct = list(set().union(*words))
            number = dict(zip(distinct, range(len(distinct)), strict=True)).__getitem__
            values = np.array(memo.values(distinct, compute)).reshape(len(distinct), k)
            z = np.zeros((len(texts), k))
            for i, ws in enumerate(words):
                if ws:
                    z[i] = values[np.fromiter(map(number, ws), dtype=np.int64, count=len(ws))].sum(axis=0)
            p = np.zeros((len(texts), k))
            for c, (_, _, e, b) in enumerate(models):
                p[:, c] = sigmoid(z[:, c] + p[:, :c] @ e + b)
            return [ids, p[:, -1] >= threshold if models else [False] * len(ids), *p.T]
        return fn

    return map_texts(docs, ddl, make, id_col, text_col)
