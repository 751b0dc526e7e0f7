"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary linear classifier over hashed character
n-grams tells the languages with a 1 from those with a 0. Decoding adds, over the bits, a logistic loss
of the classifier's margin against the codeword, weighted by how far the classifier's own loss on its
training rows stays below chance; the codeword with the least loss is the language. Up to five
languages the code is the exhaustive one; beyond that it is the best of some seeded random codes by
the least distance between codewords. Where the runner-up is close, the row is flagged as ambiguous.

Classifiers are fitted on at most ``SAMPLE`` labelled rows, in one task, over whole texts. Text is the
only input of a prediction.

Odd input: a null text, or one without a letter, is ``und`` with score 0. Rows without a language or an
id are not learned from. Of one learned language, every text with a letter is that language. Without
any, everything is ``und``. Repeated rows are predicted alike. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoloom.llm.rows import arrow_schema, map_texts, record_batch, slices
from annoloom.llm.sampling import bounded_sample, fit_in_task

UNKNOWN = "und"
SAMPLE = 4_000
DIMENSIONS = 4096
GRAMS = (1, 2, 3)
EXHAUSTIVE = 5          # languages up to which all bits are used
STEPS = 200
PENALTY = 1e-3
AMBIGUOUS = 0.2         # lead in score under which a prediction is flagged

LETTER = re.compile(r"[^\W\d_]")         # letters, and some numbers that are none
SCHEMA = "doc_id long, lang_pred string, score double, ambiguous boolean"


def codewords(k: int) -> np.ndarray:
    """k rows of +1 and -1."""
    if k <= EXHAUSTIVE:
        columns = np.arange(2 ** (k - 1) - 1)
        code = np.ones((k, len(columns)), dtype=np.int8)
        for row in range(1, k):         # all splits into two parts, each once
            code[row] = np.where(columns >> (row - 1) & 1, 1, -1)
        return code
    bits = int(np.ceil(10 * np.log2(k)))
    draw, best, least = np.random.default_rng(7), None, -1
    for _ in range(100):
        code = draw.choice(np.array([-1, 1], dtype=np.int8), size=(k, bits))
        code = code[:, np.abs(code.sum(axis=0)) < k]
        product = code.astype(int) @ code.T.astype(int)
        np.fill_diagonal(product, -code.shape[1])
        distance = (code.shape[1] - product.max()) // 2
        if distance > least:
            best, least = code, distance
    return best


def histogram(text: str) -> np.ndarray:
    """Shares of the hashed character n-grams of a whole text; runs of other characters are a blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype(np.uint32)
    blank = (codes < 97) | ((codes > 122) & (codes < 0xAA)) | ((codes >= 0x2000) & (codes < 0x2070))
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    codes = np.where(blank, np.uint32(0), codes)[keep]
    out = np.zeros(DIMENSIONS)
    key = np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, max(GRAMS) + 1):
        key = (key[:-1] if n > 1 else key) * np.uint32(0x01000193) + codes[n - 1:] * np.uint32(0x9E3779B1)
        if n > len(codes):
            break
        if n in GRAMS:
            cell = (key + np.uint32(n)) * np.uint32(0x85EBCA6B) >> np.uint32(20)
            out += np.bincount(cell, minlength=DIMENSIONS) / len(cell)
    return out


def fit_codes(table: pa.Table) -> bytes:
    """Codewords and one linear classifier per bit."""
    table = table.sort_by("doc_id")
    langs = sorted(set(table.column("lang").to_pylist()))
    x = np.frombuffer(b"".join(table.column("histogram").to_pylist()), "<f4").reshape(-1, DIMENSIONS)
    which = np.array([langs.index(v) for v in table.column("lang").to_pylist()])
    code = codewords(len(langs))
    if len(langs) < 2:
        return pickle.dumps((langs, code, np.zeros((DIMENSIONS, code.shape[1])), np.zeros(code.shape[1]),
                             np.ones(code.shape[1])))
    mean, spread = x.mean(axis=0), x.std(axis=0)
    scale = np.where(spread > 0, 1 / np.maximum(spread, 1e-4), 0.0)
    x = ((x - mean) * scale).astype(np.float32)
    target = code[which].astype(np.float32)
    # each language counts the same in every bit
    weight = (1.0 / np.bincount(which, minlength=len(langs)))[which][:, None].astype(np.float32) / len(langs)
    top = np.ones(DIMENSIONS, dtype=np.float32)
    for _ in range(8):                                      # the largest curvature, for the step
        top = x.T @ (weight[:, 0] * (x @ top))
        norm = np.linalg.norm(top)
        top /= norm
    step = 4.0 / (norm + 4 * PENALTY)
    w, b = np.zeros((DIMENSIONS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m, old = w.copy(), w.copy()
    for t in range(STEPS):
        margin = target * (x @ m + b)
        r = -target * weight / (1 + np.exp(np.clip(margin, -30, 30)))
        w = m - step * (x.T @ r + PENALTY * m)
        b = b - r.sum(axis=0)
        m, old = w + t / (t + 3) * (w - old), w
    loss = (weight * np.log1p(np.exp(-np.clip(target * (x @ w + b), -30, 30)))).sum(axis=0)
    trust = np.maximum(1 - loss / np.log(2), 0.01)
    folded = w * scale[:, None]
    return pickle.dumps((langs, code, folded, b - mean @ folded, trust))


def decode(margins: np.ndarray, code: np.ndarray, trust: np.ndarray) -> np.ndarray:
    """Probability-like scores of the languages: softmax of minus the weighted loss."""
    loss = np.log1p(np.exp(-np.clip(margins[:, None, :] * code[None], -30, 30))) @ trust
    e = np.exp(loss.min(axis=1, keepdims=True) - loss)
    return e / e.sum(axis=1, keepdims=True)


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def train(docs: DataFrame, learned: Column, sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> bytes:
    """A model from the rows where ``learned`` holds and text, language and id are not null.

    Of rows with one id, the one with the least language and text is learned from, so ``sample`` bounds the rows.
    """
    ddl = "doc_id long, lang string, histogram binary"
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    usable = learned & F.col(id_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & F.col(lang_col).isNotNull()
    ids = bounded_sample(docs.filter(usable).select(F.col(id_col).cast("long").alias("doc_id")).distinct(),
                         "doc_id", sample)
    rows = (docs.filter(usable).select(F.col(id_col).cast("long").alias("doc_id"),
                                       F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .join(F.broadcast(ids), "doc_id", "left_semi")      # at most ``sample`` ids
            .groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r")).select("doc_id", "r.lang", "r.text")
            .repartition(tasks, "doc_id"))                      # few rows, but long work on each

    def run(batches):
        schema = arrow_schema(ddl)
        for b in slices(batches):
            found = [histogram(t).astype("<f4").tobytes() for t in b.column(2).to_pylist()]
            yield record_batch(schema, [b.column(0), b.column(1), found])

    return fit_in_task(rows.mapInArrow(run, ddl), fit_codes)


def predict(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def make():
        langs, code, w, b, trust = pickle.loads(model) if model else ([], None, None, None, None)

        def fn(ids, texts):
            real = [i for i, t in enumerate(texts) if t and has_letter(t)] if langs else []
            pred, score, close = [UNKNOWN] * len(ids), [0.0] * len(ids), [False] * len(ids)
            if real:
                p = decode(np.array([histogram(texts[i]) for i in real]) @ w + b, code, trust)
                best = p.argmax(axis=1)
                rest = np.sort(p, axis=1)
                lead = rest[:, -1] - (rest[:, -2] if len(langs) > 1 else 0.0)
                for i, k, row, d in zip(real, best, p, lead, strict=True):
                    pred[i], score[i], close[i] = langs[k], float(row[k]), bool(d < AMBIGUOUS)
            return [ids, pred, score, close]
        return fn

    return map_texts(docs, SCHEMA, make, id_col, text_col)
