"""Column expressions on hand-made rows, one test per trap."""

import random

import pytest
from pyspark.sql import functions as F

from annoloom import schema as S
from annoloom.functions import agreement as AG
from annoloom.functions import scores as SC
from annoloom.functions import text as TX
from annoloom.functions import values as V


def column(spark, values, expr, ddl="c string"):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_strip_matches_python(spark):
    values = ["\n\t x \n", "\xa0x　", "\x1cx\x85", "", "   ", "a b", " čaša "]
    assert column(spark, values, TX.strip("c")) == [v.strip() for v in values]
    assert TX.WHITESPACE == "".join(c for c in map(chr, range(0x10000)) if c.isspace())


def test_format_source(spark):
    rows = [(" T ", " x "), (None, " x "), ("T", None), ("  ", "x"), (None, None), ("T", " ")]
    got = column(spark, rows, TX.format_source("a", "b"), "a string, b string")
    assert got == ["T\n\nx", "x", "T\n\n", "x", "", "T\n\n"]


def test_score_digit(spark):
    labels = ["1 – Potpuno netačan", " 5", "0", "9x", "n/a", "", "  ", None, "²", "٣", "-1", "4"]
    assert column(spark, labels, SC.score_digit("c")) == \
        [1, 5, 0, 9, None, None, None, None, None, None, None, 4]
    assert column(spark, labels, SC.score_text("c"))[4:8] == ["?"] * 4


def test_score_band(spark):
    got = column(spark, [0, 1, 2, 3, 4, 5, 6, None], SC.score_band("c"), "c int")
    assert got == [None, "low", "low", "medium", "high", "high", None, None]
    labels = ["1 – x", "high", "n/a", "", None, "7"]
    assert column(spark, labels, SC.quality_band("c")) == ["low", "high", "n/a", None, None, "7"]


def test_uncorrected_rules_differ_on_unchanged_text(spark):
    rows = [(" No Corrections \n", "t"), ("", "t"), (None, "t"), ("t ", " t"), ("T", "t"),
            ("no correction needed", "t"), ("Bez ispravki", "t"), ("t2", "t"), ("x" * 500, "t"),
            (None, None)]
    now = column(spark, rows, SC.uncorrected("a", "b"), "a string, b string")
    assert now == [True, True, True, True, False, True, False, False, False, True]
    old = column(spark, rows, SC.accepted_legacy("a"), "a string, b string")
    assert old == [True, True, True, False, False, False, True, False, False, True]


def test_contradiction(spark):
    rows = [(1, True, []), (2, False, [S.NO_ERROR_LABEL]), (2, False, ["Pravopis"]),
            (3, True, [S.NO_ERROR_LABEL]), (None, True, []), (1, False, None), (0, True, [])]
    got = column(spark, rows, SC.contradiction("s", "n", "c"),
                 "s int, n boolean, c array<string>")
    assert got == [True, True, False, False, False, False, True]


def naive_distance(a, b):
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        current = [i]
        for j, y in enumerate(b, 1):
            current.append(min(previous[j] + 1, current[-1] + 1, previous[j - 1] + (x != y)))
        previous = current
    return previous[-1]


def test_edit_distance_is_exact_at_every_band(spark):
    rng = random.Random(5)
    letters = "abčćžšđ é"
    pairs = [("čaša", "casa"), ("", "abc"), ("same", "same"), ("abc", "")]
    for n, edits in ((30, 3), (60, 7), (60, 20), (120, 30), (300, 9), (300, 70), (400, 390)):
        a = [rng.choice(letters) for _ in range(n)]
        b = list(a)
        for _ in range(edits):
            at = rng.randrange(len(b) or 1)
            kind = rng.randrange(3)
            if kind == 0:
                b.insert(at, rng.choice(letters))
            elif kind == 1 and b:
                b.pop(at)
            elif b:
                b[at] = rng.choice(letters)
        pairs.append(("".join(a), "".join(b)))
    got = column(spark, pairs, TX.edit_distance("a", "b"), "a string, b string")
    assert got == [naive_distance(a, b) for a, b in pairs]
    narrow = column(spark, pairs, TX.edit_distance("a", "b", bands=(2, 5)), "a string, b string")
    assert narrow == got


def test_unwrap_value(spark):
    raw = ['{"value": "x"}', '{"value": 4}', '{"value": null}', '"quoted é"', "plain", "7", None,
           '{"other": 1}', '{"value": ["a","b"]}']
    assert column(spark, raw, V.unwrap_value("c")) == [
        "x", "4", None, "quoted é", "plain", "7", None, '{"other": 1}', '["a","b"]']


def test_unwrap_categories(spark):
    raw = ['["a","b"]', '{"value": ["a"]}', "solo", '"solo"', None, '{"value": null}', "[]"]
    assert column(spark, raw, V.unwrap_categories("c")) == [
        ["a", "b"], ["a"], ["solo"], ["solo"], [], [], []]


def test_hashes_and_keys(spark):
    import hashlib

    rows = [("é\n", "b"), ("", "")]
    got = column(spark, rows, TX.pair_hash("a", "b"), "a string, b string")
    assert got == [hashlib.md5(f"{a}\0{b}".encode()).hexdigest() for a, b in rows]
    assert column(spark, rows, TX.record_key("a", "b", F.lit("7")),
                  "a string, b string")[0] == "é\n_b_7"
    assert column(spark, ["a\nb" * 60], TX.preview("c", 80)) == [("a b" * 60)[:80]]


def matrix_kappa(a, b, k=5):
    """Plain weighted kappa: the matrices written out."""
    n = len(a)
    cells = [(x, y) for x, y in zip(a, b) if 1 <= x <= k and 1 <= y <= k]
    weight = [[1 - (i - j) ** 2 / (k - 1) ** 2 for j in range(k)] for i in range(k)]
    rows = [sum(1 for x, _ in cells if x == i + 1) for i in range(k)]
    cols = [sum(1 for _, y in cells if y == i + 1) for i in range(k)]
    observed = sum(weight[x - 1][y - 1] for x, y in cells)
    expected = sum(weight[i][j] * rows[i] * cols[j] / n for i in range(k) for j in range(k))
    if expected == 0:
        return 1.0
    return None if expected == n else 1 - (n - observed) / (n - expected)


def test_kappa_matches_the_matrix_form(spark):
    rng = random.Random(11)
    cases, rows = [], []
    for g in range(300):
        n, hi = rng.randint(1, 15), rng.choice([5, 5, 5, 9])
        a = [rng.randint(1 if hi == 5 else 0, hi) for _ in range(n)]
        b = [rng.randint(1 if hi == 5 else 0, hi) for _ in range(n)]
        if g % 50 == 0:
            a, b = [1] * n, [5] * n
        if g % 50 == 1:
            a, b = [3] * n, [3] * n
        cases.append(matrix_kappa(a, b))
        rows += [(g, x, y) for x, y in zip(a, b)]
    df = (spark.createDataFrame(rows, "g int, a int, b int").groupBy("g")
          .agg(*AG.kappa_sums("a", "b")).withColumn("kappa", AG.weighted_kappa())
          .withColumn("s", AG.kappa_status()).orderBy("g"))
    for got, want in zip(df.collect(), cases, strict=True):
        assert (got["kappa"] is None) == (want is None)
        assert want is None or got["kappa"] == pytest.approx(want, abs=1e-9)
        if got["g"] % 50 == 0:
            assert (got["kappa"], got["s"]) == (1.0, "zero_expected")
        if got["g"] % 50 == 1:
            assert (got["kappa"], got["s"]) == (None, "constant_raters")


def test_kappa_band_edges(spark):
    values = [-0.3, 0.1999, 0.2, 0.4, 0.6, 0.8, 1.0, None]
    assert column(spark, values, AG.kappa_band("c"), "c double") == [
        "Poor", "Poor", "Fair", "Moderate", "Substantial", "Almost perfect", "Almost perfect",
        None]
