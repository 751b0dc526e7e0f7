"""Quadratic weighted kappa as plain aggregate expressions.

For a k-point scale with weights ``1 - ((i - j) / (k - 1))^2`` both the observed and the
expected weighted sums depend on the ratings only through their counts, sums and sums of
squares. One ordinary aggregation therefore gives kappa for any grouping, with map-side
partial sums and without building a k x k matrix per group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from annoloom.functions.text import col


def kappa_sums(a: Column | str, b: Column | str, k: int = 5) -> list[Column]:
    """Aggregates over rows where both ratings are present, names ``k_*``.

    All rows count in ``k_n``; only rows with both ratings in 1..k enter the others.
    """
    x, y = col(a).cast("long"), col(b).cast("long")
    on_scale = x.between(1, k) & y.between(1, k)
    total = lambda v: F.coalesce(F.sum(F.when(on_scale, v)), F.lit(0))
    return [
        F.count(F.lit(1)).alias("k_n"),
        F.count_if(on_scale).alias("k_m"),
        total(x).alias("k_a"),
        total(y).alias("k_b"),
        total(x * x).alias("k_aa"),
        total(y * y).alias("k_bb"),
        total((x - y) * (x - y)).alias("k_d"),
    ]


def kappa_parts(k: int = 5) -> tuple[Column, Column]:
    """(observed, expected) weighted sums over the columns of :func:`kappa_sums`.

    The bracket of the expected sum stays in whole numbers, so "exactly zero" is exact.
    """
    w = F.lit((k - 1) ** 2)
    m, a, b, aa, bb = (F.col(c).cast("decimal(18,0)")
                       for c in ("k_m", "k_a", "k_b", "k_aa", "k_bb"))
    observed = F.col("k_m") - F.col("k_d") / w
    bracket = m * m * w - m * aa - m * bb + F.lit(2) * a * b
    expected = F.try_divide(bracket.cast("double"), w * F.col("k_n"))
    return observed, expected


def weighted_kappa(k: int = 5) -> Column:
    """Kappa over :func:`kappa_sums` columns.

    1.0 when no weighted agreement is expected at all; null for no rows and for two
    raters that always give the same one score, where kappa is undefined.
    """
    observed, expected = kappa_parts(k)
    n = F.col("k_n")
    return (F.when(expected == 0, F.lit(1.0))
            .otherwise(F.lit(1.0) - F.try_divide(n - observed, n - expected)))


def kappa_status(k: int = 5) -> Column:
    """``ok``, ``zero_expected`` (reported as 1.0) or ``constant_raters`` (null)."""
    _, expected = kappa_parts(k)
    return (F.when(F.col("k_n") == 0, "no_rows")
            .when(expected == 0, "zero_expected")
            .when(expected == F.col("k_n"), "constant_raters")
            .otherwise("ok"))


def kappa_band(kappa: Column | str) -> Column:
    """Poor, Fair, Moderate, Substantial or Almost perfect."""
    v = F.round(col(kappa), 12)
    return (F.when(v < 0.20, "Poor").when(v < 0.40, "Fair").when(v < 0.60, "Moderate")
            .when(v < 0.80, "Substantial").when(v.isNotNull(), "Almost perfect"))
