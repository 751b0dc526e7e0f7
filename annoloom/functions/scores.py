"""Score, correction and contradiction expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from annoloom import schema as S
from annoloom.functions.text import col, strip, text_or_empty


LOW_SCORE = 2     # a score up to this needs a correction


def score_digit(label: Column | str) -> Column:
    """Leading digit 0-9 of a score label as int, null when there is none."""
    return F.substring(strip(col(label).cast("string")), 1, 1).try_cast("int")


def score_text(label: Column | str) -> Column:
    """Leading digit of a score label, ``?`` when there is none."""
    return F.coalesce(score_digit(label).cast("string"), F.lit("?"))


def score_band(score: Column | str) -> Column:
    """low 1-2, medium 3, high 4-5, null outside that scale."""
    bands = F.array(*[F.lit(b) for b in ("low", "low", "medium", "high", "high")])
    return F.get(bands, col(score).cast("int") - 1)


def quality_band(label: Column | str) -> Column:
    """Band of a 1-5 label; any other non-empty label stays as it is."""
    return F.coalesce(score_band(score_digit(label)), F.nullif(col(label), F.lit("")))


def is_marker(text: Column,
              markers: Sequence[str] = S.NO_CORRECTION_MARKERS) -> Column:
    """Lower-cased text is a marker. A text with more bytes than the longest marker could
    take (four per character) is none, and is not lower-cased to find out."""
    longest = 4 * max(len(m) for m in markers)
    return (F.octet_length(text) <= longest) & F.lower(text).isin(*markers)


def uncorrected(corrected: Column | str, target: Column | str,
                markers: Sequence[str] = S.NO_CORRECTION_MARKERS) -> Column:
    """No correction was made: a marker text, or the machine translation unchanged."""
    text = strip(text_or_empty(corrected))
    return is_marker(text, markers) | (text == strip(text_or_empty(target)))


def accepted_legacy(corrected: Column | str,
                    markers: Sequence[str] = S.LEGACY_NO_CORRECTION_MARKERS) -> Column:
    """First-generation rule: marker texts only, an unchanged text counts as modified."""
    return is_marker(strip(text_or_empty(corrected)), markers)


def contradiction(score: Column | str, no_correction: Column | str,
                  categories: Column | str,
                  no_error_label: str = S.NO_ERROR_LABEL) -> Column:
    """Score of at most 2 although nothing was corrected or "no errors" was ticked."""
    low = F.coalesce(col(score) <= LOW_SCORE, F.lit(False))
    no_error = F.coalesce(F.array_contains(col(categories), no_error_label), F.lit(False))
    return low & (col(no_correction) | no_error)
