"""Text expressions: strip, source formatting, keys, hashes, edit distance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when stripping text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    """Null text is empty text everywhere in this data model."""
    return F.coalesce(col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim all Unicode white space (plain ``trim`` removes spaces only)."""
    return F.trim(col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return strip(text_or_empty(c)) == ""


def format_source(title: Column | str, text: Column | str) -> Column:
    """``title``, a blank line and ``text``; just ``text`` when the title is blank."""
    head = strip(text_or_empty(title))
    body = strip(text_or_empty(text))
    return F.when(head != "", F.concat(head, F.lit("\n\n"), body)).otherwise(body)


def task_key(record_type: Column | str, item_id: Column | str) -> Column:
    return F.concat_ws("_", col(record_type), col(item_id))


def record_key(benchmark: Column | str, record_type: Column | str,
               item_id: Column | str) -> Column:
    return F.concat_ws("_", col(benchmark), col(record_type), col(item_id))


def content_hash(c: Column | str) -> Column:
    return F.md5(text_or_empty(c))


def pair_hash(source: Column | str, target: Column | str) -> Column:
    return F.md5(F.concat(text_or_empty(source), F.lit("\x00"), text_or_empty(target)))


def preview(c: Column | str, length: int) -> Column:
    """First ``length`` characters on one line."""
    return F.translate(F.substring(col(c), 1, length), "\n", " ")


def seeded_key(item_id: Column | str, seed: int) -> Column:
    """Repeatable pseudo-random sort key, the same on every run and cluster."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col(item_id).cast("string")))


def edit_distance(left: Column | str, right: Column | str,
                  bands: tuple[int, ...] = (8, 64, 512)) -> Column:
    """Exact Levenshtein distance, cheap when the texts are close.

    With a threshold Spark walks only a band around the diagonal and answers -1 past
    it, so a long text with a local correction costs (band x length) instead of
    (length x length). Each band that answers is exact; only pairs further apart than
    the widest band pay for the whole matrix. A band that would cover the matrix of a
    short text anyway is skipped.
    """
    lt, rt = col(left), col(right)
    whole = F.levenshtein(lt, rt)
    shorter = F.least(F.char_length(lt), F.char_length(rt))
    distance = whole
    for band in sorted(bands, reverse=True):
        banded = _else_if_negative(F.levenshtein(lt, rt, band), distance)
        distance = F.when(shorter <= 4 * band, whole).otherwise(banded)
    return F.when(lt == rt, 0).otherwise(distance)


def _else_if_negative(value: Column, other: Column) -> Column:
    """``value``, or ``other`` where it is negative. A one-element array binds the value
    to a name, so that it is computed once."""
    chosen = F.transform(F.array(value), lambda v: F.when(v >= 0, v).otherwise(other))
    return F.get(chosen, F.lit(0))


def common_length(a: Column, b: Column, most: Column, part: Callable[[Column, Column], Column] = F.left) -> Column:
    """The greatest n up to ``most`` for which ``part`` (``F.left`` or ``F.right``) of n characters is the same of both.

    Halving steps: the texts are compared once for each power of two up to ``most``.
    """
    steps = F.array(*[F.lit(1 << i) for i in range(30, -1, -1)])

    def longest(limit: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
            (step <= limit - n) & (part(a, n + step) == part(b, n + step)), n + step).otherwise(n))

    return F.get(F.transform(F.array(most), longest), F.lit(0))


def edit_of(text: Column, base: Column) -> Column:
    """``text`` as an edit of ``base``: struct (front, back, middle), what both share in front and at the back as numbers
    of characters, and what stands between. Any text has one; :func:`edited` gives the text back."""
    shorter = F.least(F.char_length(text), F.char_length(base))
    with_front = F.transform(F.array(common_length(text, base, shorter)), lambda front: F.struct(
        front.alias("front"), common_length(text, base, shorter - front, F.right).alias("back")))
    apart = F.get(F.transform(with_front, lambda e: F.struct(
        e["front"].alias("front"), e["back"].alias("back"),
        F.substring(text, e["front"] + 1, F.char_length(text) - e["front"] - e["back"]).alias("middle"))), F.lit(0))
    size = F.char_length(base)
    longer = F.struct(size.alias("front"), F.lit(0).alias("back"), F.substr(text, size + 1).alias("middle"))
    none = F.struct(F.lit(0).alias("front"), F.lit(0).alias("back"), F.lit("").alias("middle"))
    return F.when(text == "", none).when(F.startswith(text, base), longer).otherwise(apart)


def edited(edit: Column, base: Column) -> Column:
    """The text that :func:`edit_of` made ``edit`` of."""
    return F.concat(F.left(base, edit["front"]), edit["middle"], F.right(base, edit["back"]))
