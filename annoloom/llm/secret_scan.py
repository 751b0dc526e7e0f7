"""Secret scans with DataFrame functions only.

Three patterns give the base spans (assignments, access keys, long hex runs). Beside them, candidate
strings of key-like characters are scored by the Shannon entropy of a sliding window. The state of the window is the
count of each of the ``ALPHABET``'s characters in it and ``sum(c * log2 c)`` over these counts; a step of the window
changes both only for the character that leaves and the one that enters, and no window is counted anew. Long runs are
walked in parts that overlap by a window, so time is linear in the length of a run.
Each character class has its own threshold. Base spans, and what the allow-list knows (identifiers, words,
placeholders, each between ``/`` and ``=``; digests that are named as such, whole), are cut out of the runs
first; each piece of at least ``WINDOW`` characters that remains is a candidate of its own. Shorter
pieces have no window and are not scored.

Positions are code points. A pattern is applied once to extract matches and once to split the text
at them; the lengths of both give the positions, summed up in blocks of matches, so that many matches do not cost the
square of their number.

Odd input: a null text is empty and has no spans. Repeated rows get equal results. An empty table gives
an empty result. Helper columns have names of their own and are dropped, so other columns may
have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
#: kind -> pattern, group that must be long enough, its least length
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    # runs of these are matched as far as they go, so a least length in the pattern keeps the same ones
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: Cheap tests for texts without a match.
HINTS = {"assign": r"(?i)(?:passw|secret|token|api_?key)", "access": r"AKIA", "hex": r"[0-9a-f]{16}"}
WINDOW = 20
#: Runs that may be keys: a digit and a letter anywhere, in one pass of the run for each.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
#: Least entropy in bits of some window, by class; the first class whose pattern fits counts.
CLASSES = (("hex", r"^[0-9a-fA-F]+$", 3.2), ("alphanumeric", r"^[A-Za-z0-9]+$", 3.7), ("base64", "", 3.9))
#: Whole runs: digests named as such.
DIGEST = r"(?i)^(sha|md5|sha1|sha256|sha384|sha512)[-_=][A-Za-z0-9+/]+=*$"
#: Segments of a run between ``/`` and ``=``.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",           # UUIDs
    r"(?i)(example|placeholder|changeme|your[-_]|xxxx|dummy|sample)",   # placeholders
    r"^[A-Za-z]{3,}([-_][A-Za-z]*[0-9]{0,4})+$",                        # words with numbers
    r"^([A-Z]?[a-z]{2,}|[A-Z]{3,})[0-9]{0,4}$",                         # one word, as in paths
    r"^[0-9]+([-_][0-9]+)*$",                                           # numbers and dates
    r"(?i)^(https?|www|data|file)[_-]",                                 # addresses
)
MASK = "[SECRET]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"       # of candidates
PART = 1000             # characters of a run that are walked together
BLOCK = 256             # matches whose positions are summed up together


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: the variable of a lambda, not an expression to repeat."""
    return F.get(F.transform(F.array(value), body), 0)


def placed(rows: Column, width: Callable[[Column], Column], make: Callable[[Column, Column], Column], ddl: str) -> Column:
    """All of ``make(row, start)``, arrays of ``ddl``, where ``start`` is the sum of the widths of the rows before."""
    empty = F.array().cast(f"array<{ddl}>")

    def in_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, r: a + width(r)))
        starts = F.aggregate(totals, F.array(F.lit(0).cast("long")), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t)))
        return let(starts, lambda at: F.flatten(F.transform(blocks, lambda b, j: F.aggregate(
            b, F.struct(F.get(at, j).alias("at"), empty.alias("found")),
            lambda a, r: F.struct((a["at"] + width(r)).alias("at"), F.concat(a["found"], make(r, a["at"])).alias("found")))["found"])))

    return let(rows, lambda r: let(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(r) - 1) / BLOCK).cast("int")), lambda j: F.slice(r, j * BLOCK + 1, BLOCK)), in_blocks))


def found_spans(text: Column, kind: str) -> Column:
    """array<struct<start, kind, end>> of one base kind; ``start`` from 0, ``end`` exclusive."""
    pattern, group, least = BASE[kind]
    lengths = (lambda a: F.transform(a, lambda x: F.length(x).cast("long")))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    rows = F.arrays_zip(lengths(F.split(text, pattern, -1)).alias("gap"), lengths(matches).alias("size"),
                        lengths(values).alias("value"))
    ddl = "struct<start:bigint,kind:int,end:bigint>"
    empty = F.array().cast(f"array<{ddl}>")
    spans = placed(
        rows, lambda r: r["gap"] + F.coalesce(r["size"], F.lit(0)),
        lambda r, at: F.when(r["value"] >= least, F.array(F.struct(
            (at + r["gap"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (at + r["gap"] + r["size"]).alias("end"))))
        .otherwise(empty), ddl)
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(empty)


def candidate_spans(text: Column) -> Column:
    """array<struct<start, value>> of the runs that may be keys."""
    matches = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    rows = F.arrays_zip(F.transform(F.split(text, CANDIDATE, -1), lambda g: F.length(g).cast("long")).alias("gap"),
                        matches.alias("value"))
    ddl = "struct<start:bigint,value:string>"
    empty = F.array().cast(f"array<{ddl}>")
    spans = placed(
        rows, lambda r: r["gap"] + F.coalesce(F.length(r["value"]), F.lit(0)),
        lambda r, at: F.when(r["value"].isNotNull(), F.array(F.struct((at + r["gap"]).alias("start"), r["value"].alias("value"))))
        .otherwise(empty), ddl)
    return F.when(text.rlike(r"[A-Za-z0-9+/_=-]{20}"), spans).otherwise(empty)


def least_total(part: Column, window: int) -> Column:
    """The least ``sum(c * log2 c)`` of any ``window`` consecutive characters of a string over the ``ALPHABET``.

    The counts are one string with a character for each of the alphabet's: ``0`` and the characters after it.
    """
    terms = F.array(*[F.lit(0.0 if c < 2 else c * log2(c)) for c in range(window + 2)])
    zero = ord("0")

    def term(c: Column) -> Column:
        return F.element_at(terms, (c + 1).cast("int"))

    def count(counts: Column, slot: Column) -> Column:
        return F.ascii(F.substring(counts, slot, F.lit(1))) - zero

    def put(counts: Column, slot: Column, c: Column) -> Column:
        return F.overlay(counts, F.char((c + zero).cast("long")), slot, F.lit(1))

    def walk(slots: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            entering, leaving = F.element_at(slots, i), F.element_at(slots, F.greatest(i - window, F.lit(1)))
            full = i > window
            gone = count(a["counts"], leaving)
            rest = F.when(full, put(a["counts"], leaving, gone - 1)).otherwise(a["counts"])
            here = count(rest, entering)
            total = (a["total"] + F.when(full, term(gone - 1) - term(gone)).otherwise(0.0) + term(here + 1) - term(here))
            return F.struct(put(rest, entering, here + 1).alias("counts"), total.alias("total"),
                            F.when((i >= window) & (total < a["least"]), total).otherwise(a["least"]).alias("least"))

        start = F.struct(F.lit("0" * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"), F.lit(1e9).alias("least"))
        return F.aggregate(F.sequence(F.lit(1), F.size(slots)), start, step)["least"]

    return let(F.transform(F.split(part, ""), lambda c: F.position(c, F.lit(ALPHABET))), walk)


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy, in bits, of any ``window`` consecutive characters of a candidate."""
    parts = F.regexp_extract_all(value, F.lit(f".{{1,{PART}}}"), F.lit(0))
    least = let(parts, lambda p: F.array_min(F.transform(p, lambda x, i: least_total(
        F.concat(x, F.substring(F.coalesce(F.get(p, i + 1), F.lit("")), F.lit(1), F.lit(window - 1))), window))))
    return F.when(F.length(value) >= window, F.log2(F.lit(float(window))) - least / window).otherwise(F.lit(0.0))


def is_secret(value: Column) -> Column:
    """Whether a candidate's entropy is that of a key."""
    threshold = F.lit(CLASSES[-1][2])
    for _, pattern, least in reversed(CLASSES[:-1]):
        threshold = F.when(value.rlike(pattern), F.lit(least)).otherwise(threshold)
    return window_entropy(value) >= threshold


def blanks(size: Column) -> Column:
    return F.repeat(F.lit(" "), size.cast("int"))


def without_spans(text: Column, spans: str) -> Column:
    """The text with blanks in place of the spans, so that all positions stay."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, start,
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"),
                                           F.greatest(s["start"] - a["at"], F.lit(0)).cast("int")),
                     blanks(s["end"] - F.greatest(s["start"], a["at"]))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))


def without_allowed(run: Column) -> Column:
    """The run with blanks in place of what the allow-list knows."""
    def kept(segment: Column) -> Column:
        own = F.regexp_replace(segment, "[/=]$", "")
        known = F.lit(False)
        for pattern in ALLOWED:
            known = known | own.rlike(pattern)
        return F.when(known, blanks(F.length(segment))).otherwise(segment)

    segments = F.split(run, "(?<=[/=])", -1)
    return F.when(run.rlike(DIGEST), blanks(F.length(run))).otherwise(F.array_join(F.transform(segments, kept), ""))


def with_spans(docs: DataFrame, text_col: str = "text", prefix: str = "_secret_") -> DataFrame:
    """The rows with ``<prefix>base`` and ``<prefix>spans``: arrays of (start, kind, end), in order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base, rest, runs, candidates, spans = (f"{prefix}{c}" for c in ("base", "rest", "runs", "candidates", "spans"))
    out = docs.withColumn(base, F.array_sort(F.concat(*[found_spans(text, k) for k in BASE])))
    out = out.withColumn(rest, F.when(F.size(base) > 0, without_spans(text, base)).otherwise(text))
    out = out.withColumn(runs, candidate_spans(F.col(rest))).drop(rest)
    pieces = F.flatten(F.transform(runs, lambda r: F.transform(
        candidate_spans(without_allowed(r["value"])),
        lambda p: F.struct((r["start"] + p["start"]).alias("start"), p["value"].alias("value")))))
    out = out.withColumn(candidates, F.when(F.size(runs) > 0, pieces).otherwise(F.col(runs)))
    extra = F.transform(F.filter(candidates, lambda c: is_secret(c["value"])), lambda c: F.struct(
        c["start"].alias("start"), F.lit(KINDS.index("entropy")).alias("kind"),
        (c["start"] + F.length(c["value"])).cast("long").alias("end")))
    return (out.withColumn(spans, F.when(F.size(candidates) == 0, F.col(base))
                           .otherwise(F.array_sort(F.concat(base, extra)))).drop(candidates, runs))


def listed(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans and the list of all spans, per document."""
    found = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))

    def n(kind: str) -> Column:
        return F.size(F.filter("_secret_base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(listed("_secret_base"), 256).alias("base_sha256"), listed("_secret_spans").alias("spans"),
        F.size(F.filter("_secret_spans", lambda s: s["kind"] == KINDS.index("entropy"))).cast("long")
        .alias("n_entropy"))


def redact(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The same rows with every span replaced by a mask, and ``size_col`` as the new length."""
    prefix = "_secret_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    spans = f"{prefix}spans"
    found = with_spans(docs, text_col, prefix)
    text = F.col(text_col)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(
        spans, start,
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(
                a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                F.lit(MASK))).otherwise(a["out"]).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    clean, masked = F.when(F.size(spans) > 0, walked).otherwise(text), f"{prefix}clean"
    out = found.withColumn(masked, clean)       # a step of its own: nothing below may see the new text as the old
    changed = {text_col: F.col(masked)}
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        changed[size_col] = F.when(F.size(spans) > 0, F.length(masked).cast(kind)).otherwise(F.col(size_col))
    return out.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])
