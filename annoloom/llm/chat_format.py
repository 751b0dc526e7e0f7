"""Chat formatting: any of several record layouts to one turn template with a loss mask.

A record is JSON of some layout: a prompt and a completion, an instruction with or without input, a
list of messages, one message per row. Its fingerprint is a hash of its nested field paths: those that any layout
knows, or, if that selects none, those that one layout knows, layout by layout in their order; so extra fields do not
count, also where another layout has a field of that name. The fingerprint selects a declarative
``Layout`` that lists where roles and texts are, so a new layout is a table entry, not code.

Turns are then written as ``<|im_start|>role newline text<|im_end|> newline``. A ``<``, any
backslashes and a ``|`` in a text get one more backslash, so no control string occurs in it, and
taking one away gives the text back. The loss mask covers assistant texts only.

Output is one row per turn, a segment of its conversation with offsets, never a whole conversation:
rows are dealt by conversation, sorted, and streamed, so one with very many turns needs no memory.

Odd input: a null text is empty, a null role is the empty role, a null order comes first; turns with
equal order are put in order of role and text; repeated rows are repeated turns. A record whose
layout is unknown, that is no JSON object, that has anything but objects in its list of messages, that is nested too
deep to be read, or whose texts are no Unicode (half a surrogate pair), gives one row with a null layout and no turn. Rows
with a null conversation id form one conversation. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoloom.llm.rows import arrow_schema, record_batch, slices

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Other names of the roles, in layouts that rename them.
ROLE_NAMES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}


class Layout(NamedTuple):
    """Field paths that a record must and may have, and the turns they make.

    A turn rule is ``(role, paths)``: a fixed role and the texts that are joined for it; or
    ``(list path, role field, text field)`` for a list of messages; or ``("", role field, text
    field)`` for a record that is one message.
    """
    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[tuple, ...]


LAYOUTS = (
    Layout("message_row", ("role", "text"), (), (("", "role", "text"),)),
    Layout("content_row", ("role", "content"), (), (("", "role", "content"),)),
    Layout("messages", ("messages[].role", "messages[].content"), ("system",),
           (("system", ("system",)), ("messages", "role", "content"))),
    Layout("conversations", ("conversations[].from", "conversations[].value"), ("system",),
           (("system", ("system",)), ("conversations", "from", "value"))),
    Layout("prompt_completion", ("prompt", "completion"), ("system",),
           (("system", ("system",)), ("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    Layout("prompt_response", ("prompt", "response"), ("system",),
           (("system", ("system",)), ("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Layout("instruction", ("instruction", "output"), ("input", "system"),
           (("system", ("system",)), ("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Layout("question_answer", ("question", "answer"), ("system",),
           (("system", ("system",)), ("user", ("question",)), (ASSISTANT, ("answer",)))),
)
KNOWN = frozenset(p for layout in LAYOUTS for p in layout.required + layout.optional)


def field_paths(value, prefix: str = "") -> Iterator[str]:
    """Paths of all leaves; the elements of a list share one path."""
    if isinstance(value, dict):
        for key, inner in value.items():
            yield from field_paths(inner, f"{prefix}.{key}" if prefix else key)
    elif isinstance(value, list):
        for inner in value:
            yield from field_paths(inner, f"{prefix}[]")
    else:
        yield prefix


def fingerprint(paths, known: frozenset[str] = KNOWN) -> str:
    return hashlib.sha1("\n".join(sorted(known.intersection(paths))).encode()).hexdigest()


MAPPINGS = {fingerprint(layout.required + chosen): layout
            for layout in LAYOUTS for k in range(len(layout.optional) + 1)
            for chosen in combinations(layout.optional, k)}
OWN = [(layout, frozenset(layout.required + layout.optional)) for layout in LAYOUTS]


def layout_of(paths: set[str]) -> Layout | None:
    """The layout that the fingerprint selects: of all known fields, else of those of one layout."""
    found = MAPPINGS.get(fingerprint(paths))
    if found is not None:
        return found
    return next((layout for layout, known in OWN if MAPPINGS.get(fingerprint(paths, known)) is layout), None)


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(payload: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    """The name of the layout and the canonical turns of one record; (None, []) for what no layout reads."""
    try:
        record = json.loads(payload or "")
        layout = layout_of(set(field_paths(record))) if isinstance(record, dict) else None
        if layout is None:
            return None, []
        turns = _turns(record, layout)
        "".join(role + text for role, text in turns).encode()       # half a surrogate pair is no text
    except (ValueError, AttributeError, KeyError, TypeError, RecursionError):
        return None, []
    return layout.name, turns


def _turns(record: dict, layout: Layout) -> list[tuple[str, str]]:
    turns = []
    for rule in layout.turns:
        if len(rule) == 2:
            role, paths = rule
            if found := [_text(record[p]) for p in paths if p in record]:
                turns.append((role, "\n".join(t for i, t in enumerate(found) if t or not i)))
        else:
            at, role, text = rule
            for message in record[at] if at else [record]:
                name = _text(message.get(role))
                turns.append((ROLE_NAMES.get(name, name) if at else name, _text(message.get(text))))
    return turns


_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>(.*)\n((?s:.*))<\|im_end\|>\n")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


CANONICAL = "conv_id long, turn long, part long, layout string, role string, text string"
SEGMENTS = ("conv_id long, turn_no long, segment string, segment_start long, loss_start long, "
            "loss_end long")
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def canonical_turns(records: DataFrame, id_col: str = "conv_id", order_col: str = "turn",
                    payload_col: str = "payload") -> DataFrame:
    """One row per turn; a record without known layout has one row with a null layout."""
    def run(batches):
        schema = arrow_schema(CANONICAL)
        for b in slices(batches):
            rows = []
            for conv, turn, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                name, turns = turns_of(payload)
                if name is None:
                    rows.append((conv, turn, 0, None, None, None))
                rows += [(conv, turn, i, name, role, text) for i, (role, text) in enumerate(turns)]
            if rows:
                yield record_batch(schema, list(zip(*rows, strict=True)))

    return records.select(F.col(id_col).cast("long"), F.col(order_col).cast("long"), payload_col) \
        .mapInArrow(run, CANONICAL)


def by_conversation(turns: DataFrame, *order: str) -> DataFrame:
    """Rows of a conversation one after the other in one partition, sorted outside Python."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_turns(turns: DataFrame) -> DataFrame:
    """Segments of canonical turns, in order within their partition."""
    def run(batches):
        schema = arrow_schema(SEGMENTS)
        conv, number, at = object(), 0, 0
        for b in slices(batches):
            rows = []
            for c, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c != conv:
                    conv, number, at = c, 0, 0
                head, body = f"{START}{escape_role(role or '')}\n", escape(text or "")
                segment = f"{head}{body}{END}\n"
                loss = (at + len(head), at + len(head) + len(body)) if role == ASSISTANT else (None, None)
                rows.append((c, number, segment, at, *loss))
                number, at = number + 1, at + len(segment)
            yield record_batch(schema, list(zip(*rows, strict=True)))

    known = turns.filter(F.col("layout").isNotNull())
    return (by_conversation(known, "turn", "part", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, SEGMENTS))


def read_back(segments: DataFrame, in_order: bool = False) -> DataFrame:
    """Digests of each conversation, from the formatted text and its loss mask alone.

    A hash over a conversation has to take its turns in order, so they pass one task, a turn at a
    time. ``in_order`` says that the segments come straight from ``format_turns``.
    """
    def run(batches):
        schema = arrow_schema(DIGESTS)
        conv, state = None, None

        def row():
            n, turns, chars, loss, size = state
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for b in slices(batches):
            rows = []
            for c, segment, at, lo, hi in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        rows.append(row())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                found = _TURN.fullmatch(segment)
                role, text = unescape_role(found[1]), unescape(found[2])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if lo is not None:
                    learned = unescape(segment[lo - at:hi - at])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(segment)
            if rows:
                yield record_batch(schema, list(zip(*rows, strict=True)))
        if state is not None:
            yield record_batch(schema, list(zip(row(), strict=True)))

    if not in_order:
        segments = by_conversation(segments, "turn_no")
    return (segments.select("conv_id", "segment", "segment_start", "loss_start", "loss_end")
            .mapInArrow(run, DIGESTS))
