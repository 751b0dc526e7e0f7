"""Repair of conversation structure: the cheapest edits to legal roles, by a persistent audit DP.

A conversation is legal if the initials of its roles are ``(s?(ua)+)?``. A row may be kept (0), deleted (3) or given
the role user or assistant (2), an empty user or assistant turn may be inserted anywhere (2); blank and duplicate rows
have to be deleted, a truncated row that stays costs 1 more. The audit is the edits' initials in order; of equally cheap
audits the least in ASCII order counts.

The turns of a conversation pass one task in their order, one at a time (``repair``). After each turn there are at most
four open states (nothing yet, after system, after user, after assistant), each with its cost, its audit and the running
hash of its repaired text:

* Audits share their prefixes as linked nodes: an edit adds one node to its prefix. A node at depth d has its ancestors
  at the distances 1, 2, 4, ... up to the largest power of two that divides d, two on average, and the rolling hash of
  its audit.
* Two audits of equal cost are compared by a search for their longest common prefix: both go up by the largest jumps
  that still lead to different prefixes; the edits there decide. Prefixes with equal hashes that are not the same node
  are compared edit by edit before they count as equal.
* After a given row, no audit of equal cost and state is a prefix of another (what is longer has insertions, which
  cost), so the lesser one stays the lesser one whatever follows.

Texts are not held: a state has a copy of its digest. What grows with one conversation is the audit nodes, about
0.3 kB for a turn, and its audit itself, which is a value of the result.

Faults are found before: blank and truncated by column functions, duplicates by numbering the rows of a conversation
with equal role and text, which is dealt by that text too, so a long conversation is spread. Odd input: null conv_id,
turn, role and text are one space in the damage; a null conv_id is a conversation of its own, null turns come first.
An empty role has no initial and is illegal. Rows of one turn come in the order of role, text and original text, a repeated row next to its copy. A conversation
without rows after the damage has an empty audit. Other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annoloom.llm.rows import arrow_schema, record_batch, slices

BLANKS = " \t\n\x0b\x0c\r"
REPAIRED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string")
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
LEGAL = ("su", "ua", "au")
START, SYSTEM, USER, ASSISTANT = range(4)
#: From a state by the initial of the next turn.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The only role that may be inserted or given in a state, and the state after it.
GIVEN = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}

_MASK, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51        # modulus and base of the rolling hash


class Audit:
    """One edit of an audit, linked to the audit before it."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, before: Audit | None, edit: str):
        self.edit = edit
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * _BASE + ord(edit)) % _MASK
        up = [before]
        while self.depth % (2 << (len(up) - 1)) == 0:       # up[k] is 2 ** k edits before
            up.append(up[-1].up[len(up) - 1])
        self.up = tuple(up)

    def text(self) -> str:
        edits, node = [], self
        while node.depth:
            edits.append(node.edit)
            node = node.up[0]
        return "".join(reversed(edits))


def at_depth(node: Audit, depth: int) -> Audit:
    """The ancestor of that depth, by the largest jumps."""
    while node.depth > depth:
        k = min(len(node.up), (node.depth - depth).bit_length()) - 1
        node = node.up[k]
    return node


def same(a: Audit, b: Audit) -> bool:
    """Whether two audits of one depth are equal; equal hashes are verified on the edits."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b and a.depth:
        if a.edit != b.edit:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Audit, b: Audit) -> bool:
    """ASCII order of two audits; a prefix comes before what it begins."""
    depth = min(a.depth, b.depth)
    x, y = at_depth(a, depth), at_depth(b, depth)
    if same(x, y):
        return a.depth < b.depth
    k = len(x.up) - 1
    while k >= 0:
        if same(x.up[k], y.up[k]):
            k -= 1
        else:
            x, y = x.up[k], y.up[k]
            k = len(x.up) - 1
    return x.edit < y.edit


class Way:
    """The best way to a state: its cost, its audit, and the digest of the repaired turns so far."""

    __slots__ = ("cost", "audit", "digest", "turns")

    def __init__(self, cost: int, audit: Audit, digest, turns: bool):
        self.cost, self.audit, self.digest, self.turns = cost, audit, digest, turns


class Repair:
    """The state of one conversation between two of its turns."""

    def __init__(self):
        self.ways: dict[int, Way] = {START: Way(0, Audit(None, ""), hashlib.sha256(), False)}

    @staticmethod
    def _best(candidates: list) -> dict[int, Way]:
        """Of candidates (state, cost, way before, edit, role, text or None) the best for each state."""
        best: dict[int, tuple] = {}
        for state, cost, before, edit, role, text in candidates:
            held = best.get(state)
            if held is not None and held[0] < cost:
                continue
            audit = Audit(before.audit, edit)
            if held is None or cost < held[0] or less(audit, held[1]):
                best[state] = (cost, audit, before, role, text)
        ways = {}
        for state, (cost, audit, before, role, text) in best.items():
            if role is None:
                ways[state] = Way(cost, audit, before.digest, before.turns)
            else:
                digest = before.digest.copy()
                digest.update(("\n" if before.turns else "").encode() + f"{role}:{text}".encode())
                ways[state] = Way(cost, audit, digest, True)
        return ways

    def _insert(self) -> None:
        """Insertions before the next row: each state from those before it, as long as that is better."""
        changed = set(self.ways)
        while changed:
            better = set()
            for state in sorted(changed, key=lambda s: self.ways[s].cost):
                way = self.ways[state]
                role, after = GIVEN[state]
                held = self.ways.get(after)
                if held is not None and held.cost < way.cost + 2:
                    continue
                found = self._best([(after, way.cost + 2, way, INSERT, role, "")])[after]
                if held is None or found.cost < held.cost or less(found.audit, held.audit):
                    self.ways[after] = found
                    better.add(after)
            changed = better

    def turn(self, role: str, text: str, gone: bool, truncated: bool) -> None:
        """One more row; ``gone`` if it has to be deleted."""
        self._insert()
        candidates, more = [], int(truncated)
        for state, way in self.ways.items():
            candidates.append((state, way.cost + 3, way, DELETE, None, None))
            if gone:
                continue
            kept = NEXT.get((state, role[:1]))
            if kept is not None:
                candidates.append((kept, way.cost + more, way, KEEP, role, text))
            new, after = GIVEN[state]
            candidates.append((after, way.cost + 2 + more, way, REROLE, new, text))
        self.ways = self._best(candidates)

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, hash of the repaired turns)"""
        self._insert()
        ends = [self.ways[s] for s in (START, ASSISTANT) if s in self.ways]
        best = ends[0]
        for way in ends[1:]:
            if way.cost < best.cost or (way.cost == best.cost and less(way.audit, best.audit)):
                best = way
        return best.cost, best.audit.text(), best.digest.hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with a fault put in by the checksum of conversation and turn; dropped rows stay as rows with ``dropped``.

    0 drops a row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it, 4 sets its role to user.
    """
    def given(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn"))) % 20
    role, text = given("role"), given("text")
    copies = F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(case == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(case == 1, F.lit("")).when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (case == 0).alias("dropped"), F.when(case == 4, role).otherwise(F.lit("")).alias("was"),
        F.explode(copies).alias("copy"))


def faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``, the first that applies of blank (b), duplicate (d) and truncated (t), else empty.

    Equal turns of a conversation are numbered in their order. They are found by a digest of role and text, so rows
    of a long conversation are dealt over many tasks.
    """
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    same_turn = W.partitionBy("conv_id", "dropped", "key").orderBy(F.asc_nulls_first("turn"), "role", "text", "was", "copy")
    fault = (F.when(last == "", "b").when(F.col("number") > 1, "d")
             .when(~last.isin(".", "!", "?"), "t").otherwise(""))
    return (rows.withColumn("key", key).withColumn("number", F.row_number().over(same_turn))
            .withColumn("fault", fault).drop("key", "number"))


def repair(rows: DataFrame) -> DataFrame:
    """One row of ``REPAIRED`` for each conversation of ``rows`` (conv_id, turn, role, text, dropped, fault, was, copy).

    Rows are sorted outside Python and streamed. Dropped rows only make sure that their conversation has a result.
    """
    def run(batches):
        schema = arrow_schema(REPAIRED)
        conv, state = None, None

        def row():
            work, _, low, high, distinct, counts, illegal = state
            cost, audit, digest = work.result()
            gaps = high - low + 1 - distinct if distinct else 0
            return (conv, gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, digest)

        for b in slices(batches):
            out = []
            for c, turn, role, text, dropped, fault in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        out.append(row())
                    # repair, last initial, lowest, highest and number of turns, faults, illegal pairs
                    conv, state = c, [Repair(), None, 0, 0, 0, {"b": 0, "d": 0, "t": 0, "": 0}, 0]
                if dropped:
                    continue
                if turn is not None:
                    if not state[4]:
                        state[2], state[4] = turn, 1
                    elif turn != state[3]:
                        state[4] += 1
                    state[3] = turn
                state[5][fault] += 1
                initial = role[:1]
                state[6] += state[1] is not None and state[1] + initial not in LEGAL
                state[1] = initial
                state[0].turn(role, text, fault in ("b", "d"), fault == "t")
            if out:
                yield record_batch(schema, list(zip(*out, strict=True)))
        if state is not None:
            yield record_batch(schema, list(zip(row(), strict=True)))

    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "was", "copy"]
    return (rows.repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "text", "dropped", "fault").mapInArrow(run, REPAIRED))


def structure_repair(conversations: DataFrame) -> DataFrame:
    """Damage, faults and repair of a table (conv_id, turn, role, text)."""
    return repair(faults(damage(conversations)))
