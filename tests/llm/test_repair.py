"""Structure repair against whole-string dynamic programming and an exhaustive search."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from annoloom.llm import structure_repair as R
from annoloom.llm.queries import QUERIES

CONV_DDL = "conv_id long, turn long, role string, text string, cost string, dropped boolean, key int"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def digest(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def exhaustive(rows, most_inserts=2):
    """The least (cost, audit) over every list of edits with at most two insertions in a row."""
    best = [None]

    def go(i, initials, cost, audit, out, inserts):
        if best[0] and cost > best[0][0]:
            return
        if i == len(rows) and LEGAL.match(initials) and (best[0] is None or (cost, audit) < best[0][:2]):
            best[0] = (cost, audit, out)
        if inserts < most_inserts:
            for role in ("user", "assistant"):
                go(i, initials + role[0], cost + 2, audit + "I", [*out, (role, "")], inserts + 1)
        if i < len(rows):
            role, text, gone, truncated = rows[i]
            go(i + 1, initials, cost + 3, audit + "D", out, 0)
            if not gone:
                go(i + 1, initials + (role[:1] or "?"), cost + truncated, audit + "K", [*out, (role, text)], 0)
                for new in ("user", "assistant"):
                    go(i + 1, initials + new[0], cost + 2 + truncated, audit + "R", [*out, (new, text)], 0)

    go(0, "", 0, "", [], 0)
    return best[0][0], best[0][1], digest(best[0][2])


def whole_strings(rows):
    """The same by states that hold their whole audit."""
    def inserted(states):
        for _ in range(4):
            for s, (cost, audit, out) in list(states.items()):
                role, after = ("assistant", 3) if s == 2 else ("user", 2)
                new = (cost + 2, audit + "I", (*out, (role, "")))
                if after not in states or new[:2] < states[after][:2]:
                    states[after] = new
        return states

    states = {0: (0, "", ())}
    for role, text, gone, truncated in rows:
        found = {}
        for s, (cost, audit, out) in inserted(states).items():
            new, after = ("assistant", 3) if s == 2 else ("user", 2)
            ways = [(s, (cost + 3, audit + "D", out))]
            if not gone:
                ways.append((after, (cost + 2 + truncated, audit + "R", (*out, (new, text)))))
                to = {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None}.get(role[:1])
                if to:
                    ways.append((to, (cost + truncated, audit + "K", (*out, (role, text)))))
            for to, way in ways:
                if to not in found or way[:2] < found[to][:2]:
                    found[to] = way
        states = found
    cost, audit, out = min((v for s, v in inserted(states).items() if s in (0, 3)), key=lambda v: v[:2])
    return cost, audit, digest(out)


def repaired(rows):
    work = R.Repair()
    for row in rows:
        work.turn(*row)
    return work.result()


def some_rows(draw, n):
    return [(draw.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), f"t{i}", draw.random() < .2,
             draw.random() < .3) for i in range(n)]


def test_cheapest_least_audit():
    draw = random.Random(1)
    for _ in range(60):
        rows = some_rows(draw, draw.randint(0, 3))
        assert repaired(rows) == exhaustive(rows) == whole_strings(rows)
    for _ in range(600):
        rows = some_rows(draw, draw.randint(0, 60))
        assert repaired(rows) == whole_strings(rows)


@pytest.mark.parametrize("base", [0, 1])
def test_hash_collisions_are_verified(monkeypatch, base):
    """With base 0 only the last edit counts in a hash, with 1 their order does not."""
    monkeypatch.setattr(R, "_BASE", base)
    draw = random.Random(2)
    for _ in range(200):
        rows = some_rows(draw, draw.randint(0, 40))
        assert repaired(rows) == whole_strings(rows)


def test_order_of_audits():
    def audit(text):
        node = R.Audit(None, "")
        for edit in text:
            node = R.Audit(node, edit)
        return node

    draw = random.Random(3)
    for _ in range(3000):
        head = "".join(draw.choices("DIKR", k=draw.randint(0, 40)))
        a, b = (head + "".join(draw.choices("DK", k=draw.randint(0, 5))) for _ in range(2))
        assert audit(a).text() == a
        assert R.less(audit(a), audit(b)) == (a < b)
        depth = draw.randint(0, len(a))
        assert R.at_depth(audit(a), depth).text() == a[:depth]


def test_a_long_conversation():
    """Two ways that never meet again; every tie needs a search."""
    rows = [("user", "x", False, False)] * 3000
    assert repaired(rows)[:2] == whole_strings(rows)[:2]


def brute(rows):
    """All rows of a table (conv_id, turn, role, text), nulls allowed, by plain Python."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        was, role = (role, "user") if case == 4 else ("", role)
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        if case:
            convs[conv] += [(turn is not None, turn or 0, role, text, was, copy) for copy in range(2 if case == 3 else 1)]
    out = {}
    for conv, found in convs.items():
        found.sort()
        seen, work, n = set(), [], dict.fromkeys("bdt", 0)
        for _, _, role, text, _, _ in found:
            solid = BLANK.findall(text)
            fault = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            work.append((role, text, fault in ("b", "d"), fault == "t"))
        turns = {t for known, t, *_ in found if known}
        pairs = zip(work, work[1:])
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["b"], n["d"], n["t"],
                     sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs), *whole_strings(work))
    return out


def test_conversations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_structure_repair"](spark, sf_dir).collect()}
    assert got == brute(rows) and got


def test_odd_conversations(spark):
    draw = random.Random(4)
    texts = [None, "", " \t\n", "Done.", "Done. \n", "cut", "cut", "Why? ", "x" * 100_000]
    rows = [(draw.choice([None, *range(-3, 40)]), draw.choice([None, 0, 1, 2, 5, 9]), draw.choice([None, "", "user", "user", "assistant", "system", "tool"]),
             draw.choice(texts), "c", True, 1) for _ in range(600)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, CONV_DDL).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in R.structure_repair(df).collect()}
    assert got == brute([r[:4] for r in rows])
    assert R.structure_repair(df.limit(0)).count() == 0


def test_all_rows_dropped(spark):
    turns = [t for t in range(400) if zlib.crc32(f"1:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame([(1, t, "user", "x.") for t in turns], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in R.structure_repair(df).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_general_tables_need_no_damage(spark):
    """Faults and repair work on any rows; nothing is damaged unless asked for."""
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes.")],
                               "conv_id long, turn long, role string, text string")
    rows = df.withColumns({"dropped": F.lit(False), "was": F.lit(""), "copy": F.lit(0)})
    assert R.repair(R.faults(rows)).select("audit", "cost").first() == ("KDK", 3)
