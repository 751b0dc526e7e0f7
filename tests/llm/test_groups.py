"""Operators over groups of documents, against brute force."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from annoloom.llm import blocks, chat_format, decontaminate, ngram_join, substring_dedup
from annoloom.llm.queries import CONTROL_CASE, QUERIES
from tests.llm.conftest import ODD


# ---- chat formatting ----

def plain_digest(turns):
    loss = "".join(t for role, t in turns if role == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_conversations(spark, sf_dir):
    got = {r.conv_id: r for r in QUERIES["op3_chat_format"](spark, sf_dir).collect()}
    want = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want[r.conv_id].append((r.role, r.text or ""))
    want[-1] = [("user", CONTROL_CASE), ("assistant", CONTROL_CASE)]
    assert got.keys() == want.keys()
    for c, turns in want.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == plain_digest(turns)
        assert r.formatted_chars > sum(len(t) for _, t in turns)


def test_escaping_is_reversible():
    pieces = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "a", "\n", "<\\|", "\\|"]
    draw = random.Random(3)
    for _ in range(2000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 8)))
        assert "<|" not in chat_format.escape(text)
        assert chat_format.unescape(chat_format.escape(text)) == text
        role = chat_format.escape_role(text)
        assert "\n" not in role and chat_format.unescape_role(role) == text


LAYOUT_CASES = [
    ({"prompt": "p", "completion": "c", "meta": {"x": [1]}}, "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "more", "output": None, "system": "s"}, "instruction",
     [("system", "s"), ("user", "i\nmore"), ("assistant", "")]),
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, "messages",
     [("user", "a"), ("assistant", "b")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "conversations",
     [("user", "a"), ("assistant", "b")]),
    ({"prompt": "p", "response": {"k": 1}, "system": "s"}, None, []),
    ({"question": "q", "answer": 7}, "question_answer", [("user", "q"), ("assistant", "7")]),
    ({"unknown": 1}, None, []), ([1, 2], None, []),
    # known fields of other layouts are extra fields like any other
    ({"prompt": "p", "completion": "c", "system": "s"}, "prompt_completion", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"messages": [{"role": "user", "content": "a"}], "system": "s"}, "messages", [("system", "s"), ("user", "a")]),
    ({"instruction": "i", "input": "more", "output": "o", "text": "t"}, "instruction", [("user", "i\nmore"), ("assistant", "o")]),
    ({"question": "q", "answer": "a", "role": "r"}, "question_answer", [("user", "q"), ("assistant", "a")]),
    # what no layout reads
    ({"messages": [{"role": "user", "content": "a"}, None]}, None, []),
    ({"messages": [{"role": "user", "content": "a"}, "plain"]}, None, []), ({"messages": []}, None, []),
    ({"messages[].role": "user", "messages[].content": "x"}, None, []), ({"role": "user", "text": "\ud800"}, None, []),
]


def test_layouts_by_fingerprint():
    for record, name, turns in LAYOUT_CASES:
        assert chat_format.turns_of(json.dumps(record)) == (name, turns)
    for payload in (None, "", "{", "null", "3", "[" * 100_000, '{"role": "user", "text": ' * 5000, '{"role":"user","text":"\\ud800"}',
                    '{"a":' * 2000 + "1" + "}" * 2000):
        assert chat_format.turns_of(payload) == (None, [])


def test_chat_odd_rows(spark):
    rows = [(1, 1, '{"role": null, "text": null}'), (1, None, '{"role": "assistant", "text": "first"}'),
            (1, 1, '{"role": "assistant", "text": "b"}'), (1, 1, '{"role": "assistant", "text": "b"}'),
            (None, 0, '{"role": "us\\ner", "text": "x"}'), (2, 0, "nonsense")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, payload string").withColumn("segment", F.lit(1))
    turns = chat_format.canonical_turns(df)
    assert turns.filter("layout is null").count() == 1
    segments = chat_format.format_turns(turns)
    for got in (chat_format.read_back(segments, in_order=True), chat_format.read_back(segments)):
        found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got.collect()}
        assert found == {1: plain_digest([("assistant", "first"), ("", ""), ("assistant", "b"), ("assistant", "b")]),
                         None: plain_digest([("us\ner", "x")])}
    empty = spark.createDataFrame([], "conv_id long, turn long, payload string")
    assert chat_format.read_back(chat_format.format_turns(chat_format.canonical_turns(empty))).count() == 0


# ---- n-gram join ----

def shingles(text):
    words = (text or "").encode().translate(ngram_join.LOWER).split()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain_components(rows):
    """rows: (id, text) -> [(id, n, component)], by comparing every two documents that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    inverted = defaultdict(list)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in inverted[g])
        for j, o in shared.items():
            if 100 * o >= 75 * (len(s) + len(sets[j]) - o):
                parent[find(i)] = find(j)
        for g in s:
            inverted[g].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return Counter((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows))


def found_components(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_join_matches_brute_force(spark, sf_dir, texts):
    assert found_components(QUERIES["op6_ngram_join"](spark, sf_dir)) == plain_components(sorted(texts.items()))


def near_copies(seed=5):
    """Chains, hubs, groups with a common passage, sizes at the threshold."""
    draw = random.Random(seed)
    words = [f"v{i}" for i in range(400)]
    passage = draw.choices(words, k=60)
    rows = []
    for base in range(6):
        text = draw.choices(words, k=draw.choice((30, 60, 120)))
        rows.append(text)
        for _ in range(25):                     # copies of the base, or of a copy, with a few edits
            copy = list(draw.choice(rows[-10:]) if draw.random() < 0.5 else text)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            if draw.random() < 0.4:
                copy = copy[:draw.randint(len(copy) * 2 // 3, len(copy))]
            rows.append(copy)
    rows += [passage + draw.choices(words, k=draw.randint(0, 80)) for _ in range(40)]
    draw.shuffle(rows)
    return [(i * 7, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("docs_per_block", [9, 1000])
def test_join_of_near_copies(spark, docs_per_block):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found_components(ngram_join.ngram_join(df, docs_per_block=docs_per_block)) == plain_components(rows)


def test_join_odd_rows(odd, nothing):
    assert found_components(ngram_join.ngram_join(odd, docs_per_block=3)) == plain_components([r[:2] for r in ODD])
    assert ngram_join.ngram_join(nothing).count() == 0
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in ODD} - {6, 7}
    assert ngram_join.keep_one(nothing).count() == 0


def test_one_row_of_each_component_stays(spark, odd):
    """Rows are counted, not ids: repeated ids, one id with several texts, and null ids."""
    a, b, c = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    near_a = a.replace("a59", "x")
    bridge = [" ".join(f"d{i}" for i in range(k, k + 60)) for k in (0, 6, 12)]
    rows = [(1, a, "a"), (1, a, "a"), (2, near_a, "near a"), (2, b, "b"), (3, near_a + " y", "near a"),
            (None, a, "a"), (None, a, "a"), (None, c, "c"), (None, c, "c"), (None, c + " z", "c"),
            (5, bridge[0], "d"), (None, bridge[1], "d"), (6, bridge[2], "d"), (7, "", "e"), (7, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _number string").repartition(3)
    for size in (2, 1000):
        assert found_components(ngram_join.ngram_join(df, docs_per_block=size)) == plain_components([r[:2] for r in rows])
        kept = [(r.doc_id, r.text if r._number != "c" else "", r._number)
                for r in ngram_join.keep_one(df, docs_per_block=size).collect()]
        assert Counter(kept) == Counter([(1, a, "a"), (2, b, "b"), (None, "", "c"), (5, bridge[0], "d"),
                                         (7, "", "e"), (7, "", "e")])
    assert Counter(r.doc_id for r in ngram_join.keep_one(odd).collect()) == \
        Counter(r[0] for r in ODD) - Counter([6, 7, 13])


def test_all_links_between_classes(spark):
    """Also those inside a group, between two that are not its leader."""
    rows = near_copies()[:120]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    least, copies = {}, Counter()
    for i, t in rows:
        least[shingles(t)] = min(i, least.get(shingles(t), i))
        copies[shingles(t)] += 1
    sets = sorted(least, key=least.get)
    want = Counter((least[s], least[t], copies[s], copies[t], len(s & t)) for k, s in enumerate(sets) for t in sets[k + 1:]
                   if s and t and 100 * len(s & t) >= 75 * len(s | t))
    got = ngram_join.ngram_links(df).collect()
    assert want and Counter((r.class_id, r.other_id, r.copies, r.other_copies, r.overlap) for r in got) == want


def test_long_chain_of_components(spark):
    n = 40
    links = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    nodes = spark.range(n + 1).withColumnRenamed("id", "rep")
    assert {(r.rep, r.label) for r in ngram_join.components(nodes, links).collect()} == {(i, 0) for i in range(n + 1)}


# ---- substring dedup ----

def plain_dedup(rows, window=13):
    """rows: (id, text) -> [(id, words, removed, sha)]."""
    least, split = {}, []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        grams = [tuple(words[k:k + window]) for k in range(len(words) - window + 1)]
        split.append((doc_id, words, grams))
        for g in grams if doc_id is not None else ():
            least[g] = min(doc_id, least.get(g, doc_id))
    out = Counter()
    for doc_id, words, grams in split:
        gone = set()
        for k, g in enumerate(grams):
            if doc_id is not None and least[g] < doc_id:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def found_dedup(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_dedup_matches_brute_force(spark, sf_dir, texts):
    assert found_dedup(QUERIES["op9_substring_dedup"](spark, sf_dir)) == plain_dedup(texts.items())


@pytest.mark.parametrize("docs_per_block", [5, 1000])
def test_dedup_of_copied_passages(spark, docs_per_block):
    draw = random.Random(8)
    sources = [[f"s{j}w{i}" for i in range(80)] for j in range(6)]
    rows = []
    for i in range(120):                        # passages from several sources side by side, and repeats inside
        words = []
        for _ in range(draw.randint(0, 5)):
            s, a = draw.choice(sources), draw.randint(0, 60)
            words += s[a:a + draw.randint(3, 40)] + draw.choices(["x", "y", "z"], k=draw.randint(0, 3))
        rows.append((draw.choice((i, i - 1)) * 11, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    result = substring_dedup.substring_dedup(df, docs_per_block=docs_per_block)
    assert found_dedup(result) == plain_dedup(rows)
    for r in result.collect():
        covered = {k for f in r.factors for k in range(f.start, f.start + f.length)}
        assert len(covered) == r.n_removed and all(f.length >= 13 for f in r.factors)
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_dedup_odd_rows(odd, nothing):
    assert found_dedup(substring_dedup.substring_dedup(odd, docs_per_block=3)) == plain_dedup([r[:2] for r in ODD])
    assert substring_dedup.substring_dedup(nothing).count() == 0


# ---- benchmark decontamination ----

def test_leaks(spark, sf_dir, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    exact = {(i, j) for i, t in texts.items() for j, x in items.items() if x in t}
    got = [(r.doc_id, r.item_id) for r in QUERIES["op8_decontamination"](spark, sf_dir).collect()]
    assert exact and len(got) == len(set(got)) and exact <= set(got)
    for i, j in set(got) - exact:               # what is not word for word shares most of its trigrams
        ours = decontaminate.grams(decontaminate.terms_of(items[j]))
        assert len(ours & decontaminate.grams(decontaminate.terms_of(texts[i]))) >= 0.5 * len(ours)


def test_retrieval_is_complete(texts, spark, sf_dir):
    """Skipping blocks loses nothing: the same hits as scoring every item for every passage."""
    rows = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    words = [decontaminate.terms_of(t) for _, t in rows]
    df = Counter(t for w in words for t in set(w))
    entries = [(rows[k][0], k, t, n, df[t], len(w), rows[k][1] if i == 0 else None)
               for k, w in enumerate(words) for i, (t, n) in enumerate(sorted(Counter(w).items()))]
    span = max(map(len, words))
    index = decontaminate.build_index(entries, len(rows), sum(map(len, words)) / len(rows), span)
    sample = [texts[i] for i in sorted(texts)[:150]]
    found = {(n, s, index.item_ids[k]): v for n, s, k, v, _ in decontaminate.retrieve(index, sample, 0.3)}
    impact = defaultdict(dict)
    for t, k in index.terms.items():
        for at in range(index.begins[k], index.begins[k + 1]):
            impact[index.item_ids[index.items[at]]][t] = index.impacts[at]
    want = {}
    for n, text in enumerate(sample):
        ws = decontaminate.terms_of(text)
        for s in range(0, len(ws), span):
            have = set(ws[s:s + 2 * span])
            for item, weights in impact.items():
                if (score := sum(v for t, v in weights.items() if t in have)) >= 0.3:
                    want[n, s, item] = score
    assert found.keys() == want.keys() and want
    assert all(found[k] == pytest.approx(want[k]) for k in want)


def test_items_with_one_edit_in_a_short_last_sentence(spark, sf_dir):
    """Near copies of the benchmark's items, and copies whose short last sentence is cut off."""
    rows = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    parts = [decontaminate.question_and_answer(t) for _, t in rows]
    df = Counter(t for q, a in parts for t in set(q + a))
    entries = [(rows[k][0], k, t, n, df[t], len(q + a), rows[k][1] if i == 0 else None)
               for k, (q, a) in enumerate(parts) for i, (t, n) in enumerate(sorted(Counter(q + a).items()))]
    index = decontaminate.build_index(entries, len(rows), sum(len(q + a) for q, a in parts) / len(rows),
                                      max(len(q + a) for q, a in parts))
    planted = []
    for k, (q, a) in enumerate(parts):
        if len(a) <= 7 and len(q) >= 20:
            planted += [(k, q + a[:i] + ["edited"] + a[i + 1:]) for i in range(len(a))]
            if len(a) <= 4:
                planted.append((k, q))
    assert len({k for k, _ in planted}) > 5
    texts = [" ".join(["before"] * 9 + words + ["after"] * 9) for _, words in planted]
    found = {(n, item) for n, item in decontaminate.leaks_in(index, texts, decontaminate.THRESHOLD, decontaminate.OVERLAP)}
    assert {(n, k) for n, (k, _) in enumerate(planted)} <= found


@pytest.mark.parametrize("passage, found", [
    ("one two three four five six seven", True), ("one two three four x six seven", True),
    ("one two three y four y seven y six y five", False), ("one two three and more of these", False)])
def test_short_answers_by_words(passage, found):
    parts = decontaminate.question_and_answer("One two three? Four five six seven.")
    assert (decontaminate.verified(*parts, passage.split(), decontaminate.OVERLAP) is not None) == found


def test_leaks_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "One two three? Four five six seven."), (2, None), (3, ""), (None, "..."), (4, "One two three? Four five six seven."),
                                   (5, "Single words without an end"), (6, "alpha")], "item_id long, text string")
    more = spark.createDataFrame([(100, "x " * 30 + "ONE two, three four five six seven y", "z")], "doc_id long, text string, item_id string")
    for shard in (2_000_000, 5):
        got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(more, items, shard_postings=shard).collect()}
        assert got == {(100, 1), (100, 4)}
    assert decontaminate.find_leaks(odd, items).count() == 0
    assert decontaminate.find_leaks(nothing, items).count() == 0
    empty = items.limit(0)
    assert decontaminate.find_leaks(more, empty).count() == 0
    assert decontaminate.drop_leaks(odd, empty).count() == len(ODD)
    assert decontaminate.drop_leaks(odd, items).columns == odd.columns
    assert decontaminate.drop_leaks(more, items).count() == 0


def test_words_are_hashed_together():
    """Hashes of all words of a block are equal where the words are, whatever their lengths and blanks."""
    draw = random.Random(6)
    texts = [b"", b" ", b"a", b"\0 \0\0 a\0", b"\xc2\x85x\xc2\xa0y", b"g\x1cg", b"\ta  b\r\n\x0bc\x0cd ",
             *(b"x" * n + b" " + b"x" * n + b"y" for n in (7, 8, 9, 16, 63, 64, 65, 200))]
    texts += [bytes(draw.choices(b"ab\0 \n", k=draw.randint(0, 90))) for _ in range(200)]
    hashes, sizes = blocks.word_hashes(iter(texts))
    words = [w for t in texts for w in t.split()]
    assert sizes.tolist() == [len(t.split()) for t in texts] and len(hashes) == len(words)
    assert len({*zip(words, hashes.tolist(), strict=True)}) == len({*words}) == len({*hashes.tolist()})
    assert [len(x) for x in blocks.word_hashes([])] == [0, 0]
