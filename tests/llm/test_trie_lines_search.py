"""The conversation trie, line dedup and ranked search against plain loops over the same rows."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from lakeship.llm import conversation_trie, line_dedup, ranked_search

# --- op11 ---------------------------------------------------------------------

TURNS = "conv_id long, turn int, role string, text string"


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    out = []
    for node, held in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(held) if len(rebuilt[c]) == len(node))
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(not children[n] for n in below)
        out.append((min(held), len(node), parent, len(held), len(children[node]), leaves, saved, sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check_trie(spark, rows):
    df = spark.createDataFrame(rows, TURNS).withColumn("n", F.lit("x")).withColumn("pos", F.lit(0))
    found = [tuple(r) for r in conversation_trie.op11_monoid_prefix_trie(df).collect()]
    assert sorted(found, key=str) == brute_trie(rows)


def test_trie_of_odd_conversations(spark):
    chance = random.Random(3)
    rows = []
    for c in [*range(40), -7, -5, -3, 1003, 10**12]:
        for turn in range(chance.choice([1, 2, 3, 9, 12])):
            rows.append((c, turn, chance.choice("ua"), chance.choice(["hi", "é漢", "", "bye"])))
    rows += rows[:7]  # repeated rows
    rows += [(4, None, "u", "null turn"), (4, None, None, None), (4, 0, "u", "tie"), (None, 1, "u", "nobody's")]
    rows += [(50, t, "u", "first" if t == 0 else f"t{t}") for t in range(9)] + [(77, 1, "u", "x" * 300_000)]
    check_trie(spark, rows)


def test_trie_of_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK_TURNS", 16)
    monkeypatch.setattr(conversation_trie, "BLOCK_IDS", 4)
    rows = [(5, t, "u", f"t{t % 7}") for t in range(150)] + [(c, 0, "u", "t0") for c in range(6, 40)]
    check_trie(spark, rows)


def test_trie_of_nothing(spark):
    assert conversation_trie.op11_monoid_prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_equal_fingerprints_of_different_turns_are_noticed(spark):
    rows = [(c, t, "u", f"{c} {t}") for c in range(6) for t in range(3)]
    store = conversation_trie.stored_turns(spark.createDataFrame(rows, TURNS))
    weak = store.withColumns({f"t{i}": F.lit(1).cast("long") for i in range(4)})
    bases = conversation_trie.BASES[0]
    for numbers, holds in ((store, True), (weak, False)):
        prefixes = conversation_trie.rebuilt_prefixes(conversation_trie.prefix_fingerprints(numbers, bases), bases)
        assert conversation_trie.groups_hold(prefixes, store) is holds


# --- op12 ---------------------------------------------------------------------


def brute_lines(rows, least=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER))
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(-(2**63) if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        here = -(2**63) if doc is None else doc
        kept = [x for x in lines if len(holders.get(key(x), ())) < least or max(holders[key(x)]) == here]
        out.append((doc, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found_lines(df):
    return sorted(cases.pairs(line_dedup.op12_bloom_line_dedup(df), "doc_id", "n_lines", "n_dropped", "kept_sha256"), key=str)


def test_lines_of_odd_rows(spark):
    rows = [(r[0], r[1]) for r in cases.odd_rows()]
    assert found_lines(cases.odd_table(spark)) == brute_lines(rows)


def test_repeated_lines(spark):
    chance = random.Random(4)
    lines = [f"line {i} " + "word " * 8 for i in range(30)] + ["É" * 39, "É" * 40, "short", "", "\t" + "x" * 39 + " "]
    rows = []
    for doc in range(120):
        some = [chance.choice(lines) for _ in range(chance.randint(0, 6))]
        some = [chance.choice([x, x.upper(), "  " + x, x + "\r", x + "\x0b", x + "\x1c", x + "\xa0"]) for x in some]
        rows.append((doc % 110, "\n".join(some)))
    rows += [(None, lines[0]), (None, lines[1] + "\n"), (7, None), (8, "y" * 50 + "\n" + "\n".join([lines[2]] * 20_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("drops", F.lit(2))
    want = brute_lines(rows)
    assert found_lines(df) == want and sum(r[2] for r in want) > 100


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = [(d, "\n".join(f"{(d * 7 + i) % 3000:06d} " + "w" * 40 for i in range(40))) for d in range(300)]
    want = brute_lines(rows)
    monkeypatch.setattr(line_dedup, "BITS_PER_KEY", 1)
    assert found_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == want


def test_filter_has_every_repeat_and_few_others():
    chance = np.random.default_rng(1)
    hashes = chance.integers(-(2**63), 2**63, 60_000)
    parts, slices = [], 4
    import pyarrow as pa

    for some in np.split(hashes[:40_000], 4):
        again = np.concatenate([some, hashes[:50]])  # 50 hashes that every task has
        batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(again)], pa.array(again))], ["hashes"])
        parts += [b for b in line_dedup._filter_of_task(slices)(iter([batch]))]
    rows = sorted((s, o, t) for b in parts for s, o, t in zip(*(c.to_pylist() for c in b.columns)))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["slice", "once", "twice"])
    twice = {b.column(0)[0].as_py(): line_dedup.unpack(b.column(2)[0].as_py()) for b in line_dedup._merged_slices(iter([batch]))}
    place, bits = line_dedup._bits(hashes, slices)
    hit = np.array([twice[int(p)][b].all() for p, b in zip(place, bits.T)])
    assert hit[:50].all() and hit[50:40_000].mean() < 0.01 and hit[40_000:].mean() < 0.01


def test_lines_of_nothing(spark):
    assert line_dedup.op12_bloom_line_dedup(spark.createDataFrame([], cases.SCHEMA)).count() == 0


# --- op13 ---------------------------------------------------------------------


def brute_search(docs, items, most=10):
    terms = lambda text: re.findall(
        r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+",
        (text or "").translate(str.maketrans(ranked_search.UPPER, ranked_search.LOWER)),
    )
    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    counted = [(doc, c, sum(c.values())) for doc, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, asked in wanted.items():
        scores = []
        for doc, c, n in counted:
            m = 10 + 90 * n * n_docs // n_terms
            w = lambda t: floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, i, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scores)[:most], 1)]
    return sorted(out, key=str)


def found_ranks(docs, items, **more):
    found = ranked_search.ranked_search(docs, items, **more)
    return sorted(cases.pairs(found, "item_id", "rank", "doc_id", "score"), key=str)


ITEMS = "item_id long, text string"


def odd_items():
    texts = [r[1] for r in cases.odd_rows()]
    items = [(i, t) for i, t in enumerate(texts[:24])] + [(3, "abc gh"), (None, "one é漢字"), (None, "two"), (90, "nowhere_at-all"), (91, "")]
    return items + [(100 + i, " ".join(["gh", "abc", "one", "tabs", f"w{i}"][: 2 + i % 4])) for i in range(20)]


@pytest.mark.parametrize("block_terms", [ranked_search.BLOCK_TERMS, 150])
def test_search_of_odd_rows(spark, block_terms):
    items = odd_items()
    df = spark.createDataFrame(items, ITEMS).withColumn("term", F.lit("x"))
    want = brute_search([(r[0], r[1]) for r in cases.odd_rows()], items)
    assert found_ranks(cases.odd_table(spark), df, block_terms=block_terms) == want and len(want) > 100


def test_search_ties_and_many_documents(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "SUMS_AT_ONCE", 200)
    chance = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    docs = [(chance.randint(0, 300), " ".join(chance.choices(words, k=chance.choice([3, 3, 3, 8])))) for _ in range(600)]
    items = [(i, " ".join(chance.choices(words, k=6))) for i in range(30)]
    docs = [(i * 1000 + d, t) for i, (d, t) in enumerate(docs)] + [(-5, "w1 w2 w3"), (-6, "w1 w2 w3")]
    assert found_ranks(spark.createDataFrame(docs, ITEMS.replace("item", "doc")), spark.createDataFrame(items, ITEMS)) == brute_search(docs, items)


def test_search_of_nothing(spark):
    none, one = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b")], ITEMS)
    docs = spark.createDataFrame([(1, "a b"), (2, "!"), (3, None)], "doc_id long, text string")
    assert found_ranks(docs, none) == [] and found_ranks(docs.where("doc_id > 1"), one) == []
    assert found_ranks(docs.limit(0), one) == []


def test_sharing_graph_adds_each_term_once_and_saves_additions():
    chance = random.Random(2)
    common = [[0, 1, 2], [3, 4, 5, 6], [7, 8]]
    items = [sorted({t for c in chance.sample(common, 2) for t in c} | {10 + i, 60 + i % 9}) for i in range(40)]
    graph = ranked_search.sharing_graph(list(range(40)), items, 70)
    gains = np.array([chance.randint(1, 10**9) for _ in range(70)], np.int64)
    scores = ranked_search._all_scores(graph, 1, np.zeros(70, int), np.arange(70), gains)
    assert scores[:, 0].tolist() == [sum(int(gains[t]) for t in item) for item in items]
    assert graph.additions() < sum(len(item) - 1 for item in items) / 3
