"""Ranked search against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tonescape.llm import queries, shared_ranking
from tonescape.llm.shared_ranking import SearchOptions, SharedPlan

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(CAPITALS))


def plain(docs, items, top=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, words = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, missing, d) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if missing else d, -score))
    return sorted(out, key=repr)


def rows(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert rows(queries.QUERIES["op12_shared_ranking"](spark, SF_DIR)) == plain(docs, items)


@pytest.mark.parametrize("entries", [50_000, 12])
def test_hard(spark, frame, hard_rows, entries):
    docs = [*hard_rows, (30, "Straße STRASSE ÉCOLE école a1-b2_c3", "a"), (31, "w1 " * 50, "a"), (32, "\x00one\x7ftwo", "b")]
    docs += [(100 + i, f"one w{i % 3} same text", "a") for i in range(40)]  # ties
    items = [(1, "w1 w2 w3 é ONE"), (2, "w1 w2 w3 日本語"), (2, "one same text w1"), (3, None), (4, ""), (None, "two strasse école")]
    items += [(5, "nowhere"), (6, "w1 w2 w3 w4 w5 v1x1 text same one " * 3), (6, "w1 w2 w3 w4 w5 v1x1 text same one")]
    table = spark.createDataFrame([(i, t, "x", "x") for i, t in items], "item_id long, text string, item string, n string")
    found = shared_ranking.search(frame(docs), table, SearchOptions(group_entries=entries))
    assert rows(found) == plain([(d, t) for d, t, _ in docs], items)


def test_empty(spark, frame):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert shared_ranking.search(frame([]), items).collect() == []
    assert shared_ranking.search(frame([(1, "one", "a")]), items.limit(0)).collect() == []
    assert shared_ranking.search(frame([(1, None, "a"), (2, "..", "a")]), items).collect() == []


def test_small_blocks_and_stretches(spark, frame, monkeypatch):
    r = random.Random(5)
    docs = [(i, " ".join(r.choice("abcdefghij") * r.randint(1, 2) for _ in range(r.randint(0, 40))), "a") for i in range(200)]
    items = [(i, " ".join(r.choice("abcdefghij") for _ in range(8))) for i in range(12)]
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(shared_ranking, "BLOCK_ROWS", 7)
    monkeypatch.setattr(shared_ranking, "TEXT_BYTES", 11)
    assert rows(shared_ranking.search(frame(docs), table, SearchOptions(top=3))) == plain([d[:2] for d in docs], items, 3)


def test_stretches_hold_whole_terms(monkeypatch):
    text = "a bb  ccc " + "d" * 40 + " e f" + "g" * 25
    for size in (1, 3, 7, 20, 100):
        monkeypatch.setattr(shared_ranking, "TEXT_BYTES", size)
        assert [t.decode() for some in shared_ranking.terms(text) for t in some] == terms(text)


def test_plan_shares_what_items_have_in_common():
    shared = [b"t%d" % i for i in range(10)]
    items = [[*shared, b"own%d" % i] for i in range(8)] + [shared[:4]]
    plan = SharedPlan(items)
    additions = len(plan.left) + sum(len(roots) - 1 for roots in plan.roots)
    assert additions < sum(len(item) - 1 for item in items) / 3
    # every node is a set of terms, and an item's roots are exactly its terms, once each
    names = {place: {term} for term, place in plan.vocabulary.items()}
    for node, (a, b) in enumerate(zip(plan.left, plan.right), len(plan.vocabulary)):
        assert not names[a] & names[b]
        names[node] = names[a] | names[b]
    for item, roots in zip(items, plan.roots):
        assert sum(len(names[node]) for node in roots) == len(item)
        assert set().union(*(names[node] for node in roots)) == set(item)


def test_accumulators_are_sums_of_their_terms():
    plan = SharedPlan([[b"a", b"b", b"c"], [b"a", b"b", b"c", b"d"], [b"a", b"b"]])
    assert plan.left
    scorer = shared_ranking.Scorer(plan, np.arange(1, len(plan.vocabulary) + 1), 5, 50, 3)
    held = scorer.accumulators(np.array([10, 4]), np.array([0, 3, 5]), np.array([0, 1, 3, 1, 2]), np.array([1, 2, 1, 3, 1]))
    for node, (a, b) in enumerate(zip(plan.left, plan.right), len(plan.vocabulary)):
        assert (held[node] == held[a] + held[b]).all()
