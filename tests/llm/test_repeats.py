"""Word windows, byte strings and similar sets against plain versions."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tonescape.llm import chosen_path, queries, suffix_ranks, super_kmers
from tonescape.llm.storage import small_batches

SF_DIR = "/root/testdata/sf0.001"


def documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_word_windows_query(spark):
    got = queries.QUERIES["op1_super_kmers"](spark, SF_DIR).collect()
    assert _sorted(got) == _sorted(brute.word_windows(documents(spark)))


@pytest.mark.parametrize("chunk", [64, 1 << 20])
def test_word_windows_hard(frame, hard_rows, chunk):
    options = super_kmers.WindowOptions(window=5, minimiser=2, chunk_bytes=chunk, bucket_bytes=2000)
    got = super_kmers.remove_repeats(frame(hard_rows), options, with_text=True)
    expected = brute.word_windows([r[:2] for r in hard_rows], 5)
    assert _sorted(r[:4] for r in got.collect()) == _sorted(expected)


@pytest.mark.parametrize("chunk", [64, 1 << 20])
def test_word_windows_of_one_doc_id(frame, chunk):
    """Rows with one doc_id: the earlier start stays, whatever the order of the rows."""
    shared = " ".join(f"s{i}" for i in range(25))
    before = [" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 10), ("b", 2), ("c", 10))]
    rows = [(d, f"{b} {shared} end{k}", "a") for k, (d, b) in enumerate([(5, before[0]), (5, before[1]), (None, before[2]), (None, before[1] + " q")])]
    for order in (rows, rows[::-1], rows[:2], rows[1::-1], rows[2:]):
        options = super_kmers.WindowOptions(chunk_bytes=chunk, bucket_bytes=2000)
        got = super_kmers.remove_repeats(frame(order, 1), options).collect()
        assert _sorted(r[:4] for r in got) == _sorted(brute.word_windows([r[:2] for r in order]))


def test_word_windows_empty(frame):
    assert super_kmers.remove_repeats(frame([])).collect() == []


def test_small_batches_are_put_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), small_batches(spark, 7):
        assert spark.conf.get(name) == "7"
        raise ZeroDivisionError
    assert spark.conf.get(name) == before


def test_byte_strings_query(spark):
    got = queries.QUERIES["op2_suffix_ranks"](spark, SF_DIR).collect()
    assert _sorted(r[:5] for r in got) == _sorted(brute.byte_repeats(documents(spark)))


@pytest.mark.parametrize("hot", [0, 10_000])
def test_byte_strings_hard(frame, hard_rows, hot):
    options = suffix_ranks.SuffixOptions(size=40, stretch=8, gram=8, chunk_bytes=500, bucket_bytes=2000, hot_anchors=hot)
    rows = [r for r in hard_rows if r[0] not in (8, 9)] + [(20, "abc " * 60, "a"), (21, "q" * 39, "b"), (22, "q" * 39, "b")]
    got = suffix_ranks.remove_repeats(frame(rows), options).collect()
    assert _sorted(r[:5] for r in got) == _sorted(brute.byte_repeats([r[:2] for r in rows], 40))


def test_byte_strings_random(frame):
    """Many short repeats with edits: ranks double, run out and meet at every distance."""
    rnd = random.Random(4)
    base = "".join(rnd.choice("abcd ") for _ in range(3000))
    rows = []
    for i in range(40):
        text = list(base[rnd.randrange(2000) :][: rnd.randrange(30, 900)])
        for _ in range(len(text) // 60):
            text[rnd.randrange(len(text))] = rnd.choice("xyz")
        rows.append((i, "".join(text), "a"))
    options = suffix_ranks.SuffixOptions(size=60, stretch=12, gram=6, chunk_bytes=2000, bucket_bytes=3000)
    got = suffix_ranks.remove_repeats(frame(rows), options).collect()
    assert _sorted(r[:5] for r in got) == _sorted(brute.byte_repeats([r[:2] for r in rows], 60))


def test_byte_strings_empty_and_options(frame):
    assert suffix_ranks.remove_repeats(frame([])).collect() == []
    with pytest.raises(ValueError):
        suffix_ranks.SuffixOptions(size=100)


def test_similar_sets_query(spark):
    got = queries.QUERIES["op10_chosen_path"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute.jaccard_classes(documents(spark))


def near_copies():
    rnd = random.Random(9)
    rows = []
    for group in range(6):
        base = [f"g{group}w{rnd.randrange(10_000)}" for _ in range(80)]
        for copy in range(12):
            words = list(base)
            for _ in range(copy % 4):
                words[rnd.randrange(80)] = f"e{rnd.randrange(10_000)}"
            rows.append((len(rows), " ".join(words), "a"))
    return rows


@pytest.mark.parametrize("bucket,block", [(2, 3), (64, 512)])
def test_similar_sets(frame, bucket, block):
    rows = near_copies()
    options = chosen_path.JoinOptions(bucket=bucket, block=block)
    got = chosen_path.join(frame(rows), options).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute.jaccard_classes([r[:2] for r in rows])


def test_similar_sets_hard(frame, hard_rows):
    got = chosen_path.join(frame(hard_rows)).collect()
    assert len(got) == len(hard_rows)
    one = {r.class_id: r.n_links for r in got if r.doc_id in (10, 11)}
    assert one == {10: 1}
    words = [r for r in got if r.doc_id in (4, 5, 6)]
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in words)
    kept = chosen_path.one_of_each(frame(hard_rows))
    assert kept.columns == frame(hard_rows).columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert 10 in ids and 11 not in ids and {4, 5, 6} <= set(ids)
    assert chosen_path.join(frame([])).collect() == []


def test_runs_follow_recall():
    assert chosen_path.JoinOptions(recall=0.9).runs < chosen_path.JoinOptions(recall=0.999).runs


def test_runs_reach_the_recall_at_the_last_level():
    for depth, last, recall in ((3, 4, 0.99999), (2, 6, 0.99), (3, 3, 0.999)):
        chance = 1.0
        for _ in range(last):
            chance = 1 - np.exp(-chance)
        runs = chosen_path.JoinOptions(depth=depth, max_depth=last, recall=recall).runs
        assert (1 - chance) ** runs <= 1 - recall < (1 - chance) ** (runs - 1)
