"""Part codes against a plain version in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tonescape.llm import part_codes
from tonescape.llm.part_codes import CodeOptions

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, block string, entry string, code string, name string"


def plain(rows, options):
    """Rows (vec_id, vector, label) -> sorted (vec_id, code, error, label_error), digest, moves of round 1."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, [math.floor(x * options.scale) for x in v], lab) for i, v, lab in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    d = size // options.parts
    cut = [[v[p * d : (p + 1) * d] for p in range(options.parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[: options.entries]] for p in range(options.parts)]

    def assign():
        out = []
        for c in cut:
            far = [[sum((a - b) ** 2 for a, b in zip(c[p], e)) for e in books[p]] for p in range(options.parts)]
            out.append([(f.index(min(f)), min(f)) for f in far])
        return out

    history = []
    for _ in range(options.rounds):
        near = assign()
        history.append(near)
        for p in range(options.parts):
            for e in range(len(books[p])):
                own = [c[p] for c, n in zip(cut, near) if n[p][0] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    near = assign()
    moves = sum(a[p][0] != b[p][0] for a, b in zip(*history[:2]) for p in range(options.parts)) if len(history) > 1 else 0
    error = [sum(d for _, d in n) for n in near]
    by_label = {}
    for (_, _, lab), e in zip(kept, error):
        by_label[lab] = by_label.get(lab, 0) + e
    codes = ["".join(f"{e:02x}" for e, _ in n) for n in near]
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    found = [(i, c, e, by_label[lab]) for (i, _, lab), c, e in zip(kept, codes, error)]
    return sorted(found, key=repr), digest, moves


def compare(spark, rows, options=CodeOptions(), parts=3):
    data = [(i, v, lab, "x", "x", "x", "x") for i, v, lab in rows]
    got = part_codes.compress(spark.createDataFrame(data, SCHEMA).repartition(parts), options=options).collect()
    expected, digest, _ = plain(rows, options)
    assert sorted((tuple(r)[:4] for r in got), key=repr) == expected
    assert {r.codebooks_sha256 for r in got} == {digest}


def vectors(n, size, seed, spread=0.5):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(size)], r.choice([None, 0, 1, 2])) for i in range(n)]


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = part_codes.compress(spark.read.parquet(f"{SF_DIR}/embeddings.parquet")).collect()
    expected, digest, _ = plain(rows, CodeOptions())
    assert sorted((tuple(r)[:4] for r in got), key=repr) == expected
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_hard_rows(spark):
    rows = vectors(150, 32, 1)
    rows += [(200, None, 1), (201, [math.nan] * 32, 1), (202, [math.inf, *[0.0] * 31], 1), (None, [0.1] * 32, None)]
    rows += [(203, [None, *[0.5] * 31], 2), (204, [], 2), (205, [1.0] * 16, 2), (3, [0.2] * 32, 7), rows[5], rows[5]]
    rows += [(-1, [0.0] * 32, 5)] * 3 + [(300 + i, [0.25] * 32, 9) for i in range(120)]
    rows += [(500, [-0.001] * 32, None), (501, [1e-320, *[-1e-320] * 31], None)]
    compare(spark, rows)


@pytest.mark.parametrize("n", [1, 5, 64, 65])
def test_few_rows(spark, n):
    compare(spark, vectors(n, 16, n))


def test_large_components(spark):
    rows = vectors(40, 16, 9, 1e3) + [(100 + i, [x * 10 for x in v], lab) for i, v, lab in vectors(20, 16, 10, 1e4)]
    compare(spark, rows, CodeOptions(entries=8))


def test_beyond_64_bits_does_not_fail(spark):
    rows = [(1, [1e300, 0.0], 0), (2, [-1e300, 1.0], 0), (3, [0.0, 2.0], 0)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = part_codes.compress(data, options=CodeOptions(parts=2, entries=1)).collect()
    assert len(got) == 3 and max(r.error for r in got) == (1 << 63) - 1


def test_rounds_blocks_and_many_labels(spark, monkeypatch):
    monkeypatch.setattr(part_codes, "BLOCK", 37)
    monkeypatch.setattr(part_codes, "BROADCAST_LABELS", 2)
    compare(spark, vectors(300, 12, 4), CodeOptions(parts=4, entries=6, rounds=4))


def test_empty_and_uneven(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    got = part_codes.compress(none)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and got.collect() == []
    nulls = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert part_codes.compress(nulls).collect() == []
    with pytest.raises(ValueError):
        part_codes.compress(spark.createDataFrame([(1, [0.5] * 17, 1)], "vec_id long, embedding array<float>, label int"))


def test_only_members_that_change_entry_move(spark):
    options = CodeOptions(parts=4, entries=6)
    rows = vectors(400, 16, 3)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    kept = frame.selectExpr("vec_id", "embedding as vector", "cast(label as long) label").cache()
    book = part_codes.first_codebooks(kept, options)
    members = part_codes.settle(kept, book, options.scale).cache()
    later = book.moved(part_codes.entry_sums(part_codes.sums(members, book.size, []), book.size))
    moved = part_codes.movers(members, book.size, [], later).collect()
    assert sum(len(r.slots) // 2 for r in moved) == plain(rows, options)[2] < 400 * 4 / 2
    # a member is counted once: where it stays or where it went
    stay = part_codes.sums(members, book.size, [later]).collect()
    assert sum(r["count"] for r in stay) + sum(len(r.slots) // 2 for r in moved) == 400 * 4


def test_nearest_takes_the_lowest_of_equals():
    points = np.array([[0, 0], [5, 5], [1 << 40, 0]])
    entries = np.array([[1, 0], [0, 1], [-1, 0]])
    for scale in (1, 1 << 10):
        got, far = part_codes.nearest(points[:2] * scale, entries * scale)
        assert got.tolist() == [0, 0] and far.tolist() == [scale**2, 41 * scale**2]
    got, far = part_codes.nearest(points, entries)
    assert got.tolist() == [0, 0, 0] and far[0] == 1 and far[2] == (1 << 63) - 1
