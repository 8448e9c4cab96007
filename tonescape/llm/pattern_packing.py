"""Documents packed into training sequences by fitted length patterns.

The number of pieces of each length (one bounded histogram, whatever the corpus) is all
the plan needs. Patterns of up to three lengths that fill a sequence exactly are
enumerated, non-negative least squares fits how often to use each so that the histogram
is met, the counts are rounded to what is there, and the pieces left over are packed best
fit, longest first, still as counts. The plan says for every length which ranks go where;
pieces take their rank within their length and look their place up.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonescape.llm.tokens import encoder
from tonescape.session import stage

#: Rows of one length that are ranked together.
RANK_ROWS = 1_000

_PIECE = "piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class PackOptions:
    """``size``: tokens a sequence. ``end_id``: closes each document. ``rounds``: steps of the fit."""

    size: int = 2048
    end_id: int = 0
    rounds: int = 200


# --- Pieces -----------------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch], path: str, options: PackOptions) -> Iterator[pa.RecordBatch]:
    words, end = encoder(path), options.end_id.to_bytes(4, "little")
    for batch in batches:
        source, piece, start, length, crc = [], [], [], [], []
        for row, text in enumerate(batch.column("text")):
            ids = words.encode(text.as_py() or "") + end
            total = len(ids) // 4
            count = -(-total // options.size)
            at = 0
            for number in range(count):
                until = total - (count - 1 - number) * options.size
                source.append(row)
                piece.append(number)
                start.append(at)
                length.append(until - at)
                crc.append(zlib.crc32(ids[4 * at : 4 * until]))
                at = until
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(source, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def pieces(docs: DataFrame, path: str, options: PackOptions = PackOptions()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each whole text; only the first may be short."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _pieces(it, path, options), f"doc_id {kind}, {_PIECE}"
    )


# --- Plan: counts only ------------------------------------------------------------------


def full_patterns(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All sets of two or three of the lengths that sum to ``size``, as rows of three (0: none)."""
    have = np.zeros(size + 1, bool)
    have[lengths] = True
    short = lengths[lengths < size]
    a, b = np.meshgrid(short, short, indexing="ij")
    keep = (a >= b) & (a + b < size)
    a, b = a[keep], b[keep]
    c = size - a - b
    keep = (c <= b) & have[c]
    triples = np.stack([a[keep], b[keep], c[keep]], 1)
    pairs = short[(short * 2 >= size)]
    pairs = pairs[have[size - pairs]]
    pairs = np.stack([pairs, size - pairs, np.zeros_like(pairs)], 1)
    return np.concatenate([pairs, triples]), have


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int) -> np.ndarray:
    """Non-negative x that brings the patterns' lengths close to the histogram.

    Minimises |Ax - h|^2, A being the patterns' incidence, by multiplicative steps: each
    keeps x non-negative and never raises the error.
    """
    if not len(patterns):
        return np.zeros(0)
    target = histogram.astype(float)
    target[0] = 0.0
    n = len(target)
    wanted = target[patterns].sum(1)
    each = np.bincount(patterns.ravel(), minlength=n).astype(float)
    each[0] = 1.0
    share = target / np.maximum(each, 1.0)
    x = np.minimum.reduce([np.where(p > 0, share[p], np.inf) for p in patterns.T])
    for _ in range(rounds):
        made = np.zeros(n)
        for column in patterns.T:
            made += np.bincount(column, weights=x, minlength=n)
        made[0] = 0.0
        x = x * wanted / np.maximum(made[patterns].sum(1), 1e-12)
    return x


def take_patterns(patterns: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[tuple[list[int], int]]:
    """Round the fit to whole repeats, largest first, within what ``left`` (changed) has."""
    taken = []
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 0.5:
            break
        lengths = [int(v) for v in patterns[k] if v]
        uses = {v: lengths.count(v) for v in lengths}
        repeat = min(round(float(x[k])), *(int(left[v]) // m for v, m in uses.items()))
        if repeat > 0:
            for v, m in uses.items():
                left[v] -= m * repeat
            taken.append((lengths, repeat))
    return taken


def best_fit(left: np.ndarray, size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """What is left, longest first, each into the fullest sequence that has room.

    Works on counts: sequences filled alike are one group ([(length, times)], how many).
    """
    groups: list[tuple[list[tuple[int, int]], int]] = []
    rooms: list[tuple[int, int]] = []  # (room, group), sorted
    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            at = bisect_left(rooms, (length, -1))
            if at < len(rooms):
                room, g = rooms.pop(at)
                content, number = groups[g]
            else:
                room, content, number = size, [], math.inf
                g = None
            times = min(room // length, count)
            used = min(number, count // times)
            count -= used * times
            if g is not None:
                groups[g] = (content, number - used)
                if number > used:
                    insort(rooms, (room, g))
            groups.append(([*content, (length, times)], used))
            if room > times * length:
                insort(rooms, (room - times * length, len(groups) - 1))
    return [(content, number) for content, number in groups if number]


@dataclass(frozen=True)
class Plan:
    """Where ranks go: slot s takes ranks from ``key`` on (length in the high bits)."""

    key: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray
    sequences: int


_SHIFT = 44


def make_plan(histogram: np.ndarray, options: PackOptions) -> Plan:
    """The plan for so many pieces of each length (``histogram[size]`` is not looked at)."""
    left = histogram.astype(np.int64).copy()
    left[0] = left[options.size] = 0
    lengths = np.flatnonzero(left)
    patterns, _ = full_patterns(lengths, options.size)
    fitted = fit_counts(patterns, left, options.rounds)
    groups = [([(v, 1) for v in p], n) for p, n in take_patterns(patterns, fitted, left)]
    groups += best_fit(left, options.size)
    cursor = np.zeros(options.size + 1, np.int64)
    rows, sequence = [], 0
    for content, number in groups:
        offset = 0
        for length, times in content:
            rows.append(((length << _SHIFT) + int(cursor[length]), sequence, times, offset))
            cursor[length] += times * number
            offset += length * times
        sequence += number
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], sequence)


# --- Placing ----------------------------------------------------------------------------


def _place(batches: Iterator[pa.RecordBatch], plan: Plan, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        slot = np.searchsorted(plan.key, (length << _SHIFT) + rank, side="right") - 1
        relative = (length << _SHIFT) + rank - plan.key[slot]
        sequence = plan.sequence[slot] + relative // plan.times[slot]
        offset = plan.offset[slot] + relative % plan.times[slot] * length
        kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(sequence), pa.array(offset)],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack(docs: DataFrame, path: str, options: PackOptions = PackOptions()) -> DataFrame:
    """Each piece of ``docs`` with its sequence and offset.

    Null and empty texts are one piece of one token, the end id. Repeated rows are packed
    each. An empty table gives no rows. Other columns are not read. Texts are tokenised
    once; the stored pieces are small rows. A full piece is a sequence of its own (negative
    numbers). The others are ranked within their length in groups of about ``RANK_ROWS``, so
    a length that most pieces share is no hot key. The driver holds at most ``size`` counts
    and the plan made from them.
    """
    stored = stage(
        pieces(docs, path, options).withColumn("row_id", F.monotonically_increasing_id()), "pieces"
    )
    full = stored.where(F.col("length") == options.size).select(
        *[c for c in stored.columns if c != "row_id"],
        (-1 - F.col("row_id")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = stored.where(F.col("length") < options.size)
    counts = short.groupBy("length").count().collect()  # at most ``size`` rows
    histogram = np.zeros(options.size + 1, np.int64)
    for row in counts:
        histogram[row["length"]] = row["count"]
    plan = make_plan(histogram, options)
    spread = np.maximum(1, -(-histogram // RANK_ROWS)).tolist()
    parts = F.element_at(F.lit(spread), F.col("length").cast("int") + 1)
    short = short.withColumn("part", F.pmod(F.xxhash64("row_id"), parts))
    sizes = short.groupBy("length", "part").agg(F.count("*").alias("n"))
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("row_id")) - 1
    ranked = short.withColumn("within", within).join(before, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within"))
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, {_PIECE}, sequence_id long, offset long"
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        lambda it: _place(it, plan, options.size), schema
    )
    return placed.unionByName(full)
