"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

A passage of m characters that stands in a text with at most e edits shares at least
m + 1 - q * (e + 1) of its q-grams with it, all on neighbouring diagonals (place in the
text minus place in the passage). Shared q-grams are counted in bands of diagonals that
overlap by half, so some band holds them all; a band that meets the bound is aligned
within its diagonals, and stays if the edits are within the budget.

Long benchmark items are cut into overlapping segments, so a part of an item is found too.
Where the edits allowed leave no q-gram of the usual size for sure, shorter q-grams are
counted. Items shorter than a q-gram are found by hash, as they stand, at word bounds.
Letters are compared without case, and runs of white space as one blank.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.llm import wordcode as wc

_U = np.uint64
#: Bits of the table that tells most q-grams apart from all of the benchmark's.
_BITS = 22


@dataclass(frozen=True)
class MatchOptions:
    """``q``: characters of a q-gram at most; ``segment``: characters
    compared at a time, one every half of that; ``edits``: edits allowed per character.
    ``part_chars``: characters of the benchmark that tasks hold at a time; a larger one is
    matched in several passes."""

    q: int = 10
    segment: int = 96
    edits: float = 0.07
    part_chars: int = 4_000_000

    def budget(self, m: int) -> int:
        return int(self.edits * m)

    def gram(self, m: int) -> int:
        """Characters of the q-grams by which m characters are found: the most, up to ``q``, of
        which a match within the edits shares one at least."""
        return max(1, min(self.q, m // (self.budget(m) + 1)))

    def bound(self, m: int) -> int:
        """Shared q-grams of a match of m characters, at least."""
        return m + 1 - self.q * (self.budget(m) + 1)


def _lower(codes: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case."""
    upper = (codes >= 65) & (codes <= 90) | (codes >= 0xC0) & (codes <= 0xDE) & (codes != 0xD7)
    return np.where(upper, codes + 32, codes)


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points to compare, and the place of each in the text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    space = (codes == 32) | (codes >= 9) & (codes <= 13)
    keep = ~space | np.append(True, ~space[:-1])[: len(space)]
    return _lower(np.where(space, 32, codes))[keep], np.flatnonzero(keep)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    return wc.ngram_hashes(codes.astype(np.uint64) + _U(1), q)


@dataclass
class Index:
    """Segments of benchmark items and where their q-grams stand."""

    item: np.ndarray
    segments: list[np.ndarray]
    hashes: np.ndarray
    first: np.ndarray
    segment_of: np.ndarray
    offset: np.ndarray
    seen: np.ndarray


def build_index(items: list[tuple[int, str]], o: MatchOptions) -> Index:
    """Of items whose segments meet the bound with ``q``; ``build_indexes`` chooses it by item."""
    owner, segments = [], []
    for item, text in items:
        codes, _ = normalised(text.strip())
        step = o.segment // 2
        count = 1 + max(0, math.ceil((len(codes) - o.segment) / step))
        for k in range(count):
            start = min(k * step, max(0, len(codes) - o.segment))
            piece = codes[start : start + o.segment]
            if len(piece) >= o.q and o.bound(len(piece)) > 0:
                owner.append(item)
                segments.append(piece)
    grams = [gram_hashes(s, o.q) for s in segments]
    of = np.repeat(np.arange(len(segments)), [len(g) for g in grams])
    offset = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
    grams = np.concatenate(grams) if grams else np.empty(0, np.uint64)
    order = np.argsort(grams, kind="stable")
    hashes, first = np.unique(grams[order], return_index=True)
    seen = np.zeros(1 << _BITS, bool)
    seen[(hashes & _U((1 << _BITS) - 1)).astype(np.int64)] = True
    first = np.append(first, len(grams))
    return Index(np.array(owner, np.int64), segments, hashes, first, of[order], offset[order], seen)


@dataclass
class ShortIndex:
    """Items of one length below that of a q-gram, by their hash."""

    item: np.ndarray
    codes: np.ndarray
    hashes: np.ndarray


def build_short_indexes(items: list[tuple[int, str]], o: MatchOptions) -> list[ShortIndex]:
    """One index for each length from 1 to ``o.q`` - 1; items without a character have none."""
    own: dict[int, list[tuple[int, np.ndarray]]] = {}
    for item, text in items:
        codes, _ = normalised(text.strip())
        if 0 < len(codes) < o.q:
            own.setdefault(len(codes), []).append((item, codes))
    found = []
    for m in sorted(own):
        codes = np.stack([c for _, c in own[m]])
        hashes = np.array([gram_hashes(c, m)[0] for c in codes], np.uint64)
        order = np.argsort(hashes, kind="stable")
        found.append(ShortIndex(np.array([i for i, _ in own[m]], np.int64)[order], codes[order], hashes[order]))
    return found


@functools.cache
def _word_table() -> np.ndarray:
    """Which code points are letters, digits or the underscore; the last entry stands for none."""
    table = np.fromiter((chr(c).isalnum() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    table[ord("_")] = True
    return np.append(table, False)


def short_matches(codes: np.ndarray, row_of: np.ndarray, index: ShortIndex) -> list[tuple[int, int, int, int]]:
    """(row, item, start, end) where an item stands and no word goes on beyond its ends."""
    m = index.codes.shape[1]
    if len(codes) < m:
        return []
    grams = gram_hashes(codes, m)
    low = np.searchsorted(index.hashes, grams)
    at = np.flatnonzero(index.hashes[np.minimum(low, len(index.hashes) - 1)] == grams)
    word = _word_table()[codes]  # -1 between rows is the last entry
    padded = np.concatenate([[False], word, [False]])
    inner = ~(padded[at] & word[at]) & ~(word[at + m - 1] & padded[at + m + 1])
    at = at[inner]
    count = np.searchsorted(index.hashes, grams[at], side="right") - low[at]
    place = np.arange(count.sum()) + np.repeat(low[at] - (np.cumsum(count) - count), count)
    at = np.repeat(at, count)
    same = (codes[at[:, None] + np.arange(m)] == index.codes[place]).all(1)
    at, item = at[same], index.item[place[same]]
    return list(zip(row_of[at].tolist(), item.tolist(), at.tolist(), (at + m).tolist()))


def build_indexes(items: list[tuple[int, str]], o: MatchOptions) -> list[tuple[Index, MatchOptions]]:
    """One index for each size of q-grams, with that size as its options' ``q``.

    Items shorter than ``o.q`` characters once normalised are left to ``build_short_indexes``.
    """
    own: dict[int, list[tuple[int, str]]] = {}
    for item, text in items:
        m = min(o.segment, len(normalised(text.strip())[0]))
        if m >= o.q:
            own.setdefault(o.gram(m), []).append((item, text))
    sized = [(replace(o, q=q), own[q]) for q in sorted(own)]
    return [(build_index(some, options), options) for options, some in sized]


def candidates(codes: np.ndarray, index: Index, o: MatchOptions) -> tuple[np.ndarray, np.ndarray]:
    """Segment and first diagonal of the bands that meet the bound."""
    none = np.empty(0, np.int64)
    grams = gram_hashes(codes, o.q)
    at = np.flatnonzero(index.seen[(grams & _U((1 << _BITS) - 1)).astype(np.int64)])
    if not len(at) or not len(index.hashes):
        return none, none
    place = np.minimum(np.searchsorted(index.hashes, grams[at]), len(index.hashes) - 1)
    same = index.hashes[place] == grams[at]
    at, place = at[same], place[same]
    count = index.first[place + 1] - index.first[place]
    if not count.sum():
        return none, none
    posting = np.arange(count.sum()) + np.repeat(index.first[place] - (np.cumsum(count) - count), count)
    segment = index.segment_of[posting]
    lengths = np.array([len(s) for s in index.segments])
    half = np.array([o.budget(n) + 1 for n in lengths])[segment]
    diagonal = np.repeat(at, count) - index.offset[posting]
    band = diagonal // half
    # a band is two steps of diagonals wide, so each hit counts for two bands
    band, segment = np.concatenate([band, band - 1]), np.concatenate([segment, segment])
    shift = int(-band.min())
    key, hits = np.unique(segment * (int(band.max()) + shift + 1) + band + shift, return_counts=True)
    segment, band = np.divmod(key, int(band.max()) + shift + 1)
    bound = np.array([o.bound(n) for n in lengths])[segment]
    good = hits >= bound
    segment, band = segment[good], band[good] - shift
    return segment, band * np.array([o.budget(n) + 1 for n in lengths])[segment]


def band_distance(patterns: np.ndarray, regions: np.ndarray, free_start: bool) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits that turn each pattern into a part of its region, and where that ends.

    The part starts anywhere if ``free_start``, else at the region's start. A cell is a place
    in the pattern and a diagonal; only the band's diagonals, as many as a region is longer
    than a pattern and one more, are looked at.
    """
    n, m = patterns.shape
    width = regions.shape[1] - m + 1
    steps = np.arange(width, dtype=np.int32)
    best = np.zeros((n, width), np.int32) if free_start else np.tile(steps, (n, 1))
    for i in range(m):
        cost = best + (regions[:, i : i + width] != patterns[:, i : i + 1])
        # a character of the pattern is left out
        np.minimum(cost[:, :-1], best[:, 1:] + 1, out=cost[:, :-1])
        cost -= steps  # one of the text is extra
        np.minimum.accumulate(cost, axis=1, out=cost)
        best = cost + steps
    end = best.argmin(1)
    return best[np.arange(n), end], end + m


def matches(codes: np.ndarray, row_of: np.ndarray, index: Index, o: MatchOptions) -> list[tuple[int, int, int, int]]:
    """Distinct (row, item, start, end) of segments found within one row; row -1 separates rows."""
    segment, first = candidates(codes, index, o)
    if not len(segment):
        return []
    found = set()
    codes, lengths = codes.astype(np.int32), np.array([len(s) for s in index.segments])[segment]
    for m in np.unique(lengths).tolist():
        own = lengths == m
        patterns = np.stack([index.segments[s] for s in segment[own]]).astype(np.int32)
        edits = o.budget(m)
        at = first[own][:, None] - edits // 2 + np.arange(m + 3 * edits + 2)
        inside = (at >= 0) & (at < len(codes))
        regions = np.where(inside, codes[np.clip(at, 0, len(codes) - 1)], -1)
        distance, end = band_distance(patterns, regions, True)
        good = np.flatnonzero(distance <= edits)
        if not len(good):
            continue
        # backwards from the end, to find the start
        back = end[good][:, None] - 1 - np.arange(m + edits)
        reverse = np.where(back >= 0, np.take_along_axis(regions[good], np.maximum(back, 0), 1), -1)
        _, length = band_distance(patterns[good][:, ::-1], reverse, False)
        stop = at[good, 0] + end[good]
        start = np.maximum(0, stop - length)
        for item, a, b in zip(index.item[segment[own][good]].tolist(), start.tolist(), stop.tolist()):
            if row_of[a] >= 0 and (row_of[a:b] == row_of[a]).all():
                found.add((int(row_of[a]), item, a, b))
    return sorted(found)


_FOUND = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def _match(
    batches: Iterator[pa.RecordBatch],
    indexes: list[tuple[Index, MatchOptions]],
    short: list[ShortIndex],
    o: MatchOptions,
) -> Iterator[pa.RecordBatch]:
    gap = np.full(o.segment, -1, np.int64)
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        found: list[list[dict]] = [[] for _ in texts]
        at = 0
        while at < len(texts):
            parts, rows, places, size = [], [], [], 0
            while at < len(texts) and (size < 1 << 19 or not parts):
                codes, place = normalised(texts[at])
                parts += [codes, gap]
                rows += [np.full(len(codes), at), gap]
                places += [place, gap]
                size += len(codes)
                at += 1
            place, codes, row_of = np.concatenate(places), np.concatenate(parts), np.concatenate(rows)
            hits = {hit for index, own in indexes for hit in matches(codes, row_of, index, own)}
            hits.update(hit for index in short for hit in short_matches(codes, row_of, index))
            for row, item, start, stop in sorted(hits):
                found[row].append({"item_id": item, "start": int(place[start]), "end": int(place[stop - 1]) + 1})
        found = [sorted(f, key=lambda x: (x["start"], x["item_id"], x["end"])) for f in found]
        keep = [n for n in batch.schema.names if n != "found"]
        if "found" in batch.schema.names:  # of earlier parts of the benchmark
            found = [a + b for a, b in zip(batch.column("found").to_pylist(), found)]
        yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(found, _FOUND)], names=[*keep, "found"])


def match(docs: DataFrame, benchmark: DataFrame, o: MatchOptions = MatchOptions()) -> DataFrame:
    """All columns of ``docs`` and ``found``: (item_id, start, end) of benchmark segments.

    Offsets are code points of the text, ends exclusive, sorted by start. Null and empty texts
    have none; null and blank benchmark texts are not searched for. All others are, within the
    edits allowed for their length; those shorter than ``q`` characters allow none, and no letter
    or digit may go on with a word beyond their ends. Very long texts are matched whole.
    A null item_id is -1. Repeated rows are matched each; items that repeat are each reported.
    An empty benchmark finds nothing, and an empty table gives no rows. A column of ``docs``
    that is called ``found`` is replaced. Narrow: no shuffle. The benchmark's size is taken
    first; tasks hold at most ``part_chars`` of it at a time.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(-1)).alias("item_id"), "text")
    items = items.where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / o.part_chars))
    docs = docs.drop("found")
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        texts = sorted((r["item_id"], r["text"]) for r in own)
        indexes, short = build_indexes(texts, o), build_short_indexes(texts, o)
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "found")
        schema = f"{kept}, found array<struct<item_id:long,start:long,end:long>>"
        docs = docs.mapInArrow(lambda it, indexes=indexes, short=short: _match(it, indexes, short, o), schema)
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame, o: MatchOptions = MatchOptions()) -> DataFrame:
    """doc_id, contaminated, items (sorted, distinct) and spans ("start:end", merged) per row."""
    found = match(docs.select("doc_id", "text"), benchmark, o)
    merged = F.aggregate(
        F.sort_array(F.transform("found", lambda x: F.struct(x["start"], x["end"]))),
        F.array().cast("array<struct<start:long,end:long>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    )
    return found.select(
        "doc_id",
        (F.size("found") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.transform("found", lambda x: x["item_id"]))).alias("items"),
        F.array_join(F.transform(merged, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, o: MatchOptions = MatchOptions()) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark segment is found. Narrow.

    Columns of any name pass through as they are, one called ``found`` too. Null and empty
    texts and repeated rows stay.
    """
    inner = {name: name if name == "text" else f"c{i}" for i, name in enumerate(docs.columns)}
    rows = docs.select(*(F.col(name).alias(other) for name, other in inner.items()))
    clean = match(rows, benchmark, o).where(F.size("found") == 0)
    return clean.select(*(F.col(other).alias(name) for name, other in inner.items()))
