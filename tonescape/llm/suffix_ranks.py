"""Byte strings that stand more than once in a corpus, by distributed prefix doubling.

A position's rank says which other positions begin with the same bytes. Ranks of short
prefixes are doubled: sorting the pairs (rank here, rank at the offset) ranks prefixes
twice as long, and a position whose rank is unique drops out. Ranking every byte would
sort the corpus many times over, so only anchors are ranked: the positions that are the
minimiser (smallest hash of ``gram`` bytes) of a stretch of ``stretch`` of them. A prefix
is measured in anchors: from one to the n-th after it.

A string of ``size`` bytes contains its own first anchor and the anchors next to it, so
equal strings meet at anchors of equal rank; an anchor of unique rank, with all strings
that it owns, is done. Doubling ends where a prefix might leave the string. The strings
owned by what is left (a small part of most corpora) travel to their rank's bucket,
consecutive ones as one piece of text, and are compared there.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonescape.llm import wordcode as wc
from tonescape.llm.storage import Stored, small_batches
from tonescape.llm.super_kmers import runs_of


@dataclass(frozen=True)
class SuffixOptions:
    """``size``: bytes of a string. ``stretch`` and ``gram`` choose the anchors;
    3 * stretch + gram must not exceed size + 1. ``chunk_bytes`` of text are worked on
    together, a bucket gets about ``bucket_bytes``. A rank with more than ``hot_anchors``
    anchors is dealt string by string, by hash. ``batch_rows`` texts are handed over at a time,
    and tables are written in row groups of ``group_bytes``; both bound a task's memory."""

    size: int = 400
    stretch: int = 128
    gram: int = 16
    chunk_bytes: int = 2 << 20
    bucket_bytes: int = 8 << 20
    hot_anchors: int = 5_000
    batch_rows: int = 1_000
    group_bytes: int = 16 << 20

    @property
    def zone(self) -> int:
        """How far after an anchor a later one's stretch may begin to lie in all its strings."""
        return self.size - self.stretch - self.gram + 1 - (self.stretch - 1)

    def __post_init__(self):
        if 3 * self.stretch + self.gram > self.size + 1:
            raise ValueError("3 * stretch + gram must not exceed size + 1")


# --- Anchors ----------------------------------------------------------------------------


def leftmost_min(values: np.ndarray, n: int) -> np.ndarray:
    """Position of the smallest of each n consecutive values, the first of equal ones."""
    at, span = np.arange(len(values), dtype=np.int32), 1

    def join(shift):
        nonlocal at, values
        left, right = values[:-shift], values[shift:]
        take = right < left
        at = np.where(take, at[shift:], at[:-shift])
        values = np.where(take, right, left)

    while span * 2 <= n:
        join(span)
        span *= 2
    if n > span:
        join(n - span)
    return at


def anchors(chunk: wc.Chunk, o: SuffixOptions):
    """row, anchor, first owned string, strings owned, and the chunk's hasher.

    A string's anchor is the minimiser of its first ``stretch`` positions.
    """
    spans = wc.SpanHash(chunk.data)
    n = len(chunk.data) - o.gram + 1
    long = np.diff(chunk.bounds) >= o.size
    if n < o.stretch or not long.any():
        none = np.empty(0, np.int64)
        return none, none, none, none, spans
    at = np.arange(n)
    least = leftmost_min(spans.of(at, at + o.gram), o.stretch)
    begin = chunk.bounds[:-1][long]
    # stretches wholly within a row; also those that start no string, as they bound prefixes
    count = np.diff(chunk.bounds)[long] - (o.stretch + o.gram - 1) + 1
    row = np.repeat(np.flatnonzero(long), count)
    x = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
    mine = least[x]
    first, owned = runs_of(np.append(True, (mine[1:] != mine[:-1]) | (row[1:] != row[:-1])))
    return row[first], mine[first].astype(np.int64), x[first], owned, spans


def _emit(batches: Iterator[pa.RecordBatch], o: SuffixOptions) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, text_hash = (batch.column(c).to_numpy() for c in ("doc", "text_hash"))
        for chunk in wc.chunks(batch.column("text")):
            row, anchor, lo, owned, spans = anchors(chunk, o)
            if len(row) < 3:
                continue
            n = len(row) - 2
            whole = row[2:] == row[:-2]
            key = spans.of(anchor[:-2], anchor[2:] + o.gram)[whole].astype(np.int64)
            start = chunk.bounds[row[:n]]
            # strings owned that fit into the text
            fit = np.minimum(owned[:n], chunk.bounds[row[:n] + 1] - o.size + 1 - lo[:n])
            number = np.arange(n) - np.searchsorted(row, row[:n])
            # anchors after this one that lie in every string it owns
            depth = np.searchsorted(lo, np.minimum(anchor[:n] + o.zone, chunk.bounds[row[:n] + 1]), side="right")
            depth = np.minimum(depth, np.searchsorted(row, row[:n], side="right")) - 1 - np.arange(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    pa.array(doc[chunk.first + row[:n][whole]]),
                    pa.array(text_hash[chunk.first + row[:n][whole]]),
                    pa.array(number[whole].astype(np.int32)),
                    pa.array(depth[whole].astype(np.int32)),
                    pa.array((lo[:n] - start)[whole].astype(np.int32)),
                    pa.array(fit[whole].astype(np.int32)),
                ],
                names=["key", "doc", "text_hash", "number", "depth", "lo", "fit"],
            )


# --- Doubling ---------------------------------------------------------------------------


def rerank(rows: DataFrame, keys: list[str], o: SuffixOptions) -> Stored:
    """``rows`` whose keys stand there twice or more, with ``rank`` and ``hot``, stored.

    Distinct keys are counted (partly before the shuffle) and sorted; a rank is a place in
    that order.
    """
    kinds = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    kinds = kinds.select(*keys, (F.col("n") > o.hot_anchors).alias("hot"))
    ranks = Stored(kinds.sort(*keys).withColumn("rank", F.monotonically_increasing_id()), "ranks")
    live = Stored(rows.join(ranks.frame, keys).drop(*keys), "live")
    ranks.drop()
    return live


def repeated_anchors(docs: DataFrame, o: SuffixOptions) -> list[Stored]:
    """Tables of doc, text_hash, lo, fit, level, rank, hot: anchors that share their prefix.

    The first ranks are of prefixes of two anchors. A rank holds only within its level.
    """
    columns = "doc long, text_hash long, number int, depth int, lo int, fit int"
    with small_batches(docs.sparkSession, o.batch_rows):
        base = Stored(docs.mapInArrow(lambda it: _emit(it, o), f"key long, {columns}"), "anchors", o.group_bytes)
    live = rerank(base.frame, ["key"], o)
    base.drop()
    step, done = 2, []
    while True:
        past = live.frame.where((F.col("depth") < 2 * step) & (F.col("fit") > 0))
        past = past.withColumn("level", F.lit(step)).drop("number", "depth")
        done.append(Stored(past, "past"))
        order = Window.partitionBy("doc", "text_hash").orderBy("number").rangeBetween(step, step)
        pairs = live.frame.withColumn("other", F.first("rank").over(order))
        pairs = pairs.where((F.col("depth") >= 2 * step) & F.col("other").isNotNull())
        paired = Stored(pairs.withColumnRenamed("rank", "own").drop("hot"), "pairs")
        live.drop()
        if paired.frame.isEmpty():
            paired.drop()
            return done
        live = rerank(paired.frame, ["own", "other"], o)
        paired.drop()
        step *= 2


# --- Strings of anchors that are left ------------------------------------------------------


def _blob(arrays: np.ndarray, text: bytes) -> bytes:
    head = np.array([arrays.shape[0], arrays.shape[1]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + np.ascontiguousarray(arrays, np.int64).tobytes() + text)


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    k, n = np.frombuffer(raw, np.int64, 2)
    return np.frombuffer(raw, np.int64, k * n, 16).reshape(k, n), np.frombuffer(raw, np.uint8, offset=16 + 8 * k * n)


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] of them, one after another."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


def _sides(spans: wc.SpanHash, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each string, of its halves: 128 bits in all tell strings apart."""
    half = size // 2
    return spans.of(at, at + half), spans.of(at + half, at + size)


def split_by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key and the places where it stands."""
    order = np.argsort(keys, kind="stable")
    if len(order):
        own = keys[order]
        for a, n in zip(*runs_of(np.append(True, own[1:] != own[:-1]))):
            yield int(own[a]), order[a : a + n]


def repeated(one: np.ndarray, two: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which strings stand twice or more (by weight), and which are the first of their kind."""
    order = np.lexsort((two, one))
    new = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=weight[order])
    flags, head = np.zeros(len(one), bool), np.zeros(len(one), bool)
    flags[order] = total[group] > 1
    head[order] = new
    return flags, head


def _runs(doc, text_hash, start) -> np.ndarray:
    """doc, text_hash, start, size of runs of consecutive starts."""
    if not len(start):
        return np.empty((4, 0), np.int64)
    broken = (np.diff(start) != 1) | (np.diff(doc) != 0) | (np.diff(text_hash) != 0)
    first, size = runs_of(np.append(True, broken))
    return np.stack([doc[first], text_hash[first], start[first], size])


def _deal(batches: Iterator[pa.RecordBatch], buckets: int, o: SuffixOptions) -> Iterator[pa.RecordBatch]:
    """Per chunk: which owned strings repeat within it, and one of each kind to its bucket."""
    for batch in batches:
        doc, text_hash = (batch.column(c).to_numpy() for c in ("doc", "text_hash"))
        lists = batch.column("owned")
        offsets = lists.offsets.to_numpy()
        flat = lists.values
        lo, fit, level, rank, hot = (
            flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)
        )
        for chunk in wc.chunks(batch.column("text"), o.chunk_bytes):
            a, b = offsets[chunk.first], offsets[chunk.first + chunk.rows]
            if a == b:
                continue
            row = np.repeat(np.arange(chunk.rows), np.diff(offsets[chunk.first : chunk.first + chunk.rows + 1]))
            begin, count = lo[a:b] + chunk.bounds[row], fit[a:b].astype(np.int64)
            at, own = _expand(begin, count), np.repeat(np.arange(b - a), count)
            spans = wc.SpanHash(chunk.data)
            one, two = _sides(spans, at, o.size)
            flags, head = repeated(one, two, np.ones(len(at)))
            d, t = doc[chunk.first + row], text_hash[chunk.first + row]
            start = at - chunk.bounds[row[own]]
            # what is known here already
            found = _runs(d[own][flags], t[own][flags], start[flags])
            blobs = [(int(t[0] % buckets), 0, _blob(found, b""))] if found.shape[1] else []
            # a hot rank's strings go by their hash, as hashes
            is_hot = hot[a:b][own].astype(bool)
            pick = np.flatnonzero(head & is_hot)
            where = (wc.mix(one[pick]) % np.uint64(buckets)).astype(np.int64)
            for k, p in split_by(where):
                p = pick[p]
                arrays = np.stack([d[own[p]], t[own[p]], start[p], flags[p], one[p].view(np.int64), two[p].view(np.int64)])
                blobs.append((int(k), 1, _blob(arrays, b"")))
            # the others go to their rank's bucket, consecutive ones as one text
            pick = np.flatnonzero(head & ~is_hot)
            if len(pick):
                first, size = runs_of(np.append(True, (np.diff(at[pick]) != 1) | (np.diff(own[pick]) != 0)))
                first = pick[first]
                key = rank[a:b][own[first]].astype(np.uint64) * np.uint64(64) + level[a:b][own[first]].astype(np.uint64)
                where = (wc.mix(key) % np.uint64(buckets)).astype(np.int64)
                known = flags.astype(np.int64)
                for k, p in split_by(where):
                    p, n = first[p], size[p]
                    text = chunk.data[_expand(at[p], n + o.size - 1)].tobytes()
                    marks = np.packbits(known[_expand(p, n)].astype(bool)).tobytes()
                    arrays = np.stack([d[own[p]], t[own[p]], start[p], n])
                    blobs.append((int(k), 2, _blob(arrays, marks + text)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in blobs], pa.int64()),
                    pa.array([x[1] for x in blobs], pa.int32()),
                    pa.array([x[2] for x in blobs], pa.binary()),
                ],
                names=["bucket", "kind", "blob"],
            )


def _bucket_runs(blobs: list[tuple[int, bytes]], o: SuffixOptions) -> np.ndarray:
    """The runs of repeated strings that a bucket finds, and those found before it."""
    found, parts = [], []
    for kind, blob in blobs:
        arrays, rest = _unblob(blob)
        if kind == 0:
            found.append(arrays)
        elif kind == 1:
            parts.append((*arrays[:4], arrays[4].view(np.uint64), arrays[5].view(np.uint64)))
        else:
            doc, text_hash, start, n = arrays
            total = int(n.sum())
            marks = np.unpackbits(rest[: -(-total // 8)])[:total]
            data = rest[-(-total // 8) :]
            size = n + o.size - 1
            at = _expand(np.cumsum(size) - size, n)
            own = np.repeat(np.arange(len(n)), n)
            parts.append((doc[own], text_hash[own], _expand(start, n), marks.astype(np.int64), *_sides(wc.SpanHash(data), at, o.size)))
    if parts:
        doc, text_hash, start, known, one, two = (np.concatenate(c) for c in zip(*parts))
        flags, _ = repeated(one, two, 1 + known)
        flags &= known == 0  # those are among the runs already
        found.append(_runs(doc[flags], text_hash[flags], start[flags]))
    return np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)


def _search(batches: Iterator[pa.RecordBatch], o: SuffixOptions) -> Iterator[pa.RecordBatch]:
    def result(blobs) -> pa.RecordBatch:
        arrays = [pa.array(np.ascontiguousarray(x)) for x in _bucket_runs(blobs, o)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc", "text_hash", "start", "size"])

    bucket, blobs = None, []
    for batch in batches:
        for b, kind, blob in zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist(), batch.column("blob")):
            if b != bucket and blobs:
                yield result(blobs)
                blobs = []
            bucket = b
            blobs.append((kind, blob.as_py()))
    if blobs:
        yield result(blobs)


def repeated_runs(docs: DataFrame, o: SuffixOptions = SuffixOptions()) -> DataFrame:
    """doc, text_hash, start, size: runs of strings that also start anywhere else, stored.

    ``docs`` has doc (long), text_hash (long) and text. A run may be cut into several rows.
    """
    spark = docs.sparkSession
    levels = repeated_anchors(docs, o)
    left = levels[0].frame
    for level in levels[1:]:
        left = left.unionByName(level.frame)
    # bytes that will travel: each anchor's strings overlap in all but their first bytes
    total = left.agg(F.sum(F.col("fit") + F.lit(o.size))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / (8 * o.bucket_bytes)))
    buckets = tasks * max(1, math.ceil(total / o.bucket_bytes / tasks))
    owned = left.groupBy("doc", "text_hash").agg(
        F.collect_list(F.struct("lo", "fit", "level", "rank", "hot")).alias("owned")
    )
    # a row that stands twice is one row here; its strings repeat for that alone
    texts = docs.join(owned, ["doc", "text_hash"]).select("doc", "text_hash", "text", "owned")
    dealt = texts.mapInArrow(lambda it: _deal(it, buckets, o), "bucket long, kind int, blob binary")
    dealt = dealt.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(lambda it: _search(it, o), "doc long, text_hash long, start long, size long")
    with small_batches(spark, o.batch_rows):
        runs = Stored(found, "runs", o.group_bytes)
    for level in levels:
        level.drop()
    return runs.frame


# --- Removal ----------------------------------------------------------------------------


def covered_spans(runs: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal spans covered by strings of ``size`` bytes at the starts of the runs."""
    spans: list[tuple[int, int]] = []
    for start, count in sorted(runs):
        end = start + count + size - 1
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def _remove(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        runs = batch.column("runs")
        for i, text in enumerate(batch.column("text")):
            data = (text.as_py() or "").encode()
            spans = covered_spans([(r["start"], r["size"]) for r in runs[i].as_py() or ()], size)
            digest, at = hashlib.sha256(), 0
            for start, end in spans:
                digest.update(data[at:start])
                at = end
            digest.update(data[at:])
            rows.append((len(data), sum(e - s for s, e in spans), len(spans), digest.hexdigest(), spans))
        columns = [list(c) for c in zip(*rows)] or [[]] * 5
        spans = pa.array([[{"start": s, "end": e} for s, e in own] for own in columns[4]], _SPANS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string()), spans],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
        )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, o: SuffixOptions = SuffixOptions()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (spans) of every row.

    A byte goes if a string of ``size`` bytes over it also starts anywhere else, in the same
    text or another; all copies go. Null text: empty. doc_id is an integer; null doc_ids and
    rows that repeat are texts like any other. Texts shorter than ``size`` are kept. An empty
    table gives no rows. Other columns are not read. Texts cross the network twice, to meet
    their anchors and their runs; ranks and repeated strings are all else that does.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    runs = repeated_runs(rows, o).groupBy("doc", "text_hash")
    runs = runs.agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    joined = rows.join(runs, ["doc", "text_hash"], "left").select("doc_id", "text", "runs")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(lambda it: _remove(it, o.size), schema + ", removed array<struct<start:long,end:long>>")
