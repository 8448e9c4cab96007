"""Repeated word windows, found through super-k-mers in minimiser buckets.

Every window of ``window`` words has a minimiser, the smallest hash among its runs of
``minimiser`` words. Equal windows have equal minimisers, so windows are dealt to buckets
by it; consecutive windows that share one travel together as one string of words instead
of a string each. In its bucket, windows are sorted and equal ones meet.

A task first finds repeats among its own texts. Only the earliest window of each kind goes
on, so a passage that stands everywhere sends one window per task, not one per document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.llm import wordcode as wc


@dataclass(frozen=True)
class WindowOptions:
    """``window`` words are compared; ``minimiser`` words choose the bucket. ``chunk_bytes``
    of text are searched together in a task; a bucket gets about ``bucket_bytes``."""

    window: int = 20
    minimiser: int = 4
    chunk_bytes: int = 8 << 20
    bucket_bytes: int = 8 << 20


def later_copies(codes: np.ndarray, at: np.ndarray, place: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Which windows have the words of a window that starts strictly earlier.

    ``at`` are the windows' first words in ``codes``; ``place`` (rank of the document) and
    ``start`` say what is earlier. Windows are sorted by hash and then compared word by word.
    """
    flagged = np.zeros(len(at), bool)
    if len(at) < 2:
        return flagged
    key = wc.ngram_hashes(codes, n)[at]
    step = np.diff(place)
    sorted_ = np.all((step > 0) | (step == 0) & (np.diff(start) >= 0))
    by_age = np.arange(len(at)) if sorted_ else np.lexsort((start, place))
    order = by_age[np.argsort(key[by_age], kind="stable")]
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    if new.all():
        return flagged
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    copy = np.flatnonzero(~new)
    own, first = order[copy], head[copy]
    same = np.ones(len(own), bool)
    for k in range(n):
        same &= codes[at[own] + k] == codes[at[first] + k]
    later = (place[own] != place[first]) | (start[own] != start[first])
    flagged[own[same & later]] = True
    for i in np.flatnonzero(~same):  # another window with the same hash
        twins = order[key == key[copy[i]]]
        words = [tuple(codes[at[t] : at[t] + n]) for t in twins]
        mine = int(np.flatnonzero(twins == own[i])[0])
        flagged[own[i]] = any(
            words[j] == words[mine] and (place[t], start[t]) < (place[own[i]], start[own[i]])
            for j, t in enumerate(twins)
        )
    return flagged


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values."""
    have, span = values, 1
    while span * 2 <= n:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = n - span
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def runs_of(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of runs; ``breaks[i]`` is true where a run begins."""
    first = np.flatnonzero(breaks)
    return first, np.diff(np.append(first, len(breaks)))


# --- Blobs: what travels to a bucket ------------------------------------------------------


def pack_blob(doc, text_hash, start, size, text: bytes) -> bytes:
    """Super-k-mers (or, with no text, runs of windows already found) as one string."""
    head = np.array([len(doc), len(text)], np.int64).tobytes()
    body = b"".join(np.ascontiguousarray(a, np.int64).tobytes() for a in (doc, text_hash, start, size))
    return zstandard.ZstdCompressor(level=3).compress(head + body + text)


def unpack_blob(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, length = np.frombuffer(raw, np.int64, 2)
    return np.frombuffer(raw, np.int64, 4 * n, 16).reshape(4, n), raw[len(raw) - length :]


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The spans of ``data``, white space as blanks, each followed by a line end."""
    sizes = ends - starts + 1
    total = int(sizes.sum())
    out_start = np.cumsum(sizes) - sizes
    index = np.arange(total) - np.repeat(out_start - starts, sizes)
    index[out_start + sizes - 1] = 0
    out = data[index]
    out[wc.IS_SPACE[out]] = 32
    out[out_start + sizes - 1] = 10
    return out.tobytes()


def _chunk_blobs(chunk: wc.Chunk, doc: np.ndarray, text_hash: np.ndarray, buckets: int, o: WindowOptions):
    """(bucket, blob) for the windows of some rows; ``doc`` orders them."""
    w = wc.words(chunk)
    at = wc.whole_windows(w.before, o.window)
    if not len(at):
        return
    codes = wc.SpanHash(chunk.data).of(w.starts, w.ends)
    row = w.row[at]
    start = at - w.before[row]
    flagged = later_copies(codes, at, doc[row], start, o.window)

    # runs found here: consecutive flagged windows of one row
    f = np.flatnonzero(flagged)
    if len(f):
        first, size = runs_of(np.append(True, (np.diff(at[f]) != 1) | (np.diff(row[f]) != 0)))
        r = row[f[first]]
        blob = pack_blob(doc[r], text_hash[r], start[f[first]], size, b"")
        yield int(text_hash[r[0]] % buckets), blob

    left = np.flatnonzero(~flagged)
    at, row, start = at[left], row[left], start[left]
    grams = wc.ngram_hashes(codes, o.minimiser)
    least = sliding_min(grams, o.window - o.minimiser + 1)[at]
    first, size = runs_of(
        np.append(True, (np.diff(at) != 1) | (np.diff(row) != 0) | (least[1:] != least[:-1]))
    )
    bucket = (wc.mix(least[first]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first, size, bucket = first[order], size[order], bucket[order]
    word = at[first]
    begins, ends = w.starts[word], w.ends[word + size + o.window - 2]
    row, start = row[first], start[first]
    cut, count = runs_of(np.append(True, bucket[1:] != bucket[:-1]))
    for a, n in zip(cut, count):
        s = slice(a, a + n)
        text = _gather(chunk.data, begins[s], ends[s])
        yield int(bucket[a]), pack_blob(doc[row[s]], text_hash[row[s]], start[s], size[s], text)


def _deal(batches: Iterator[pa.RecordBatch], buckets: int, o: WindowOptions) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc").to_numpy()
        text_hash = batch.column("text_hash").to_numpy()
        for chunk in wc.chunks(batch.column("text"), o.chunk_bytes):
            own = slice(chunk.first, chunk.first + chunk.rows)
            found = list(_chunk_blobs(chunk, doc[own], text_hash[own], buckets, o))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())],
                    names=["bucket", "blob"],
                )


# --- Buckets ----------------------------------------------------------------------------


def _bucket_runs(blobs: list[bytes], o: WindowOptions) -> np.ndarray:
    """doc, text_hash, start, size of the runs of repeated windows in one bucket."""
    found, heads, texts = [], [], []
    for blob in blobs:
        head, text = unpack_blob(blob)
        if text:
            heads.append(head)
            texts.append(text)
        else:
            found.append(head)
    if heads:
        doc, text_hash, first, _ = np.concatenate(heads, axis=1)
        data = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.append(0, np.flatnonzero(data == 10) + 1)
        order = np.lexsort((first, doc))  # earliest first, as windows are compared in order
        chunk = wc.Chunk(0, bounds, data)
        w = wc.words(chunk)
        codes = wc.SpanHash(data).of(w.starts, w.ends)
        at = wc.whole_windows(w.before, o.window)
        row = w.row[at]
        age = np.empty(len(order), np.int64)
        age[order] = np.arange(len(order))
        by_age = np.argsort(age[row], kind="stable")
        at, row = at[by_age], row[by_age]
        start = first[row] + at - w.before[row]
        flagged = np.flatnonzero(later_copies(codes, at, doc[row], start, o.window))
        if len(flagged):
            at, row, start = at[flagged], row[flagged], start[flagged]
            head, size = runs_of(np.append(True, (np.diff(at) != 1) | (np.diff(row) != 0)))
            found.append(np.stack([doc[row[head]], text_hash[row[head]], start[head], size]))
    return np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)


def _search(batches: Iterator[pa.RecordBatch], o: WindowOptions) -> Iterator[pa.RecordBatch]:
    """Buckets arrive one after another; each is searched when its last blob has come."""

    def result(blobs: list[bytes]) -> pa.RecordBatch:
        arrays = [pa.array(np.ascontiguousarray(a)) for a in _bucket_runs(blobs, o)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc", "text_hash", "start", "size"])

    bucket, blobs = None, []
    for batch in batches:
        for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob")):
            if b != bucket and blobs:
                yield result(blobs)
                blobs = []
            bucket = b
            blobs.append(blob.as_py())
    if blobs:
        yield result(blobs)


def repeated_runs(docs: DataFrame, o: WindowOptions = WindowOptions()) -> DataFrame:
    """doc, text_hash, start, size: runs of windows that also start earlier.

    ``docs`` has doc (long), text_hash (long) and text. A run may be cut into several rows.
    The number of buckets follows the bytes of text, so a bucket's size does not grow.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / (8 * o.bucket_bytes)))
    buckets = tasks * max(1, math.ceil(3 * total / o.bucket_bytes / tasks))
    dealt = docs.select("doc", "text_hash", "text").mapInArrow(
        lambda it: _deal(it, buckets, o), "bucket long, blob binary"
    )
    sorted_ = dealt.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return sorted_.mapInArrow(lambda it: _search(it, o), "doc long, text_hash long, start long, size long")


# --- Removal ----------------------------------------------------------------------------


def covered_words(n: int, runs: list[tuple[int, int]], window: int) -> np.ndarray:
    """Which of a text's n words lie in a window of the runs (start, number of windows)."""
    depth = np.zeros(n + 1, np.int64)
    for start, size in runs:
        depth[start] += 1
        depth[start + size + window - 1] -= 1
    return np.cumsum(depth[:n]) > 0


def _remove(batches: Iterator[pa.RecordBatch], window: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, digests, texts = [], [], [], []
        runs = batch.column("runs")
        for i, text in enumerate(batch.column("text")):
            words = (text.as_py() or "").encode().split()
            own = runs[i].as_py()
            counts.append(len(words))
            gone = 0
            if own:
                cover = covered_words(len(words), [(r["start"], r["size"]) for r in own], window)
                gone = int(cover.sum())
                words = list(compress(words, (~cover).tolist()))
            removed.append(gone)
            kept = b" ".join(words)
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept.decode())
        columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns.append(pa.array(texts, pa.string()))
            names.append("kept_text")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_repeats(docs: DataFrame, o: WindowOptions = WindowOptions(), with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text on request) of every row.

    Words are maximal runs without ASCII white space. A word goes if a window over it has
    the words of a window of a smaller doc_id, or of an earlier start in the same document;
    doc_id is an integer. Null text: no words. Null doc_id: smaller than all others, and one
    document. Rows that repeat a doc_id are one document that stands there several times:
    equal windows at the same start are not earlier than each other. An empty table gives no
    rows. Other columns are not read. Texts cross the network once in super-k-mers and once
    to meet their runs.
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
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string"
    return joined.mapInArrow(
        lambda it: _remove(it, o.window, with_text), schema + ", kept_text string" * with_text
    )
