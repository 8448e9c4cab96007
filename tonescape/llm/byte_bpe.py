"""Byte-level byte-pair encoding and decoding of whole texts from a public rank file.

A text is cut into pieces by the vocabulary's pattern, and each piece is merged by itself:
of all neighbouring parts the pair with the lowest rank is joined, the leftmost one where
ranks are equal, until no pair has a rank. The ranks of a piece's pairs stand in a segment
tree over its byte positions, whose root is the leftmost minimum. A merge changes the pairs
of three live positions (its own, the one that vanishes, and the one before it), each a
point update up the tree, so a piece of n bytes costs O(n log n) however long it is.

Most pieces of a corpus are repeats, so each distinct one is merged once per process, and
the short ones of a run of texts together: their trees are the rows of one array, and a step
takes one merge in each. Encoding and decoding are narrow: rows are neither shuffled nor sorted.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

#: Distinct pieces kept per process (beyond that the table is begun anew), and the bytes of
#: the longest ones that are merged together and kept.
CACHED_PIECES = 400_000
SHORT = 64
#: Trees in one array, pieces of one text held at a time, and bytes of a run of texts.
TREES = 1 << 14
PIECES = 1 << 20
RUN_BYTES = 1 << 20

_NO_RANK = (1 << 31) - 1


class LeftmostMin:
    """A segment tree over positions 0 .. n-1: the least value and its leftmost place.

    Node 1 is the root, node k has children 2k and 2k+1, position i is node ``size + i``.
    """

    def __init__(self, values: list[int]):
        size = 1
        while size < len(values):
            size *= 2
        self._size = size
        self._node = node = array("i", bytes(4 * size))
        node.extend(values)
        node.extend([_NO_RANK] * (2 * size - len(node)))
        for k in range(size - 1, 0, -1):
            left, right = node[2 * k], node[2 * k + 1]
            node[k] = left if left <= right else right

    def least(self) -> int:
        return self._node[1]

    def place(self) -> int:
        """The leftmost position of the least value: left wherever left has it."""
        node, k, least = self._node, 1, self._node[1]
        while k < self._size:
            k *= 2
            if node[k] != least:
                k += 1
        return k - self._size

    def put(self, place: int, value: int) -> None:
        """Set one value and the minima above it, up to the first that stays."""
        node, k = self._node, self._size + place
        node[k] = value
        while k > 1:
            other = node[k ^ 1]
            least = value if value <= other else other
            k >>= 1
            if node[k] == least:
                return
            node[k] = value = least


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece. A piece that is a token itself is that token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, rank = len(piece), ranks.get
    following = array("q", range(1, n + 1))  # where the part at a live position ends
    previous = array("q", range(-1, n - 1))
    tree = LeftmostMin([rank(piece[i : i + 2], _NO_RANK) for i in range(n - 1)])
    while tree.least() != _NO_RANK:
        here = tree.place()
        gone = following[here]
        end = following[here] = following[gone]
        tree.put(gone, _NO_RANK) if gone < n - 1 else None
        if end < n:
            previous[end] = here
            tree.put(here, rank(piece[here : following[end]], _NO_RANK))
        else:
            tree.put(here, _NO_RANK)
        if here:
            start = previous[here]
            tree.put(start, rank(piece[start:end], _NO_RANK))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : following[at]]])
        at = following[at]
    return ids


class PairRanks:
    """Ranks of pairs of token ids, for whole arrays: a sorted table of the pairs that join."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self._keys = np.array(sorted(pairs), np.int64)
        self._ranks = np.array([pairs[key] for key in self._keys.tolist()] + [_NO_RANK], np.int32)
        self._keys = np.append(self._keys, np.int64(-1))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        place = np.searchsorted(self._keys[:-1], key)
        return np.where(self._keys[place] == key, self._ranks[place], np.int32(_NO_RANK))


def merge_together(pieces: list[bytes], size: int, byte_id: np.ndarray, pairs: PairRanks) -> list[bytes]:
    """The ids of pieces of 2 to ``size`` bytes, a power of two; the same steps as ``merge``.

    Row w of each array is one piece: its tokens by start, its live neighbours, its tree.
    """
    count = len(pieces)
    length = np.array([len(piece) for piece in pieces])
    inside = np.arange(size) < length[:, None]
    token = np.full((count, size + 1), -1, np.int32)
    token[:, :size][inside] = byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
    following = np.tile(np.arange(1, size + 2, dtype=np.int16), (count, 1))
    previous = np.tile(np.arange(-1, size, dtype=np.int16), (count, 1))
    node = np.full((count, 2 * size), _NO_RANK, np.int32)
    row, place = np.nonzero(inside[:, 1:])
    node[row, size + place] = pairs.of(token[row, place], token[row, place + 1])
    level = size
    while level > 1:
        level //= 2
        node[:, level : 2 * level] = np.minimum(node[:, 2 * level : 4 * level : 2], node[:, 2 * level + 1 : 4 * level : 2])
    row = np.flatnonzero(node[:, 1] != _NO_RANK)
    while len(row):
        least, k = node[row, 1], np.ones(len(row), np.int64)
        while k[0] < size:
            k *= 2
            k += node[row, k] != least
        here = k - size
        gone = following[row, here].astype(np.int64)
        end = following[row, gone].astype(np.int64)
        token[row, here], token[row, gone] = least, -1
        following[row, here] = end
        previous[row, end] = here
        start = np.maximum(previous[row, here], 0).astype(np.int64)
        after = token[row, end]  # -1 at the piece's end
        node[row, size + gone % size] = _NO_RANK
        node[row, size + start] = pairs.of(token[row, start], least)
        node[row, size + here] = np.where(after < 0, _NO_RANK, pairs.of(least, np.maximum(after, 0)))
        k = np.stack([start, here, gone % size]) + size
        while k[0, 0] > 1:
            k >>= 1
            node[row, k] = np.minimum(node[row, 2 * k], node[row, 2 * k + 1])
        row = row[node[row, 1] != _NO_RANK]
    live = token >= 0
    ids = token[live].astype("<u4").tobytes()
    bounds = np.append(0, 4 * np.cumsum(live.sum(1))).tolist()
    return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


class Codec(dict):
    """Piece of text -> its ids as little-endian unsigned 32-bit bytes, filled as texts come."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self._byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self._pairs = PairRanks(self.ranks)
        self._pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> bytes:
        """A long piece: merged by itself and not kept."""
        return array("I", merge(piece.encode(), self.ranks)).tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """Add the short ones of some pieces, those of like length together."""
        if len(self) + len(pieces) > CACHED_PIECES:
            self.clear()
        by_size: dict[int, list[str]] = {}
        for piece in pieces:
            raw = piece.encode()
            if raw in self.ranks:
                self[piece] = self.ranks[raw].to_bytes(4, "little")
            elif len(raw) <= SHORT:
                by_size.setdefault(1 << (len(raw) - 1).bit_length(), []).append(piece)
        for size, alike in by_size.items():
            for start in range(0, len(alike), TREES):
                some = alike[start : start + TREES]
                merged = merge_together([p.encode() for p in some], size, self._byte_id, self._pairs)
                self.update(zip(some, merged))

    def _ids(self, runs: list[list[str]]) -> list[bytes]:
        new = set().union(*runs)
        self._learn(new.difference(self) if len(self) + len(new) <= CACHED_PIECES else new)
        return [b"".join([self[piece] for piece in pieces]) for pieces in runs]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids. Pieces are held for all texts but for those beyond ``PIECES``."""
        short = self._ids([self._pattern.findall(text) if len(text) <= PIECES else [] for text in texts])
        return [ids if len(text) <= PIECES else self._long(text) for text, ids in zip(texts, short)]

    def _long(self, text: str) -> bytes:
        found, out = self._pattern.finditer(text), []
        while some := [match.group() for match in islice(found, PIECES)]:
            out += self._ids([some])
        return b"".join(out)

    def decode(self, rows: list[bytes]) -> list[bytes]:
        """The bytes that ids stand for; an id outside the vocabulary raises ``KeyError``."""
        return [self._bytes(ids) for ids in rows]

    def _bytes(self, ids: bytes) -> bytes:
        tokens, out = self.tokens, []
        for start in range(0, len(ids), 4 * PIECES):
            out.append(b"".join([tokens[i] for i in memoryview(ids)[start : start + 4 * PIECES].cast("I")]))
        return b"".join(out)


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The process's codec for a rank file."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _with_column(df: DataFrame, source: str, target: str, work, empty) -> DataFrame:
    """``df`` with a binary column ``target`` at the end: ``work`` on ``source``, nulls as ``empty``.

    Works on runs of rows of about ``RUN_BYTES`` (a longer value by itself).
    """
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index(source))
            before = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(column):
                end = int(np.searchsorted(before, before[start] + RUN_BYTES, side="right"))
                values = [empty if value is None else value for value in column[start:end].to_pylist()]
                rows = batch.slice(start, end - start)
                columns = [*rows.columns, pa.array(work(values), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, target])
                start = end

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(target, BinaryType())]))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each whole text, as little-endian unsigned 32-bit integers.

    Strings of special tokens are ordinary text. Null or empty text: no ids. Repeated rows
    are encoded each; an empty table stays empty. A very long text is cut into pieces a
    bounded number at a time, and a single very long piece costs n log n. All other columns
    pass through, nulls included; a column that is already named as ``ids`` is replaced.
    """
    return _with_column(docs.drop(ids), text, ids, lambda texts: codec(path, pattern).encode(texts), "")


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that each row's ids stand for; null or no ids: no bytes.

    A column already named as ``out`` is replaced; all others pass through.
    """
    return _with_column(encoded.drop(out), ids, out, lambda rows: codec(path, pattern).decode(rows), b"")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of their decoded bytes, per row of ``docs``.

    Edge cases as in ``encode``; a row without text has the digest of no bytes.
    """
    coded = decode(encode(docs.select("doc_id", "text"), path, pattern).drop("text"), path, pattern)
    return coded.select(
        "doc_id",
        F.expr("octet_length(token_ids) div 4").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
