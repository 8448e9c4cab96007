"""Vector code compression: codebooks per part of a vector, refined where the members lie.

Vectors are cut into equal consecutive parts, and each part is coded by the nearest entry of
its position's codebook. The codebooks are refined by Lloyd's rounds over parts that stay
where they are: the rows are the parts, partitioned by (position, entry, salt), so that the
members of an entry lie with its owners (one per salt, so that an entry that holds a third
of all parts has many). In each round the owners add up their resident members, the sums of
an entry's owners make its new place, and only the parts whose nearest entry is now another
one travel, in the next round's shuffle. What stays is not written or sent again.

Members travel and are stored in blocks: those of one block of vectors in one entry are one
row, with their numbers and components as bytes. Sums are integers, so results do not depend
on order or partitioning.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.llm.storage import Stored
from tonescape.operators.lookup import lookup_join

#: Vectors in a block: members of one block in one entry are one row.
BLOCK = 4096
#: Owners of each entry.
SALTS = 64
#: Labels whose sums every task may have (16 bytes each).
BROADCAST_LABELS = 100_000

_LONG = np.iinfo(np.int64)
_MEMBERS = "block long, position int, entry int, salt int, slots binary, width int, parts binary"


@dataclass(frozen=True)
class CodeOptions:
    """``parts`` of a vector, ``entries`` of a codebook, ``rounds`` of refinement, and ``scale``:
    a component x becomes the integer floor(scale * x)."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


# --- Integer vectors -------------------------------------------------------------------------


def whole_vectors(column: pa.Array, scale: int, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are kept, and their scaled components as one integer array.

    Kept are rows that are not null, hold no null and no non-finite component, and have
    ``size`` components (None: at least one, and as many as the first such row). Components
    beyond 64 bits are held at their bounds.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.zeros(len(column), np.int64)
    there = ~column.is_null().to_numpy(zero_copy_only=False)
    lengths[there] = np.diff(column.offsets.to_numpy())[there] if len(column) else lengths[there]
    values = column.flatten()  # leaves out what stands under null rows
    flat = values.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    good = there & (lengths > 0)
    good[row[~np.isfinite(flat)]] = False
    if size is None:
        size = int(lengths[good][0]) if good.any() else 1
    good &= lengths == size
    scaled = np.floor(flat[good[row]] * scale)
    safe = np.clip(scaled, -(2.0**62), 2.0**62).astype(np.int64)
    return np.flatnonzero(good), safe.reshape(-1, size)


def _pack(values: np.ndarray) -> tuple[int, bytes]:
    """Integers in as few bytes each as hold them all."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return width, values.astype(f"<i{width}").tobytes()


def _unpack(width: int, raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{width}").astype(np.int64).reshape(-1, size)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each point's nearest entry (the lowest of equals) and the squared distance.

    Exact: in doubles while every value fits 53 bits, else in Python's integers. A distance
    beyond 64 bits is held at the bound.
    """
    size = points.shape[1]
    largest = max(abs(int(x)) for a in (points, entries) for x in (a.min(), a.max()))
    if 4 * size * largest**2 < 1 << 53:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        far = (e * e).sum(1) - 2 * (p @ e.T)
        best = far.argmin(1)
        return best, (far[np.arange(len(p)), best] + (p * p).sum(1)).astype(np.int64)
    p, e = points.astype(object), entries.astype(object)
    far = np.stack([((p - one) ** 2).sum(1) for one in e], 1)
    best = far.argmin(1)
    return best, np.array([min(x, _LONG.max) for x in far[np.arange(len(p)), best]], np.int64)


class Codebooks:
    """Integer entries by part position: an array (parts, entries, components of a part)."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.parts, self.entries, self.size = values.shape

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Each entry with members at the floor of their mean; the others stay."""
        values = self.values.copy()
        for (position, entry), (count, totals) in sums.items():
            values[position, entry] = [total // count for total in totals]
        return Codebooks(values)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.values.ravel().tolist())).encode()).hexdigest()


def first_codebooks(vectors: DataFrame, options: CodeOptions) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; None without any vector.

    Each task sends the smallest of each of its batches.
    """
    scale, wanted = options.scale, options.entries

    def smallest(batches):
        for batch in batches:
            rows, values = whole_vectors(batch.column("vector"), scale)
            ids = batch.column("vec_id").take(pa.array(rows))
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            order = np.lexsort((ids.fill_null(0).to_numpy(), missing))
            last = order[:wanted]
            # rows that tie with the last one by id are told apart by their components
            tied = ids.take(pa.array(last[-1:])).to_pylist()
            if len(order) > wanted:
                same = [i for i in order[wanted:] if ids[int(i)].as_py() == tied[0]]
                last = np.concatenate([last, np.array(same, np.int64)])
            lists = pa.array(list(values[last]), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(last)), lists], names=["vec_id", "whole"])

    found = vectors.select("vec_id", "vector").mapInArrow(smallest, "vec_id long, whole array<long>")
    first = found.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(wanted).collect()
    if not first:
        return None
    size = len(first[0].whole)
    if size % options.parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {options.parts} equal parts")
    values = np.array([row.whole for row in first if len(row.whole) == size], np.int64)
    return Codebooks(values.reshape(len(values), options.parts, -1).transpose(1, 0, 2))


# --- Members ---------------------------------------------------------------------------------


def _groups(entry: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each entry that occurs, with the places of its members."""
    order = np.argsort(entry, kind="stable")
    found, starts = np.unique(entry[order], return_index=True)
    for one, places in zip(found.tolist(), np.split(order, starts[1:])):
        yield one, places


class Rows:
    """Rows of members gathered into batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self._schema = schema
        self._rows: list[tuple] = []
        self._bytes = 0

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self._rows.append(row)
        self._bytes += sum(len(value) for value in row if isinstance(value, bytes))
        if self._bytes >= 1 << 20 or len(self._rows) >= 10_000:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            columns = [pa.array(values, field.type) for values, field in zip(zip(*self._rows), self._schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=self._schema)
        self._rows, self._bytes = [], 0


_MEMBER_ROWS = pa.schema(
    [("block", pa.int64()), ("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()),
     ("slots", pa.binary()), ("width", pa.int32()), ("parts", pa.binary())]
)


def settle(vectors: DataFrame, books: Codebooks, scale: int) -> DataFrame:
    """All parts with their nearest entry, one row per block, position and entry.

    A block also has one row of position -1 with its ids in ``slots`` and its labels in
    ``parts``, each value as one byte (1: null) and eight more.
    """
    size = books.parts * books.size

    def assign(batches):
        rows = Rows(_MEMBER_ROWS)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                some = batch.slice(start, BLOCK)
                kept, values = whole_vectors(some.column("vector"), scale, size)
                if not len(kept):
                    continue
                salt = block % SALTS
                ids, labels = (_nullable(some.column(name).take(pa.array(kept))) for name in ("vec_id", "label"))
                yield from rows.add(block, -1, 0, salt, ids, 0, labels)
                for position in range(books.parts):
                    points = values[:, position * books.size : (position + 1) * books.size]
                    entry, _ = nearest(points, books.values[position])
                    for one, places in _groups(entry):
                        width, raw = _pack(points[places])
                        yield from rows.add(block, position, one, salt, places.astype("<u2").tobytes(), width, raw)
                block += 1
        yield from rows.rest()

    return vectors.mapInArrow(assign, _MEMBERS)


def _nullable(column: pa.Array) -> bytes:
    values = np.zeros(len(column), [("null", "u1"), ("value", "<i8")])
    values["null"] = column.is_null().to_numpy(zero_copy_only=False)
    values["value"] = column.cast(pa.int64()).fill_null(0).to_numpy()
    return values.tobytes()


def _from_nullable(raw: bytes) -> pa.Array:
    values = np.frombuffer(raw, [("null", "u1"), ("value", "<i8")])
    return pa.array(values["value"], mask=values["null"].astype(bool))


def _blocks(batches: Iterator[pa.RecordBatch], size: int):
    """Each row of members as (row, places in the block, parts)."""
    for batch in batches:
        for row in batch.to_pylist():
            if row["position"] >= 0:
                yield row, np.frombuffer(row["slots"], "<u2"), _unpack(row["width"], row["parts"], size)


def _staying(row: dict, points: np.ndarray, books: Sequence[Codebooks]) -> np.ndarray:
    """Members of a row that each of these later codebooks left with its entry."""
    stay = np.ones(len(points), bool)
    for book in books:
        stay[stay] = nearest(points[stay], book.values[row["position"]])[0] == row["entry"] if stay.any() else False
    return stay


def sums(members: DataFrame, size: int, later: Sequence[Codebooks]) -> DataFrame:
    """position, entry, count and totals, as each task's owners have them.

    ``later``: codebooks since these rows were dealt; members that one of them took elsewhere
    are counted where they went.
    """

    def add(batches):
        found: dict[tuple[int, int], list] = {}
        for row, _, points in _blocks(batches, size):
            points = points[_staying(row, points, later)]
            if not len(points):
                continue
            wide = len(points) * max(abs(int(points.min())), abs(int(points.max()))) >= 1 << 62
            total = [sum(column) for column in points.T.tolist()] if wide else points.sum(0).tolist()
            have = found.setdefault((row["position"], row["entry"]), [0, [0] * size])
            have[0] += len(points)
            have[1] = [a + b for a, b in zip(have[1], total)]
        keys = list(found)
        columns = [
            pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
            pa.array([found[k][0] for k in keys], pa.int64()),
            pa.array([[str(x) for x in found[k][1]] for k in keys], pa.list_(pa.string())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["position", "entry", "count", "totals"])

    return members.mapInArrow(add, "position int, entry int, count long, totals array<string>")


def entry_sums(owners: DataFrame, size: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """The owners' sums added up: one row per entry reaches the driver."""
    totals = [F.sum(F.col("totals")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(size)]
    added = owners.groupBy("position", "entry").agg(F.sum("count").alias("count"), *totals)
    return {(r[0], r[1]): (r[2], [int(x) for x in r[3:]]) for r in added.collect()}


def movers(members: DataFrame, size: int, later: Sequence[Codebooks], book: Codebooks) -> DataFrame:
    """Members whose nearest entry in ``book`` is another one, as rows of their new entry."""

    def move(batches):
        rows = Rows(_MEMBER_ROWS)
        for row, slots, points in _blocks(batches, size):
            stay = _staying(row, points, later)
            slots, points = slots[stay], points[stay]
            if not len(points):
                continue
            entry, _ = nearest(points, book.values[row["position"]])
            for one, places in _groups(entry):
                if one != row["entry"]:
                    width, raw = _pack(points[places])
                    yield from rows.add(
                        row["block"], row["position"], one, row["salt"], slots[places].tobytes(), width, raw
                    )
        yield from rows.rest()

    return members.mapInArrow(move, _MEMBERS)


def _deal(members: DataFrame) -> DataFrame:
    """To the owners: partitioned by (position, entry, salt)."""
    return members.repartition("position", "entry", "salt")


# --- Codes -----------------------------------------------------------------------------------

_CODED = "block long, position int, slots binary, entries binary, errors binary, parts binary"


def final_parts(members: DataFrame, size: int, later: Sequence[Codebooks], book: Codebooks) -> DataFrame:
    """Entry and squared distance in the final codebooks of each resident member, by block.

    Rows of position -1 pass through with their ids and labels.
    """
    schema = pa.schema(
        [("block", pa.int64()), ("position", pa.int32()), *((n, pa.binary()) for n in ("slots", "entries", "errors", "parts"))]
    )

    def code(batches):
        rows = Rows(schema)
        for batch in batches:
            for row in batch.to_pylist():
                if row["position"] < 0:
                    yield from rows.add(row["block"], -1, row["slots"], b"", b"", row["parts"])
                    continue
                slots, points = np.frombuffer(row["slots"], "<u2"), _unpack(row["width"], row["parts"], size)
                stay = _staying(row, points, later)
                if stay.any():
                    entry, error = nearest(points[stay], book.values[row["position"]])
                    kept = slots[stay].tobytes()
                    raw = error.astype("<i8").tobytes()
                    yield from rows.add(row["block"], row["position"], kept, entry.astype("u1").tobytes(), raw, b"")
        yield from rows.rest()

    return members.mapInArrow(code, _CODED)


def assembled(coded: DataFrame, parts: int) -> DataFrame:
    """vec_id, label, code and error of each vector: a block's rows meet in one task, in order.

    A block has ``BLOCK`` vectors at most, so what is held does not grow with the table.
    """

    def build(batches):
        at = None
        for batch in batches:
            for row in batch.to_pylist():
                if at is not None and row["block"] != at["block"]:
                    yield finish(at)
                    at = None
                if at is None:  # position -1 comes first
                    at = {"block": row["block"], "ids": _from_nullable(row["slots"]), "labels": _from_nullable(row["parts"])}
                    at["codes"] = np.zeros((len(at["ids"]), parts), np.uint8)
                    at["errors"] = [np.zeros(len(at["ids"]), np.int64) for _ in range(parts)]
                    continue
                slots = np.frombuffer(row["slots"], "<u2")
                at["codes"][slots, row["position"]] = np.frombuffer(row["entries"], np.uint8)
                at["errors"][row["position"]][slots] = np.frombuffer(row["errors"], "<i8")
        if at is not None:
            yield finish(at)

    def finish(at):
        digits = at["codes"].tobytes().hex()
        codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
        error = np.zeros(len(codes), np.int64)
        for one in at["errors"]:
            error = np.where(error > _LONG.max - one, _LONG.max, error + one)
        columns = [at["ids"], at["labels"], pa.array(codes, pa.string()), pa.array(error)]
        return pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    ordered = coded.repartition("block").sortWithinPartitions("block", "position")
    return ordered.mapInArrow(build, "vec_id long, label long, code string, error long")


def with_label_error(codes: DataFrame) -> DataFrame:
    """``label_error``: the errors of all vectors with the row's label, those without one together."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(int(_LONG.max)).cast("decimal(38,0)"))
    sums = codes.groupBy("label").agg(total.cast("long").alias("label_error"))
    sums = Stored(sums.withColumn("name", F.coalesce(F.col("label").cast("string"), F.lit(""))).drop("label"), "labels")
    named = codes.withColumn("name", F.coalesce(F.col("label").cast("string"), F.lit("")))
    if sums.frame.count() <= BROADCAST_LABELS:
        joined = named.join(F.broadcast(sums.frame), "name")
    else:
        joined = lookup_join(named, sums.frame, "name", ["vec_id", "code"])
    return joined.drop("name")


def compress(
    vectors: DataFrame, vector: str = "embedding", label: str = "label", options: CodeOptions = CodeOptions()
) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error, codebooks_sha256.

    Rows whose vector is null, or holds null or non-finite components, are dropped. The first
    codebooks are the vectors with the smallest ids; equal ids stand in order of their
    components and a null id last. With fewer vectors than entries the codebooks are that
    short. The first of those vectors gives the table's number of components; vectors of
    another length are dropped too, and a number that ``parts`` does not divide raises
    ``ValueError``. Repeated rows are coded each. Labels are integers; null ones count as one
    label. An empty table gives no rows. Other columns are not read. Results are exact while
    they fit 64 bits; larger components and distances are held at the bounds.
    """
    spark = vectors.sparkSession
    kept = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).cast("long").alias("label")
    )
    book = first_codebooks(kept, options)
    if book is None:
        return spark.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        )
    size = book.size
    # what was dealt in each round, and the codebooks since
    resident: list[tuple[Stored, list[Codebooks]]] = [(Stored(_deal(settle(kept, book, options.scale)), "members"), [])]
    for round_ in range(options.rounds):
        owners = reduce(DataFrame.unionByName, [sums(dealt.frame, size, later) for dealt, later in resident])
        book = book.moved(entry_sums(owners, size))
        if round_ + 1 < options.rounds:
            moved = [movers(dealt.frame, size, later, book) for dealt, later in resident]
            arrived = Stored(_deal(reduce(DataFrame.unionByName, moved)), "moved")
            resident = [(dealt, [*later, book]) for dealt, later in resident] + [(arrived, [])]
    coded = reduce(DataFrame.unionByName, [final_parts(dealt.frame, size, later, book) for dealt, later in resident])
    codes = Stored(assembled(coded, options.parts), "codes")
    for dealt, _ in resident:
        dealt.drop()
    found = with_label_error(codes.frame).withColumn("codebooks_sha256", F.lit(book.sha256()))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
