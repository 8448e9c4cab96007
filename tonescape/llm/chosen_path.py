"""Texts whose word n-gram sets are similar, found by the chosen-path join.

A run sends every set down random paths: at a node, each token of the set is chosen with
the chance 1 / (similarity * size), by a hash that all sets share, and the set goes on to a
child for each chosen token. Two sets over the limit share at least one child in the mean,
so some path of theirs survives several levels with known chance; other sets soon part.
Buckets (nodes) that stay large are split further. Runs are repeated until a pair at the
limit is met with the wanted recall. What met is compared exactly, in blocks.

Equal sets are one set from the start. Sets that met form groups; each group's texts are
brought together once, however many buckets they share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonescape.llm import wordcode as wc
from tonescape.llm.components import components
from tonescape.llm.storage import Stored

_U = np.uint64


@dataclass(frozen=True)
class JoinOptions:
    """``shingle`` words make a token; sets join from Jaccard ``least``. ``depth``: levels
    before buckets are counted; one with more than ``bucket`` sets is split on, down to
    ``max_depth``. ``recall`` at the limit sets the number of runs. Groups are compared in
    blocks of about ``block`` sets."""

    shingle: int = 5
    least: float = 0.8
    depth: int = 3
    max_depth: int = 4
    bucket: int = 64
    recall: float = 0.99999
    block: int = 512

    @property
    def runs(self) -> int:
        """Runs after which a pair at the limit has met with chance ``recall``.

        The children that two such sets share are at least Poisson(1), so the chance to share
        a path of d levels is 1 - exp(-chance of d - 1). Counted for the last level, so it holds
        for pairs that only meet in buckets split that far.
        """
        chance = 1.0
        for _ in range(max(self.depth, self.max_depth)):
            chance = 1 - math.exp(-chance)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - chance))


# --- Sets and paths -----------------------------------------------------------------------


@dataclass
class Sets:
    """Token sets of a chunk's rows: row i has tokens[bounds[i]:bounds[i+1]], sorted, distinct."""

    tokens: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def token_sets(chunk: wc.Chunk, size: int) -> Sets:
    """Hashes of each row's distinct runs of ``size`` words; a shorter text's words are one."""
    w = wc.words(chunk)
    codes = wc.SpanHash(chunk.data).of(w.starts, w.ends)
    at = wc.whole_windows(w.before, size)
    tokens, row = wc.ngram_hashes(codes, size)[at], w.row[at]
    counts = np.diff(w.before)
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            tokens = np.append(tokens, wc.ngram_hashes(codes, n)[w.before[:-1][short]] + _U(n))
            row = np.append(row, short)
    order = np.lexsort((tokens, row))
    tokens, row = tokens[order], row[order]
    new = np.append(True, (tokens[1:] != tokens[:-1]) | (row[1:] != row[:-1])) if len(row) else np.empty(0, bool)
    tokens, row = tokens[new], row[new]
    return Sets(tokens, np.append(0, np.cumsum(np.bincount(row, minlength=chunk.rows))))


def split(sets: Sets, row: np.ndarray, node: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of the nodes at which rows stand: place in ``row`` and the child's node."""
    sizes = sets.sizes[row]
    place = np.repeat(np.arange(len(row)), sizes)
    tokens = sets.tokens[np.arange(len(place)) + np.repeat(sets.bounds[row] - (np.cumsum(sizes) - sizes), sizes)]
    value = (tokens ^ node[place]) * _U(0x9FB21C651E98DF25)
    value ^= value >> _U(29)
    value *= _U(0xD6E8FEB86659FD93)
    chance = np.minimum(1.0, 1.0 / (least * np.maximum(sizes, 1)))
    limit = np.minimum(chance * 2.0**64, 2.0**64 - 2048).astype(np.uint64)
    chosen = np.flatnonzero((value < limit[place]) | (chance[place] >= 1))
    place = place[chosen]
    return place, wc.mix(node[place] * _U(0x2545F4914F6CDD1D) + tokens[chosen])


def paths(sets: Sets, o: JoinOptions) -> tuple[np.ndarray, np.ndarray]:
    """Row and node of every path of ``depth`` levels, over all runs."""
    rows, nodes = [], []
    roots = wc.mix(np.arange(1, o.runs + 1, dtype=np.uint64))
    has = np.flatnonzero(sets.sizes)
    for root in roots:
        row, node = has, np.full(len(has), root)
        for _ in range(o.depth):
            place, node = split(sets, row, node, o.least)
            row = row[place]
        rows.append(row)
        nodes.append(node)
    row, node = np.concatenate(rows), np.concatenate(nodes)
    order = np.argsort(row, kind="stable")
    return row[order], node[order]


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=n)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _describe(batches: Iterator[pa.RecordBatch], o: JoinOptions) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in wc.chunks(batch.column("text")):
            sets = token_sets(chunk, o.shingle)
            start, end = sets.bounds[:-1], sets.bounds[1:]
            keys = []
            for multiplier in (1, 3):
                total = np.append(_U(0), np.cumsum(wc.mix(sets.tokens * _U(multiplier))))
                keys.append((total[end] - total[start]).astype(np.int64))
            row, node = paths(sets, o)
            own = batch.slice(chunk.first, chunk.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    own.column("doc"),
                    own.column("text_hash"),
                    *map(pa.array, keys),
                    pa.array(sets.sizes),
                    _lists(node.view(np.int64), row, chunk.rows),
                ],
                names=["doc", "text_hash", "key1", "key2", "n_tokens", "nodes"],
            )


def _children(batches: Iterator[pa.RecordBatch], o: JoinOptions) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists, set_id = batch.column("nodes"), batch.column("set_id").to_numpy()
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        for chunk in wc.chunks(batch.column("text")):
            sets = token_sets(chunk, o.shingle)
            own = offsets[chunk.first : chunk.first + chunk.rows + 1]
            row = np.repeat(np.arange(chunk.rows), np.diff(own))
            place, node = split(sets, row, flat[own[0] : own[-1]].view(np.uint64), o.least)
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_id[chunk.first + row[place]]), pa.array(node.view(np.int64))],
                names=["set_id", "node"],
            )


def met(rows: DataFrame) -> DataFrame:
    """set_id, node of the rows whose node others share, with ``n`` and its smallest set_id."""
    shared = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("set_id").alias("low")).where("n > 1")
    return rows.join(shared, "node")


# --- Comparing ----------------------------------------------------------------------------


def overlaps(tokens: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(n, n) sizes of the intersections of n sets, given as (token, owner) entries.

    Tokens of few sets add their pairs; tokens of many are multiplied as matrices.
    """
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    count = np.diff(np.append(first, len(tokens)))
    common = np.zeros((n, n), np.float32)
    few = 8
    for k in range(2, few + 1):
        at = first[count == k]
        if len(at):
            members = owner[at[:, None] + np.arange(k)]
            a, b = np.triu_indices(k, 1)
            pairs = (members[:, a].astype(np.int64) * n + members[:, b]).ravel()
            common += np.bincount(pairs, minlength=n * n).reshape(n, n)
    common += common.T.copy()
    many = np.flatnonzero(count > few)
    for i in range(0, len(many), 2048):
        part = many[i : i + 2048]
        matrix = np.zeros((n, len(part)), np.float32)
        size = count[part]
        at = np.arange(size.sum()) + np.repeat(first[part] - (np.cumsum(size) - size), size)
        matrix[owner[at], np.repeat(np.arange(len(part)), size)] = 1
        common += matrix @ matrix.T
    return common


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each element's component under the links a - b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, root):
            return root
        root = new


def compare(set_id: np.ndarray, copies: np.ndarray, side: np.ndarray, sets: list[np.ndarray], own: bool, o: JoinOptions):
    """(set_id, links, root) of the sets that are linked, within one pair of blocks.

    ``own``: the pair is a block with itself; otherwise only sets of different sides compare.
    """
    order = np.argsort(set_id, kind="stable")
    order = order[np.append(True, np.diff(set_id[order]) != 0)]  # a row that stands twice
    set_id, copies, side, sets = set_id[order], copies[order], side[order], [sets[i] for i in order]
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    common = overlaps(np.concatenate(sets), np.repeat(np.arange(n), sizes), n)
    similar = common * (1 + o.least) >= o.least * (sizes[:, None] + sizes[None, :]) - 1e-6
    np.fill_diagonal(similar, False)
    if not own:
        similar &= side[:, None] != side[None, :]
    links = similar @ copies
    a, b = np.nonzero(np.triu(similar))
    root = _roots(n, a, b)
    linked = np.flatnonzero(links)
    return set_id[linked], links[linked], set_id[root[linked]]


def _compare(batches: Iterator[pa.RecordBatch], o: JoinOptions) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group and pair of blocks; each pair is compared when complete."""
    held: list = []
    held_key = None

    def result(parts: list) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int64)) for c in columns], names=["set_id", "links", "root"]
        )

    def finish() -> list:
        if len(held) < 2:
            return []
        ids, copies, side, sets = zip(*held)
        args = (np.array(ids), np.array(copies), np.array(side), list(sets))
        return [compare(*args, held_key[1] == held_key[2], o)]

    for batch in batches:
        found: list = []
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("group", "left", "right"))))
        ids, copies, side = (batch.column(c).to_pylist() for c in ("set_id", "copies", "block"))
        at = 0
        for chunk in wc.chunks(batch.column("text"), 1 << 22):
            sets = token_sets(chunk, o.shingle)
            for i in range(chunk.rows):
                if keys[at] != held_key:
                    found += finish()
                    held, held_key = [], keys[at]
                held.append((ids[at], copies[at], side[at], sets.tokens[sets.bounds[i] : sets.bounds[i + 1]]))
                at += 1
        yield result(found)
    yield result(finish())


# --- Join -----------------------------------------------------------------------------------


def _members(docs: DataFrame, described: DataFrame, o: JoinOptions) -> tuple[Stored, Stored, Stored]:
    """Distinct sets; texts of the sets that met others; links between sets that met."""
    rows = described.where("n_tokens > 0")
    distinct = rows.groupBy("key1", "key2").agg(
        F.min(F.struct("doc", "text_hash")).alias("first"),
        F.count("*").alias("copies"),
        F.first("nodes").alias("nodes"),
    )
    # set ids follow the smallest doc_id of each set
    distinct = distinct.select("key1", "key2", "first.*", "copies", "nodes").sort("doc", "text_hash", "key1", "key2")
    sets = Stored(distinct.withColumn("set_id", F.monotonically_increasing_id()), "sets")
    level = Stored(met(sets.frame.select("set_id", F.explode("nodes").alias("node"))), "met")
    live = level.frame.select("set_id").distinct()
    wanted = sets.frame.select("doc", "text_hash", "set_id", "copies").join(live, "set_id")
    texts = Stored(docs.join(wanted, ["doc", "text_hash"]).select("set_id", "copies", "text"), "texts")
    links, depth = None, o.depth
    while True:
        large = (F.col("n") > o.bucket) & F.lit(depth < o.max_depth)
        own = level.frame.where(~large & (F.col("set_id") > F.col("low")))
        own = Stored(own.select(F.col("set_id").alias("a"), F.col("low").alias("b")).distinct(), "links")
        links = own.frame if links is None else links.unionByName(own.frame)
        again = level.frame.where(large).groupBy("set_id").agg(F.collect_list("node").alias("nodes"))
        if depth >= o.max_depth or again.isEmpty():
            level.drop()
            return sets, texts, components(links, "groups")
        children = again.join(texts.frame, "set_id").select("set_id", "nodes", "text").mapInArrow(
            lambda it: _children(it, o), "set_id long, node long"
        )
        following = Stored(met(children.distinct()), "met")
        level.drop()
        level, depth = following, depth + 1


def _verified(texts: DataFrame, groups: DataFrame, o: JoinOptions) -> DataFrame:
    """set_id, links, root per pair of blocks in which a set has links."""
    everyone = groups.select("a", "b").unionByName(groups.select(F.col("b").alias("a"), "b").distinct())
    sizes = everyone.groupBy("b").agg(F.ceil(F.count("*") / o.block).alias("blocks"))
    placed = everyone.join(sizes, "b").select(
        F.col("b").alias("group"),
        F.col("a").alias("set_id"),
        "blocks",
        F.pmod(F.xxhash64("a"), "blocks").alias("block"),
    )
    dealt = placed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select(
        "group", "set_id", "block", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right")
    )
    joined = texts.join(dealt, "set_id").select("group", "left", "right", "block", "set_id", "copies", "text")
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arranged = joined.repartition(tasks, "group", "left", "right").sortWithinPartitions("group", "left", "right")
    return arranged.mapInArrow(lambda it: _compare(it, o), "set_id long, links long, root long")


def classes(docs: DataFrame, o: JoinOptions = JoinOptions()) -> DataFrame:
    """doc, text_hash, class_doc, class_hash, n_links, n_copies for every row of ``docs``.

    doc is the doc_id as a long (the smallest long for null); the class is named by the row
    with its smallest doc, then text_hash.
    """
    rows = docs.select(doc_key().alias("doc"), F.xxhash64("text").alias("text_hash"), "text")
    described = Stored(
        rows.mapInArrow(
            lambda it: _describe(it, o),
            "doc long, text_hash long, key1 long, key2 long, n_tokens long, nodes array<long>",
        ),
        "described",
    )
    sets, texts, groups = _members(rows, described.frame, o)
    verified = Stored(_verified(texts.frame, groups.frame, o), "verified")
    texts.drop()
    groups.drop()
    rooted = components(
        verified.frame.where("set_id > root").select(F.col("set_id").alias("a"), F.col("root").alias("b")), "classes"
    )
    links = verified.frame.groupBy("set_id").agg(F.sum("links").alias("links"))
    ids = sets.frame.select("set_id", "key1", "key2", "doc", "text_hash", "copies")
    firsts = ids.select(F.col("set_id").alias("b"), F.col("doc").alias("class_doc"), F.col("text_hash").alias("class_hash"))
    rooted = rooted.frame.join(firsts, "b").select(F.col("a").alias("set_id"), "class_doc", "class_hash")
    judged = ids.join(links, "set_id", "left").join(rooted, "set_id", "left").select(
        "key1",
        "key2",
        F.coalesce("class_doc", "doc").alias("class_doc"),
        F.coalesce("class_hash", "text_hash").alias("class_hash"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.col("copies").alias("n_copies"),
    )
    columns = ["doc", "text_hash", "class_doc", "class_hash", "n_links", "n_copies"]
    full = described.frame.where("n_tokens > 0").select("doc", "text_hash", "key1", "key2").join(judged, ["key1", "key2"])
    empty = described.frame.where("n_tokens = 0").select(
        "doc",
        "text_hash",
        F.col("doc").alias("class_doc"),
        F.col("text_hash").alias("class_hash"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"),
    )
    return full.select(columns).unionByName(empty)


def doc_key() -> Column:
    """doc_id as a long; a null is the smallest."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_DOC))


_NULL_DOC = -(1 << 63)


def join(docs: DataFrame, o: JoinOptions = JoinOptions()) -> DataFrame:
    """doc_id, class_id, n_links, n_copies for every row of ``docs``.

    n_links: other rows whose set has Jaccard ``least`` or more with this row's, exact copies
    included; n_copies: rows with the same set, this one included. class_id: the smallest
    doc_id reachable over links. A text with fewer words than a shingle is one token; one
    without words (null, empty) has no links and is its own class. doc_id is an integer; a
    null counts as the smallest. Rows that repeat are copies of each other. An empty table
    gives no rows. Other columns are not read.

    Texts cross the network to meet the sets that met others, and then once per block of
    their group; the rest is ids and path hashes. Comparing a class takes the square of its
    different texts, spread over pairs of blocks; no pair is ever a row.
    """

    def as_id(column: str) -> Column:
        return F.when(F.col(column) != F.lit(_NULL_DOC), F.col(column))

    return classes(docs, o).select(
        as_id("doc").alias("doc_id"), as_id("class_doc").alias("class_id"), "n_links", "n_copies"
    )


def one_of_each(docs: DataFrame, o: JoinOptions = JoinOptions()) -> DataFrame:
    """The rows of ``docs``, all columns, without those that are linked to a smaller doc_id.

    One row of each class stays; texts without words all stay.
    """
    firsts = classes(docs, o).where("doc = class_doc and text_hash = class_hash")
    firsts = firsts.groupBy("doc", "text_hash").agg(F.max("n_copies").alias("n_copies"))
    key, text_hash, spare = "__doc", "__text_hash", "__place"
    keyed = docs.withColumns({key: doc_key(), text_hash: F.xxhash64("text")})
    kept = keyed.join(firsts.toDF(key, text_hash, "__copies"), [key, text_hash])
    # of rows that repeat, one stays; they are in one partition already
    place = F.row_number().over(Window.partitionBy(key, text_hash).orderBy(key))
    return kept.withColumn(spare, place).where(f"{spare} = 1").select(*docs.columns)
