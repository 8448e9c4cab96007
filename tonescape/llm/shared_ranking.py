"""Ranked lexical search for many queries at once, sharing what queries have in common.

A document's score for an item is a sum over the item's terms, so items that share terms
share partial sums. The shared term sets are mined from the items: their terms are put in
order of how many items hold them, as in a frequent-pattern tree, and neighbours that
several items share become one node, again and again, until no two nodes stand side by side
in two items. Nodes and items form a directed acyclic graph. For a block of documents the
accumulator of each node (its partial score for each document) is made once from its two
parts, and every item adds up the few nodes that it is left with.

Scores need counts over all documents first: how many hold a term, how many have a term at
all, and all their terms together. So a first pass leaves each document's length and its
counts of the items' terms (a small table, stored), and the second pass scores those.
Documents are never shuffled; each task sends its best documents of each item.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonescape.llm.storage import Stored

#: Bytes of one text that are cut into terms at a time.
TEXT_BYTES = 1 << 22
#: Values in the arrays of one block of documents, and the most documents in a block.
BLOCK_VALUES = 1 << 22
BLOCK_ROWS = 1024

# The bytes of terms [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+, capitals A-Z as small ones.
_TERM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


@dataclass(frozen=True)
class SearchOptions:
    """``top``: documents per item. ``group_entries``: terms of items, with repeats among items,
    that one pass over the documents carries; more items take further passes."""

    top: int = 10
    group_entries: int = 50_000


def terms(text: str | None) -> Iterator[list[bytes]]:
    """A text's terms in order, those of a bounded stretch at a time; null has none."""
    raw = (text or "").encode().translate(_TERM)
    start = 0
    while start < len(raw):
        end = len(raw) if len(raw) - start <= TEXT_BYTES else raw.rfind(b" ", start, start + TEXT_BYTES)
        if end <= start:  # one term fills the stretch
            end = raw.find(b" ", start + TEXT_BYTES)
            end = len(raw) if end < 0 else end
        yield raw[start:end].split()
        start = end + 1


class SharedPlan:
    """Nodes over the terms of some items; ``items`` are lists of different terms.

    Nodes 0 .. len(vocabulary)-1 are terms. ``left`` and ``right`` are the parts of the nodes
    after them, in an order where parts come first; ``levels`` are their bounds in runs that
    need nothing of their own run. ``roots`` are the nodes that add up to each item.
    """

    def __init__(self, items: Sequence[Sequence[bytes]]):
        held = Counter(term for item in items for term in item)
        order = sorted(held, key=lambda term: (-held[term], term))
        self.vocabulary = {term: place for place, term in enumerate(order)}
        self.roots = [sorted(self.vocabulary[term] for term in item) for item in items]
        self.left: list[int] = []
        self.right: list[int] = []
        self.levels = [len(order)]
        while self._share():
            self.levels.append(len(order) + len(self.left))

    @property
    def nodes(self) -> int:
        return len(self.vocabulary) + len(self.left)

    def _share(self) -> bool:
        """One round: neighbours that stand side by side in two items or more become nodes."""
        together = Counter(pair for item in self.roots for pair in zip(item, item[1:]))
        places: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for which, item in enumerate(self.roots):
            best = [together[pair] for pair in zip(item, item[1:])]
            # the most shared pairs of an item first, each term in one pair
            free = [True] * len(item)
            for at in sorted(range(len(best)), key=lambda at: (-best[at], item[at], item[at + 1])):
                if best[at] > 1 and free[at] and free[at + 1]:
                    free[at] = free[at + 1] = False
                    places[item[at], item[at + 1]].append((which, at))
        found = False
        for pair, uses in sorted(places.items()):
            if len(uses) < 2:
                continue
            found, node = True, self.nodes
            self.left.append(pair[0])
            self.right.append(pair[1])
            for which, at in uses:
                self.roots[which][at], self.roots[which][at + 1] = node, -1
        self.roots = [[node for node in item if node >= 0] for item in self.roots]
        return found


@dataclass
class Best:
    """The best documents of one item so far, in order."""

    scores: np.ndarray
    missing: np.ndarray
    ids: np.ndarray

    def add(self, scores, missing, ids, top: int) -> None:
        scores, missing, ids = (
            np.concatenate(both) for both in ((self.scores, scores), (self.missing, missing), (self.ids, ids))
        )
        order = np.lexsort((ids, missing, -scores))[:top]
        self.scores, self.missing, self.ids = scores[order], missing[order], ids[order]


class Scorer:
    """Evaluates a plan over blocks of documents and keeps each item's best."""

    def __init__(self, plan: SharedPlan, weights: np.ndarray, documents: int, words: int, top: int):
        self._plan, self._weights, self._documents, self._words, self._top = plan, weights, documents, words, top
        self._left, self._right = np.array(plan.left, np.int64), np.array(plan.right, np.int64)
        self._flat = np.concatenate([np.array(item, np.int64) for item in plan.roots])
        self._starts = np.cumsum([0, *map(len, plan.roots)])[:-1]
        self.rows = max(1, min(BLOCK_ROWS, BLOCK_VALUES // (plan.nodes + len(self._flat))))
        empty = np.empty(0, np.int64)
        self.best = [Best(empty, empty.astype(bool), empty) for _ in plan.roots]
        self._least = np.ones(len(plan.roots), np.int64)  # a score must be above 0

    def accumulators(self, lengths, offsets, term, count) -> np.ndarray:
        """Partial score of each node for each document of the block."""
        rows, leaves = len(lengths), len(self._plan.vocabulary)
        m = 100 - 90 + (90 * lengths * self._documents) // max(self._words, 1)
        row = np.repeat(np.arange(rows), np.diff(offsets))
        held = np.zeros((self._plan.nodes, rows), np.int64)
        held[term, row] = self._weights[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m[row]))
        levels = self._plan.levels
        for start, end in zip(levels, levels[1:]):
            own = slice(start - leaves, end - leaves)
            held[start:end] = held[self._left[own]] + held[self._right[own]]
        return held

    def add(self, ids, missing, lengths, offsets, term, count) -> None:
        held = self.accumulators(lengths, offsets, term, count)
        scores = np.add.reduceat(held[self._flat], self._starts, axis=0)
        wanted = scores >= self._least[:, None]
        for item in np.flatnonzero(wanted.any(axis=1)):
            at, best = np.flatnonzero(wanted[item]), self.best[item]
            best.add(scores[item, at], missing[at], ids[at], self._top)
            if len(best.scores) == self._top:
                self._least[item] = max(1, best.scores[-1])


def _lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and values of an array of lists without nulls."""
    bounds = lists.offsets.to_numpy()
    return bounds - bounds[0], lists.flatten().to_numpy()


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number for each row), item_id and the row's different terms."""

    def cut(batches):
        for batch in batches:
            found = [sorted(set().union(*terms(text))) for text in batch.column("text").to_pylist()]
            columns = [batch.column("item"), batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "terms"])

    kind = dict(items.dtypes)["item_id"]
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return numbered.mapInArrow(cut, f"item long, item_id {kind}, terms array<binary>")


def counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (the document's terms with repeats) and its counts of the vocabulary's terms."""

    def count(batches):
        for batch in batches:
            lengths, sizes, term, times = [], [], [], []
            for text in batch.column("text"):
                n, found = 0, Counter()
                for some in terms(text.as_py()):
                    n += len(some)
                    found.update([word for word in some if word in vocabulary])
                lengths.append(n)
                sizes.append(len(found))
                term += [vocabulary[word] for word in found]
                times += found.values()
            bounds = pa.array(np.cumsum([0, *sizes]), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(v, pa.int32())) for v in (term, times)]
            columns = [batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return kept.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<int>")


def holders(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of a vocabulary of ``size`` terms."""

    def add(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_lists(batch.column("terms"))[1], minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    sums = counted.select("terms").mapInArrow(add, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = np.zeros(size, np.int64)
    for row in sums.collect():  # one row a term of the plan
        found[row.term] = row.df
    return found


def best_by_task(counted: DataFrame, plan: SharedPlan, numbers: list[int], top: int) -> DataFrame:
    """item, doc_id and score of each task's best documents of each item of the plan."""
    documents, words = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = holders(counted, len(plan.vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)

    def score(batches):
        scorer = Scorer(plan, weights, documents, words, top)
        for batch in batches:
            doc = batch.column("doc_id")
            missing = doc.is_null().to_numpy(zero_copy_only=False)
            ids, n = doc.fill_null(0).to_numpy(), batch.column("n").to_numpy()
            bounds, term = _lists(batch.column("terms"))
            times = _lists(batch.column("times"))[1].astype(np.int64)
            for a in range(0, len(ids), scorer.rows):
                own = slice(a, a + scorer.rows)
                inner = bounds[a : a + scorer.rows + 1]
                some = slice(inner[0], inner[-1])
                scorer.add(ids[own], missing[own], n[own], inner, term[some], times[some])
        sizes = [len(best.ids) for best in scorer.best]
        item = pa.array(np.repeat(np.array(numbers, np.int64), sizes))
        missing = np.concatenate([best.missing for best in scorer.best])
        doc = pa.array(np.concatenate([best.ids for best in scorer.best]), mask=missing)
        scores = pa.array(np.concatenate([best.scores for best in scorer.best]))
        yield pa.RecordBatch.from_arrays([item, doc, scores], names=["item", "doc_id", "score"])

    return counted.mapInArrow(score, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, options: SearchOptions = SearchOptions()) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's best documents.

    Every row of ``items`` is an item of its own, also where ids or texts repeat, and every
    row of ``docs`` a document. Only scores above 0 count; equal scores stand in order of
    doc_id, a null one last. Null or empty texts have no terms: such an item gets no rows,
    such a document is not counted. Empty tables give no rows. Very long texts are cut into
    terms a stretch at a time. Other columns of either table are not read. ``doc_id`` is
    returned as long.

    What the driver and each task hold is the plan of one group of items: about
    ``group_entries`` terms, or one item where that has more.
    """
    listed = Stored(item_terms(items), "items")
    entries = listed.frame.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, math.ceil(entries / options.group_entries))
    found = None
    for group in range(groups):
        own = listed.frame.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == group).filter(F.size("terms") > 0)
        rows = own.orderBy("item").collect()
        if not rows:
            continue
        plan = SharedPlan([[bytes(term) for term in row.terms] for row in rows])
        counted = Stored(counts(docs, plan.vocabulary), "counts")
        best = Stored(best_by_task(counted.frame, plan, [row.item for row in rows], options.top), "best").frame
        counted.drop()
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= options.top)
    names = listed.frame.select("item", "item_id")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
