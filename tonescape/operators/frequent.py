"""The most frequent terms of a corpus, with a shuffle that does not grow with distinct terms.

Each task keeps a bounded summary of its terms. When it holds too many, the count that only
``capacity`` terms exceed is taken off all of them, and those left without any go. A term's
count in the summaries is then too low by at most the sum of what was taken off, which the
tasks report. Merged summaries so give the terms that can be among the first, and these are
counted exactly in a second pass. Whether the bound suffices is checked, never assumed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.functions import term_batch
from tonescape.functions.text import terms
from tonescape.session import OPTION_ROWS, stage

#: Terms a task keeps for each one asked for, and at least.
PER_TERM, AT_LEAST = 32, 1 << 15
#: How much larger the summaries of a second attempt are.
GROWTH = 8


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    return (
        docs.select(F.explode(terms(F.col(text))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def vocabulary(counts: DataFrame, max_features: int) -> DataFrame:
    """The most frequent terms, ties by term, with their rank from 1."""
    top = counts.orderBy(F.col("n").desc(), "term").limit(max_features)
    ranked = top.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "term"))).alias("all")
    )
    return ranked.select(F.posexplode("all").alias("pos", "t")).select(
        F.col("t.term").alias("term"),
        (-F.col("t.m")).alias("n"),
        (F.col("pos") + 1).alias("rank"),
    )


def _purge(counts: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """Take the (capacity + 1)-th largest count off all; returns it too."""
    values = counts["n"].to_numpy()
    cut = int(np.partition(values, len(values) - capacity - 1)[len(values) - capacity - 1])
    left = values > cut
    return pa.table({"term": counts["term"].filter(pa.array(left)), "n": values[left] - cut}), cut


def _summarise(batches: Iterator[pa.RecordBatch], capacity: int, packed: bytes) -> Iterator[pa.RecordBatch]:
    counts = pa.table({"term": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    waiting, rows, taken = [], 0, 0

    def merged() -> pa.Table:
        both = pa.concat_tables([counts, *waiting]).group_by("term", use_threads=False).aggregate([("n", "sum")])
        return both.rename_columns({"n_sum": "n"})

    for names, sums in term_batch.counts(batches, packed):
        waiting.append(pa.table({"term": names, "n": sums}))
        rows += len(names)
        if rows > 4 * capacity:
            counts, waiting, rows = merged(), [], 0
            if len(counts) > 2 * capacity:
                counts, cut = _purge(counts, capacity)
                taken += cut
    counts = merged()
    if len(counts) > capacity:
        counts, cut = _purge(counts, capacity)
        taken += cut
    # The row without a term is the task's error bound.
    bound = pa.table({"term": pa.array([None], pa.string()), "n": pa.array([taken], pa.int64())})
    yield from pa.concat_tables([bound, counts.select(["term", "n"])]).to_batches()


def summaries(docs: DataFrame, capacity: int, text: str = "text") -> DataFrame:
    """term and n, at most ``capacity`` + 1 rows a task; n of the null term is a task's error.

    The errors of all tasks add up to at most the number of all terms / (capacity + 1).
    """
    packed = term_batch.packed_letters(docs.sparkSession)
    lowered = docs.select(F.lower(F.col(text)))
    return lowered.mapInArrow(lambda it: _summarise(it, capacity, packed), "term string, n bigint")


def candidates(docs: DataFrame, size: int, capacity: int, text: str = "text") -> DataFrame | None:
    """All terms that can be among the ``size`` most frequent ones, ties included; ``None``
    where summaries of this capacity cannot tell."""
    merged = stage(summaries(docs, capacity, text).groupBy("term").agg(F.sum("n").alias("n")), "summaries")
    error = merged.filter("term is null").select("n").first()
    error = error.n if error else 0
    known = merged.filter("term is not null")
    # The count that ``size`` terms reach for sure; 0 if there are fewer.
    floor = known.select("n").orderBy(F.col("n").desc()).limit(size)
    reached, least = floor.agg(F.count(F.lit(1)), F.min("n")).first()
    least = least if reached == size else 0
    if error > 0 and error >= least:
        return None  # a term that no summary holds can be as frequent
    return known.filter(F.col("n") + F.lit(error) >= least).select("term")


def _sum_few(batches: Iterator[pa.RecordBatch], few: list[str], packed: bytes) -> Iterator[pa.RecordBatch]:
    chosen, total = pa.array(few, pa.string()), np.zeros(len(few), np.int64)
    for names, sums in term_batch.counts(batches, packed):
        place = pc.index_in(chosen, value_set=names)
        total[place.is_valid().to_numpy(zero_copy_only=False)] += sums[place.drop_null().to_numpy()]
    yield pa.RecordBatch.from_arrays([chosen, pa.array(total)], names=["term", "n"])


def _exact(docs: DataFrame, chosen: DataFrame, text: str) -> DataFrame:
    """Counts of the chosen terms; few of them are sent to every task."""
    few = [r.term for r in chosen.limit(OPTION_ROWS + 1).collect()]
    if len(few) > OPTION_ROWS:
        listed = docs.select(F.explode(terms(F.col(text))).alias("term")).join(chosen, "term", "left_semi")
        return listed.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    packed = term_batch.packed_letters(docs.sparkSession)
    sums = docs.select(F.lower(F.col(text))).mapInArrow(lambda it: _sum_few(it, few, packed), "term string, n bigint")
    return sums.groupBy("term").agg(F.sum("n").alias("n"))


def frequent_terms(docs: DataFrame, size: int, text: str = "text", capacity: int | None = None) -> DataFrame:
    """``vocabulary(token_counts(docs), size)``: term, n and rank of the most frequent terms.

    Tasks keep ``capacity`` terms. Where that cannot tell the first ones, larger summaries
    are tried once; then all terms are counted. Null and empty texts have no terms, repeated
    documents count each, and an empty table gives no rows.
    """
    if size < 1:
        return vocabulary(token_counts(docs, text), size)
    capacity = capacity or max(AT_LEAST, PER_TERM * size)
    for own in (capacity, GROWTH * capacity):
        chosen = candidates(docs, size, own, text)
        if chosen is not None:
            return vocabulary(_exact(docs, chosen, text), size)
    return vocabulary(token_counts(docs, text), size)
