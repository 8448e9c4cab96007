"""Topic shares of texts against a topic-term matrix, and the matrix from the shares.

A text's shares are found by a fixed number of rounds: each occurrence of a term is divided
among the topics in proportion to the text's share of a topic times the topic's weight of the
term, and the parts add up to new shares, smoothed by a prior. Maximum-a-posteriori
estimation of latent Dirichlet allocation repeats this over all texts and makes the matrix
from the same parts.

Parts are whole millionths, and only additions, products, quotients and floors are used, so
neither the order of the texts nor their partitioning changes a digit. Texts are never
shuffled: a task sends one row per topic and term, its sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescape.functions import term_batch
from tonescape.functions.text import terms

#: One occurrence of a term, in the unit that it is divided in.
UNIT = 1_000_000
#: Occurrences (distinct terms of all texts) that are worked on together.
BLOCK = 1 << 15


@dataclass(frozen=True)
class Priors:
    """Smoothing in millionths of an occurrence: of a text's topics, of a topic's terms; and
    the rounds in which a text's shares are found."""

    share: int = 100_000
    term: int = 10_000
    rounds: int = 3


class TopicMatrix:
    """Expected occurrences of each term in each topic, in millionths: an array (topics, terms)."""

    def __init__(self, counts: np.ndarray, priors: Priors):
        self.counts, self.priors = np.asarray(counts, np.int64), priors

    @property
    def topics(self) -> int:
        return self.counts.shape[0]

    @classmethod
    def start(cls, topics: int, size: int, seed: int, priors: Priors) -> TopicMatrix:
        """Uneven counts that depend on the place of a term only."""
        term, topic = np.arange(1, size + 1), np.arange(1, topics + 1)[:, None]
        return cls((term * topic * 7919 + seed * 104729) % 1009 + 100, priors)

    def weights(self) -> np.ndarray:
        """Share of each term in its topic; each topic's add up to 1."""
        total = self.counts.sum(axis=1, keepdims=True) + self.counts.shape[1] * self.priors.term
        return (self.counts + self.priors.term).astype(np.float64) / total.astype(np.float64)

    def top(self, n: int) -> list[list[int]]:
        """Places of each topic's heaviest terms, the first of equals first."""
        return [np.lexsort((np.arange(len(row)), -row))[:n].tolist() for row in self.counts]


def count_vectors(docs: DataFrame, vocab: Sequence[str], text: str = "text") -> DataFrame:
    """``docs`` with ``_vector``, the counts of each text's vocabulary terms as a sparse vector."""
    counter = CountVectorizerModel.from_vocabulary(list(vocab), inputCol="_terms", outputCol="_vector")
    found = F.coalesce(terms(F.col(text)), F.array().cast("array<string>"))
    return counter.transform(docs.withColumn("_terms", found)).drop("_terms")


def term_vectors(docs: DataFrame, vocab: Sequence[str], text: str = "text") -> DataFrame:
    """``docs`` with the places of each text's vocabulary terms and how often they occur.

    Two arrays, ``_places`` and ``_times``; empty ones for null and empty texts.
    """
    packed = term_batch.packed_letters(docs.sparkSession)

    @F.arrow_udf("struct<places:array<int>,times:array<int>>")
    def find(texts: pa.Array) -> pa.Array:
        table, names = term_batch.unpacked(packed), pa.array(vocab, pa.string())
        lists = [[pa.array([], pa.list_(pa.int32()))] * 2]
        lists += [term_batch.block_places(*block, table, names) for block in term_batch.text_blocks(texts)]
        return pa.StructArray.from_arrays([pa.concat_arrays(x) for x in zip(*lists)], ["places", "times"])

    found = docs.withColumn("_terms", find(F.lower(F.col(text))))
    return found.withColumns({"_places": F.col("_terms.places"), "_times": F.col("_terms.times")}).drop("_terms")


def divide(
    bounds: np.ndarray, places: np.ndarray, times: np.ndarray, weights: np.ndarray, priors: Priors
) -> tuple[np.ndarray, np.ndarray]:
    """Shares of texts, and the parts of each of their terms in the last round.

    Text i has the terms ``bounds[i]`` to ``bounds[i + 1]``. A text without any has equal shares.
    """
    texts, topics = len(bounds) - 1, len(weights)
    sizes = np.diff(bounds)
    filled = np.flatnonzero(sizes)
    own = weights[:, places]
    units = times.astype(np.float64) * UNIT
    shares = np.full((topics, texts), 1.0) / topics
    parts = np.zeros((topics, len(places)))
    for _ in range(priors.rounds):
        parts = np.repeat(shares, sizes, axis=1)
        parts *= own
        whole = parts[0].copy()
        for one in parts[1:]:
            whole += one
        parts /= whole
        parts *= units
        parts += 0.5
        np.floor(parts, out=parts)
        sums = np.zeros((topics, texts), np.int64)
        if len(filled):
            sums[:, filled] = np.add.reduceat(parts, bounds[filled], axis=1)
        total = sums.sum(axis=0) + topics * priors.share
        shares = (sums + priors.share).astype(np.float64) / total.astype(np.float64)
    return shares, parts


def _blocks(places: pa.Array, times: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``BLOCK`` terms, as bounds, places and times."""
    bounds = places.offsets.to_numpy().astype(np.int64)
    flat, values = places.flatten().to_numpy(), times.flatten().to_numpy()
    bounds, start = bounds - bounds[0], 0
    while start < len(bounds) - 1:
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + BLOCK, side="right")) - 1)
        some = slice(bounds[start], bounds[end])
        yield bounds[start : end + 1] - bounds[start], flat[some], values[some]
        start = end


def expected_counts(vectors: DataFrame, matrix: TopicMatrix) -> DataFrame:
    """topic, place, n: occurrences of each term that all texts together give each topic."""
    weights, priors = matrix.weights(), matrix.priors
    topics, size = weights.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((topics, size), np.int64)
        for batch in batches:
            for bounds, places, times in _blocks(batch.column("_places"), batch.column("_times")):
                _, parts = divide(bounds, places, times, weights, priors)
                for topic in range(topics):
                    total[topic] += np.bincount(places, parts[topic], size).astype(np.int64)
        topic, place = np.nonzero(total)
        columns = [pa.array(topic.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total[topic, place])]
        yield pa.RecordBatch.from_arrays(columns, names=["topic", "place", "n"])

    sums = vectors.select("_places", "_times").mapInArrow(add, "topic int, place int, n long")
    return sums.groupBy("topic", "place").agg(F.sum("n").alias("n"))


def fit(vectors: DataFrame, size: int, topics: int, passes: int, seed: int, priors: Priors) -> TopicMatrix:
    """The matrix after ``passes`` passes over all texts; topics times terms reach the driver."""
    matrix = TopicMatrix.start(topics, size, seed, priors)
    for _ in range(passes):
        counts = np.zeros((topics, size), np.int64)
        for row in expected_counts(vectors, matrix).collect():
            counts[row.topic, row.place] = row.n
        matrix = TopicMatrix(counts, priors)
    return matrix


def shares(matrix: TopicMatrix) -> Column:
    """``array<double>`` of a row's topic shares, from its ``_places`` and ``_times``."""
    weights, priors = matrix.weights(), matrix.priors

    @F.arrow_udf("array<double>")
    def find(places: pa.Array, times: pa.Array) -> pa.Array:
        found = [divide(*block, weights, priors)[0].T.ravel() for block in _blocks(places, times)]
        values = np.concatenate(found) if found else np.empty(0)
        bounds = np.arange(len(places) + 1, dtype=np.int32) * len(weights)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))

    return find("_places", "_times")


def log_likelihood(vectors: DataFrame, matrix: TopicMatrix) -> tuple[float, float]:
    """Log-likelihood of the texts' terms with the texts' own shares, and their number.

    Perplexity is exp(-first / second).
    """
    weights, priors = matrix.weights(), matrix.priors

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = words = 0.0
        for batch in batches:
            for bounds, places, times in _blocks(batch.column("_places"), batch.column("_times")):
                found, _ = divide(bounds, places, times, weights, priors)
                row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                total += float((times * np.log((found[:, row] * weights[:, places]).sum(axis=0))).sum())
                words += float(times.sum())
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([words])], names=["total", "words"])

    sums = vectors.select("_places", "_times").mapInArrow(add, "total double, words double")
    return tuple(sums.agg(F.sum("total"), F.sum("words")).first())
