"""Topics of a corpus: vocabulary, counts, LDA, assignment.

A model is a topic-term matrix. It is fitted either by passes over all texts that give the
same matrix to the last digit on every cluster (``exact``), or by Spark's online LDA on drawn
shares of them (``online``). Texts are folded into the matrix in the same way for both.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescape import schemas
from tonescape.functions.scalar import argmax, ntz, topic_name
from tonescape.functions.text import terms
from tonescape.operators import fold_in
from tonescape.operators.frequent import frequent_terms
from tonescape.session import option_table, stage

@dataclass(frozen=True)
class TopicOptions:
    n_topics: int = 5
    max_features: int = 1000
    n_keywords: int = 10
    seed: int = 30
    learning_offset: float = 10.0
    learning_decay: float = 0.7
    passes: int = 10
    #: Share of the texts that one iteration draws, whatever their number.
    share: float = 0.2
    stop_words: Sequence[str] | None = None
    min_texts: int = 11
    #: ``exact`` or ``online``; the offset, the decay and the share count for ``online`` only.
    method: str = "exact"
    priors: fold_in.Priors = fold_in.Priors()

    @property
    def iterations(self) -> int:
        """Iterations that draw as many texts as ``passes`` passes have."""
        return math.ceil(self.passes / self.share - 1e-9)


def stop_word_list(options: TopicOptions, spark: SparkSession) -> list[str]:
    if options.stop_words is not None:
        return list(options.stop_words)
    return StopWordsRemover.loadDefaultStopWords("english")


def drop_stop_words(counts: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    words = option_table(counts.sparkSession, [(w,) for w in stop_words], "term string")
    return counts.join(words, "term", "left_anti")


def doc_term_counts(docs: DataFrame, vocab: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Counts of vocabulary terms per document; a document is combined before the shuffle."""
    return (
        docs.select(key, F.explode(terms(F.col(text))).alias("term"))
        .join(vocab.select("term"), "term")
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


class TopicModel:
    """A fitted model: assigns topics row by row, without a join or a shuffle."""

    def __init__(
        self,
        vocab: list[str],
        matrix: fold_in.TopicMatrix | None,
        keywords: list[list[str]],
        options: TopicOptions | None,
    ):
        self.vocab, self.matrix, self.keywords, self.options = vocab, matrix, keywords, options

    @property
    def n_topics(self) -> int:
        return self.options.n_topics

    def keywords_of(self, topic_id: Column) -> Column:
        """Keywords of a topic id; an empty list for an unknown one."""
        table = F.array(*[F.array(*[F.lit(w) for w in words]) for words in self.keywords])
        known = F.when(topic_id >= 0, F.get(table, topic_id))
        return F.coalesce(known, F.array().cast("array<string>"))

    def assign(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Adds ``topic_id``, ``topic_confidence`` and ``topic_keywords`` to every row."""
        # A text without known terms has all topics alike: the first one is taken.
        return (
            fold_in.term_vectors(docs, self.vocab, text)
            .withColumn("_shares", fold_in.shares(self.matrix))
            .withColumn("topic_id", argmax(F.col("_shares")))
            .withColumn("topic_confidence", F.array_max("_shares"))
            .withColumn("topic_keywords", self.keywords_of(F.col("topic_id")))
            .drop("_places", "_times", "_shares")
        )

    def top_terms(self, spark: SparkSession, n: int = 10) -> DataFrame:
        """topic_id, place, term and weight (its share of the topic) of the heaviest terms."""
        weights = self.matrix.weights()
        rows = [
            (topic, place, self.vocab[term], float(weights[topic, term]))
            for topic, best in enumerate(self.matrix.top(n))
            for place, term in enumerate(best)
        ]
        return spark.createDataFrame(rows, "topic_id int, place int, term string, weight double")

    def topics(self, spark: SparkSession, created_at=None, run_id: str | None = None) -> DataFrame:
        """The topic dimension: one row per topic."""
        rows = [(i, words) for i, words in enumerate(self.keywords)]
        return spark.createDataFrame(rows, "topic_id int, topic_keywords array<string>").select(
            "topic_id",
            topic_name(F.col("topic_id"), F.col("topic_keywords")).alias("topic_name"),
            "topic_keywords",
            ntz(created_at).alias("created_at"),
            F.lit(run_id).cast("string").alias("run_id"),
        )


def _online(vectors: DataFrame, options: TopicOptions) -> fold_in.TopicMatrix:
    """Spark's online LDA; its topics as counts of the same unit."""
    fitted = LDA(
        k=options.n_topics,
        optimizer="online",
        seed=options.seed,
        learningOffset=options.learning_offset,
        learningDecay=options.learning_decay,
        optimizeDocConcentration=False,
        subsamplingRate=options.share,
        maxIter=options.iterations,
        featuresCol="_vector",
    ).fit(vectors)
    weights = fitted.topicsMatrix().toArray().T
    return fold_in.TopicMatrix(np.floor(weights * fold_in.UNIT + 0.5), options.priors)


def fit_topics(
    docs: DataFrame, options: TopicOptions | None = None, text: str = "text"
) -> TopicModel | None:
    """Fit the model; ``None`` when there are too few texts, or no term in them.

    Only the vocabulary and topics times terms come to the driver, both limited by options.
    The counts are stored once, because every pass reads them.
    """
    options = options or TopicOptions()
    if options.method not in ("exact", "online"):
        raise ValueError(f"unknown method: {options.method!r}")
    spark = docs.sparkSession
    if docs.select(text).limit(options.min_texts).count() < options.min_texts:
        return None
    stop_words = set(stop_word_list(options, spark))
    # So many terms hold the most frequent others, whichever of the stop words are among them.
    rows = frequent_terms(docs, options.max_features + len(stop_words), text).orderBy("rank").select("term").collect()
    vocab = sorted([r.term for r in rows if r.term not in stop_words][: options.max_features])
    if not vocab:
        return None
    if options.method == "online":
        matrix = _online(stage(fold_in.count_vectors(docs.select(text), vocab, text).drop(text), "counts"), options)
    else:
        vectors = stage(fold_in.term_vectors(docs.select(text), vocab, text).drop(text), "counts")
        matrix = fold_in.fit(vectors, len(vocab), options.n_topics, options.passes, options.seed, options.priors)
    keywords = [[vocab[i] for i in best] for best in matrix.top(options.n_keywords)]
    return TopicModel(vocab, matrix, keywords, options)


def topic_names(topics: DataFrame) -> DataFrame:
    return topics.select(
        "topic_id", topic_name(F.col("topic_id"), F.col("topic_keywords")).alias("topic_name")
    )


def no_topics(unified: DataFrame) -> DataFrame:
    """Default topic columns, for runs without a model."""
    return unified.withColumns(
        {
            "topic_id": F.lit(schemas.NO_TOPIC_ID),
            "topic_confidence": F.lit(schemas.NO_TOPIC_CONFIDENCE),
            "topic_keywords": F.lit(schemas.NO_TOPIC_KEYWORDS),
        }
    )
