"""Topics and keywords as terms, nodes, edges and a matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.functions.scalar import first_n, topic_label, unit_interval

TOP_SCORE = 10
STRONG = 5


def topic_terms(topics: DataFrame) -> DataFrame:
    """One row per topic and keyword, ten points for the first keyword down to one."""
    return topics.select(
        "topic_id",
        F.posexplode(first_n(F.col("topic_keywords"), TOP_SCORE)).alias("pos", "keyword"),
    ).select("topic_id", "keyword", (F.lit(TOP_SCORE) - F.col("pos")).alias("score"))


def strong_terms(terms: DataFrame, threshold: int = STRONG) -> DataFrame:
    return terms.filter(F.col("score") >= threshold)


def graph_nodes(strong: DataFrame, topic_means: DataFrame) -> DataFrame:
    """Topic nodes with their mean sentiment (0 when unknown), and keyword nodes."""
    topics = (
        strong.select("topic_id")
        .distinct()
        .join(topic_means, "topic_id", "left")
        .select(
            topic_label(F.col("topic_id")).alias("id"),
            F.lit("topic").alias("type"),
            F.coalesce("avg_compound", F.lit(0.0)).alias("sentiment"),
        )
    )
    keywords = strong.select(
        F.col("keyword").alias("id"),
        F.lit("keyword").alias("type"),
        F.lit(None).cast("double").alias("sentiment"),
    ).distinct()
    return topics.unionByName(keywords)


def normalized_sentiment(nodes: DataFrame) -> DataFrame:
    """Topic nodes with their sentiment rescaled to [0, 1]."""
    return nodes.filter(F.col("type") == "topic").select(
        "id", unit_interval(F.col("sentiment")).alias("normalized")
    )


def graph_edges(strong: DataFrame, order: Sequence[str] = ("score",)) -> DataFrame:
    """One undirected edge per topic and keyword; the last weight in ``order`` counts."""
    return strong.groupBy(
        topic_label(F.col("topic_id")).alias("src"), F.col("keyword").alias("dst")
    ).agg(F.max_by("score", F.struct(*order)).alias("weight"))


def keyword_matrix(terms: DataFrame, topic_ids: Sequence[int]) -> DataFrame:
    """Keywords by topics; null where a topic does not have the keyword."""
    wide = terms.groupBy("keyword").pivot("topic_id", list(topic_ids)).agg(F.max("score"))
    return wide.select(
        "keyword", *[F.col(f"`{i}`").alias(f"topic_{i}") for i in topic_ids]
    )
