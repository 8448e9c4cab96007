"""All reports of the dashboard from one pass over a result table, or from its stored sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tonescape.operators import graph, panels, report
from tonescape.session import stage
from tonescape.sources import tables


def reports(
    results: DataFrame,
    topics: DataFrame,
    start=None,
    end=None,
    selected_topics: Sequence[int] = (),
) -> dict[str, DataFrame]:
    """One table per panel. The results are read once, here; the panels merge their sums."""
    return from_sums(stage(panels.panel_sums(results), "panels"), topics, start, end, selected_topics)


def stored_reports(
    spark: SparkSession, root: str, start=None, end=None, selected_topics: Sequence[int] = ()
) -> dict[str, DataFrame]:
    """The panels of all finished runs below ``root``: no result row is read."""
    topics = tables.latest_run(tables.read_table(spark, root, tables.TOPICS))
    return from_sums(tables.read_sums(spark, root), topics, start, end, selected_topics)


def from_sums(
    sums: DataFrame,
    topics: DataFrame,
    start=None,
    end=None,
    selected_topics: Sequence[int] = (),
) -> dict[str, DataFrame]:
    """One lazy table per panel, over the range of days (default: the last week)."""
    filtered = panels.last_week(sums) if start is None or end is None else panels.in_days(sums, start, end)
    filtered = report.with_topics(filtered, selected_topics)
    by_topic = panels.mean_by(filtered, "topic_id")
    terms = graph.topic_terms(topics)
    strong = graph.strong_terms(terms)
    return {
        "topic_options": report.topic_options(sums),
        "overview": panels.overview(filtered),
        "histogram": panels.histogram(filtered),
        "sentiment_by_source": panels.mean_by(filtered, "source"),
        "sentiment_by_topic": by_topic,
        "topics_by_source": report.topics_by_source_keywords(panels.topics_by_source(filtered), topics),
        "topic_terms": terms,
        "nodes": graph.graph_nodes(strong, by_topic),
        "edges": graph.graph_edges(strong),
    }
