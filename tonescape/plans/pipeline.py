"""The batch job: raw tables, sentiment, topics, result tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tonescape.functions.scalar import now_utc
from tonescape.functions.sentiment import Lexicon
from tonescape.operators.enrich import topic_columns
from tonescape.operators.topics import TopicOptions, fit_topics, no_topics
from tonescape.operators.unify import dedup_headlines, dedup_unified, unify_all
from tonescape.session import stage
from tonescape.sources import tables


@dataclass
class RunResult:
    run_id: str
    rows: dict[str, int] = field(default_factory=dict)


def run(
    spark: SparkSession,
    root: str,
    lexicon: Lexicon,
    posts: DataFrame | None = None,
    tweets: DataFrame | None = None,
    headlines: DataFrame | None = None,
    topic_options: TopicOptions | None = None,
    news_id: str = "number",
    run_ts=None,
    run_id: str | None = None,
) -> RunResult:
    """Append one run to the tables below ``root``; feeds are optional.

    A run that was broken off can be started again with its ``run_id``: each table's rows of
    that run are replaced. The run is logged when all of its tables are written.

    Each feed is written to its raw table first and read back from there, so landed
    dumps and HTML are parsed once. Topics are assigned row by row; the only shuffles
    over all rows are the two deduplications and the news numbering.
    """
    run_ts = run_ts or now_utc()
    result = RunResult(run_id or uuid.uuid4().hex)

    def append(df: DataFrame, table: str) -> DataFrame:
        result.rows[table] = tables.append_table(df, root, table, result.run_id)
        return tables.read_table(spark, root, table, result.run_id)

    feeds: dict[str, DataFrame] = {}
    if posts is not None:
        feeds["posts"] = append(posts, tables.RAW_POSTS)
    if tweets is not None:
        feeds["tweets"] = append(tweets, tables.RAW_TWEETS)
    if headlines is not None:
        order = [c for c in ("page_id", "position") if c in headlines.columns]
        order = ["extracted_at", *order, "source", "category"]
        feeds["headlines"] = append(dedup_headlines(headlines, order), tables.RAW_HEADLINES)
    if not feeds:
        return result

    unified = stage(unify_all(lexicon, run_ts=run_ts, news_id=news_id, **feeds), "unified")
    model = fit_topics(unified, topic_options)
    unique = dedup_unified(unified, ["created_at", "text"])
    if model is None:
        append(no_topics(unique), tables.SENTIMENT)
    else:
        append(model.assign(unique).withColumns(topic_columns()), tables.SENTIMENT)
        append(model.topics(spark, run_ts, result.run_id), tables.TOPICS)
    tables.finish_run(spark, root, result.run_id)
    return result
