"""The three scored feeds as one table, and its deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescape.functions.sentiment import Lexicon
from tonescape.functions.text import non_empty
from tonescape.operators.numbering import number_rows
from tonescape.operators.ranking import keep_first
from tonescape.operators.scoring import PARTS, score_headlines, score_posts, score_tweets


def _project(
    scored: DataFrame,
    source: str,
    source_id: Column,
    text: str,
    created: str,
    prefix: str,
    keep: Sequence[str],
) -> DataFrame:
    scores = [
        F.coalesce(f"{prefix}_{name}", F.lit(0.0)).alias(f"sentiment_{name}") for name in PARTS
    ]
    return scored.select(
        F.lit(source).alias("source"),
        source_id.alias("source_id"),
        F.col(text).alias("text"),
        F.col(created).alias("created_at"),
        *scores,
        "processed_at",
        *keep,
    )


def unify_posts(scored: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The title is the text; the id is the url, or the title when that is empty."""
    url = non_empty(F.col("url")) if "url" in scored.columns else F.lit(None).cast("string")
    source_id = F.coalesce(url, F.col("title"))
    return _project(scored, "reddit", source_id, "title", "created_utc", "title_sentiment", keep)


def unify_tweets(scored: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    source_id = F.col("id").cast("string")
    return _project(scored, "twitter", source_id, "text", "created_at", "sentiment", keep)


NEWS_ORDER = ("extracted_at", "page_id", "position", "source", "category", "title", "url")


def number_news(headlines: DataFrame, order: Sequence[str] = NEWS_ORDER) -> DataFrame:
    """Adds ``news_number``. Best done before scoring: ranges are found by a pass of their own.

    Columns of ``order`` that a feed lacks are left out.
    """
    known = [F.col(c) for c in order if c in headlines.columns]
    return number_rows(headlines, known, "news_number")


def unify_news(
    scored: DataFrame,
    keep: Sequence[str] = (),
    news_id: str = "number",
    order: Sequence[str] = NEWS_ORDER,
) -> DataFrame:
    """Ids are ``news_<n>`` in ``order``, or with ``news_id='url'`` a hash of the link."""
    if news_id == "url":
        source_id = F.sha2(F.coalesce(non_empty(F.col("url")), F.col("title")), 256)
    elif news_id == "number":
        if "news_number" not in scored.columns:
            scored = number_news(scored, order)
        source_id = F.concat(F.lit("news_"), F.col("news_number").cast("string"))
    else:
        raise ValueError("news_id is 'number' or 'url'")
    return _project(scored, "news", source_id, "title", "extracted_at", "sentiment", keep)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def unify_all(
    lexicon: Lexicon,
    posts: DataFrame | None = None,
    tweets: DataFrame | None = None,
    headlines: DataFrame | None = None,
    run_ts=None,
    keep: Sequence[str] = (),
    news_id: str = "number",
    news_order: Sequence[str] = NEWS_ORDER,
) -> DataFrame:
    """Score every feed that is there and unite them; a missing feed adds nothing."""
    parts = []
    if posts is not None:
        parts.append(unify_posts(score_posts(posts, lexicon, run_ts), keep))
    if tweets is not None:
        parts.append(unify_tweets(score_tweets(tweets, lexicon, run_ts), keep))
    if headlines is not None:
        if news_id == "number":
            headlines = number_news(headlines, news_order)
        scored = score_headlines(headlines, lexicon, run_ts)
        parts.append(unify_news(scored, keep, news_id))
    if not parts:
        raise ValueError("at least one feed is needed")
    return union_all(parts)


def dedup_headlines(headlines: DataFrame, order: Sequence[str]) -> DataFrame:
    return keep_first(headlines, ["title", "url"], [F.col(c) for c in order])


def dedup_unified(unified: DataFrame, order: Sequence[str]) -> DataFrame:
    return keep_first(unified, ["source", "source_id"], [F.col(c) for c in order])


def corpus(
    posts: DataFrame | None = None,
    tweets: DataFrame | None = None,
    headlines: DataFrame | None = None,
) -> DataFrame:
    """``(source, text)`` of every text of every feed."""
    parts = []
    if posts is not None:
        parts.append(posts.select(F.lit("reddit").alias("source"), F.col("title").alias("text")))
    if tweets is not None:
        parts.append(tweets.select(F.lit("twitter").alias("source"), "text"))
    if headlines is not None:
        parts.append(headlines.select(F.lit("news").alias("source"), F.col("title").alias("text")))
    return union_all(parts)
