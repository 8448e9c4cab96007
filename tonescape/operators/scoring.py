"""Sentiment columns for each feed. Every function is a narrow pass over its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.functions.scalar import ntz
from tonescape.functions.sentiment import Lexicon, score

# Names of the flat columns.
PARTS = {"compound": "compound", "positive": "pos", "neutral": "neu", "negative": "neg"}


def _flat(struct: str, prefix: str) -> dict:
    return {f"{prefix}_{name}": F.col(f"{struct}.{part}") for name, part in PARTS.items()}


def score_posts(posts: DataFrame, lexicon: Lexicon, run_ts=None) -> DataFrame:
    """All scores of the title, and the compound of the body where there is one."""
    out = posts.withColumn("title_sentiment", score("title", lexicon))
    out = out.withColumns(_flat("title_sentiment", "title_sentiment"))
    if "text" in posts.columns:
        out = out.withColumn("text_sentiment", score("text", lexicon))
        out = out.withColumn("text_sentiment_compound", F.col("text_sentiment.compound"))
    return out.withColumn("processed_at", ntz(run_ts))


def score_tweets(tweets: DataFrame, lexicon: Lexicon, run_ts=None) -> DataFrame:
    return (
        tweets.withColumn("text_sentiment", score("text", lexicon))
        .withColumns(_flat("text_sentiment", "sentiment"))
        .withColumn("processed_at", ntz(run_ts))
    )


def score_headlines(headlines: DataFrame, lexicon: Lexicon, run_ts=None) -> DataFrame:
    return (
        headlines.withColumn("title_sentiment", score("title", lexicon))
        .withColumns(_flat("title_sentiment", "sentiment"))
        .withColumn("processed_at", ntz(run_ts))
    )
