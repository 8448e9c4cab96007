"""Fixed table schemas. Times are naive and in UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_POSTS = (
    "id string, title string, selftext string, created_utc double, score string, "
    "num_comments string, url string, author string, subreddit string"
)
POSTS = (
    "id string, title string, text string, created_utc timestamp_ntz, score int, "
    "num_comments int, url string, author string, subreddit string, source string"
)
TWEETS = (
    "id bigint, text string, created_at timestamp_ntz, user_id bigint, user_name string, "
    "user_followers bigint, retweet_count bigint, reply_count bigint, like_count bigint, "
    "quote_count bigint, location string, keyword string, source string"
)
RAW_TWEETS = (
    "id bigint, text string, created_at timestamp_ntz, author_id bigint, retweet_count bigint, "
    "reply_count bigint, like_count bigint, quote_count bigint, is_retweet boolean"
)
USERS = "id bigint, username string, followers_count bigint, location string"
PAGES = "page_id bigint, source string, category string, html string"
HEADLINES = (
    "title string, url string, source string, category string, extracted_at timestamp_ntz, "
    "page_id bigint, position int"
)
UNIFIED = (
    "source string, source_id string, text string, created_at timestamp_ntz, "
    "sentiment_compound double, sentiment_positive double, sentiment_neutral double, "
    "sentiment_negative double, processed_at timestamp_ntz"
)
SENTIMENT_ANALYSIS = (
    f"{UNIFIED}, topic_id int, topic_confidence double, topic_keywords string, run_id string"
)
TOPICS = (
    "topic_id int, topic_name string, topic_keywords array<string>, "
    "created_at timestamp_ntz, run_id string"
)
LEXICON = "token string, valence double"

# What a text without a topic gets.
NO_TOPIC_ID = -1
NO_TOPIC_CONFIDENCE = 0.0
NO_TOPIC_KEYWORDS = "Unknown"


def columns(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)
