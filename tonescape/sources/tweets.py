"""Short messages: keyword search, author lookup, limits."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescape import schemas
from tonescape.functions.text import words
from tonescape.operators.lookup import lookup_join, unique_last
from tonescape.operators.ranking import first_per_group
from tonescape.session import option_table

# The smallest and largest page the search serves.
LIMIT_MIN = 10
LIMIT_MAX = 100

#: Up to so many terms are looked up by their first word, without a count of the messages' words.
FEW_TERMS = 100
#: Bytes of terms and their words that every task may have.
INDEX_BYTES = 32 << 20


def read_messages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed messages, ready to be searched."""
    return spark.read.schema(schemas.RAW_TWEETS).format(fmt).load(path)


def read_users(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schemas.USERS).format(fmt).load(path)


def clamp_limit(requested: int) -> int:
    """0 stays 0, 1 to 9 become 10, more than 100 becomes 100."""
    if requested < 0:
        raise ValueError("the number of results must not be negative")
    if requested == 0:
        return 0
    return min(max(requested, LIMIT_MIN), LIMIT_MAX)


def drop_retweets(tweets: DataFrame) -> DataFrame:
    if "is_retweet" in tweets.columns:
        return tweets.filter(~F.coalesce("is_retweet", F.lit(False)))
    return tweets.filter(~F.coalesce(F.startswith("text", F.lit("RT @")), F.lit(False)))


def term_words(term: str) -> list[str]:
    """The words of a search term, cut as the words of a message are."""
    found = _WORD.findall(term.lower())
    if not found:
        raise ValueError(f"a search term needs a word: {term!r}")
    return found


_WORD = re.compile(r"\w+")


def word_counts(tweets: DataFrame, wanted: Sequence[str]) -> dict[str, int]:
    """Messages that hold each of some words; words of no message are left out.

    Counts are combined before their shuffle; what comes back is no longer than the list.
    """
    known = option_table(tweets.sparkSession, [(w,) for w in wanted], "_word string")
    held = tweets.select(F.explode(F.array_distinct(words(F.col("text")))).alias("_word"))
    counts = held.groupBy("_word").agg(F.count(F.lit(1)).alias("n")).join(known, "_word", "left_semi")
    return {r["_word"]: r["n"] for r in counts.collect()}


def _keys(tweets: DataFrame, listed: dict[str, list[str]]) -> dict[str, list[str]]:
    """Terms by the word that they are looked up under.

    Few terms: their first word. Many: the word that the fewest messages hold, so that a
    message meets few terms it does not match; a term with a word of no message is dropped.
    """
    keyed: dict[str, list[str]] = {}
    counts = None
    if len(listed) > FEW_TERMS:
        counts = word_counts(tweets, sorted({w for found in listed.values() for w in found}))
    for term, found in listed.items():
        if counts is None:
            keyed.setdefault(found[0], []).append(term)
        elif all(w in counts for w in found):
            keyed.setdefault(min(found, key=lambda w: (counts[w], w)), []).append(term)
    return keyed


def match_terms(tweets: DataFrame, terms: Sequence[str]) -> DataFrame:
    """One row per (message, term) where the message has every word of the term.

    An index of the terms, by one of their words each, is joined with the messages' words;
    the other words are checked in the same row. The index is sent to every task, so no
    message is shuffled and a word of a third of all messages is nobody's burden. An index of
    more than ``INDEX_BYTES`` is joined by shuffle, and the messages of a hot word are spread.
    """
    listed = {t: term_words(t) for t in dict.fromkeys(terms)}
    keyed = _keys(tweets, listed)
    rows = [(word, [(t, listed[t]) for t in found]) for word, found in keyed.items()]
    schema = "_word string, _terms array<struct<keyword:string,words:array<string>>>"
    index = tweets.sparkSession.createDataFrame(rows, schema)
    size = sum(len(t.encode()) + sum(len(w.encode()) + 16 for w in listed[t]) for found in keyed.values() for t in found)
    has = F.col("_has")
    firsts = list(keyed)
    # With a short list, only its words go on to the join.
    begins = F.array_intersect(has, F.lit(firsts)) if 0 < len(firsts) <= FEW_TERMS else has
    exploded = (
        tweets.drop("keyword")
        .withColumn("_has", F.array_distinct(words(F.col("text"))))
        .withColumn("_word", F.explode(begins))
    )
    if size <= INDEX_BYTES:
        joined = exploded.join(F.broadcast(index), "_word")
    else:
        joined = lookup_join(exploded, index, "_word", tweets.drop("keyword").columns)
    return (
        joined.withColumn("_term", F.explode("_terms"))
        .filter(F.size(F.array_except("_term.words", "_has")) == 0)
        .withColumn("keyword", F.col("_term.keyword"))
        .drop("_has", "_word", "_terms", "_term")
    )


def search_terms(
    tweets: DataFrame, terms: Sequence[str], per_term: int = 100, include_retweets: bool = False
) -> DataFrame:
    """The newest messages of every term, tagged with it; all terms are kept."""
    limit = clamp_limit(per_term)
    if not include_retweets:
        tweets = drop_retweets(tweets)
    matched = match_terms(tweets, terms)
    if limit == 0:
        return matched.limit(0)
    newest = [F.col("created_at").desc(), F.col("id").desc()]
    return first_per_group(matched, ["keyword"], newest, limit)


def search(
    tweets: DataFrame, keyword: str, max_results: int = 100, include_retweets: bool = False
) -> DataFrame:
    return search_terms(tweets, [keyword], max_results, include_retweets)


def search_with_authors(
    messages: DataFrame,
    users: DataFrame,
    terms: Sequence[str],
    per_term: int = 100,
    include_retweets: bool = False,
) -> DataFrame:
    """Search first, then look up the authors of what was found: at most 100 rows per term."""
    return with_authors(search_terms(messages, terms, per_term, include_retweets), users)


def with_authors(tweets: DataFrame, users: DataFrame) -> DataFrame:
    """Messages with author fields; null where the author is unknown.

    An author that was landed more than once counts with the last row (by all columns).
    """
    fields = ["username", "followers_count", "location"]
    order = ["landed_at"] if "landed_at" in users.columns else []
    authors = unique_last(
        users.select(F.col("id").alias("author_id"), *fields, *order),
        ["author_id"],
        [F.col(c) for c in [*order, *fields]],
    ).drop(*order)
    keyword = F.col("keyword") if "keyword" in tweets.columns else F.lit(None).cast("string")
    return lookup_join(tweets, authors, "author_id", ["id"]).select(
        "id",
        "text",
        "created_at",
        F.col("author_id").alias("user_id"),
        F.col("username").alias("user_name"),
        F.col("followers_count").alias("user_followers"),
        "retweet_count",
        "reply_count",
        "like_count",
        "quote_count",
        "location",
        keyword.alias("keyword"),
        F.lit("twitter").alias("source"),
    )
