"""Feeds, a lexicon and surrogate topics derived from the given tables (Spark side).

Everything is computed from whole tables; ``fixtures/oracle.py`` states the same views in
SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescape.functions.scalar import ntz
from tonescape.functions.sentiment import Lexicon
from tonescape.functions.text import title_of
from tonescape.operators.enrich import topic_enrich
from tonescape.operators.frequent import token_counts, vocabulary
from tonescape.operators.panels import panel_sums
from tonescape.operators.topics import TopicModel, TopicOptions, fit_topics
from tonescape.operators.unify import unify_all
from tonescape.session import stage
from tonescape.sources.headlines import Profile, extract_headlines
from tonescape.sources.posts import scan_posts

# The given pages mark headlines with <h1>, and links with <a>.
H1 = Profile("h1")
ANCHOR = Profile("a")

# Words that say nothing about a topic.
STOP_WORDS = "the of and to in is it that for with as was are be by on at from this but not have they".split()
TOPICS = TopicOptions(stop_words=STOP_WORDS)

_cache: dict[tuple, object] = {}


def _once(spark: SparkSession, name: str, sf_dir: str, make):
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _cache:
        _cache[key] = make()
    return _cache[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def raw_posts(spark, sf_dir):
    """Landed posts: times in epoch seconds, counts as strings, some urls empty."""
    doc_id = F.col("doc_id")
    url = F.concat(F.lit("https://x.example/"), doc_id.cast("string"))
    return documents(spark, sf_dir).select(
        doc_id.cast("string").alias("id"),
        title_of(F.col("text")).alias("title"),
        F.col("text").alias("selftext"),
        (F.lit(1704067200.0) + doc_id * 60).alias("created_utc"),
        (F.col("n_chars") % 1000).cast("string").alias("score"),
        (F.col("n_chars") % 37).cast("string").alias("num_comments"),
        F.when(doc_id % 10 == 0, F.lit("")).otherwise(url).alias("url"),
        F.col("lang").alias("author"),
        F.col("source").alias("subreddit"),
    )


def posts(spark, sf_dir):
    return scan_posts(raw_posts(spark, sf_dir)).withColumn("seq", F.col("id").cast("bigint"))


def tweets(spark, sf_dir):
    number = F.col("conv_id") * 100 + F.col("turn")
    minutes = F.col("conv_id") * 10 + F.col("turn")
    size = F.length("text").cast("bigint")
    return (
        table(spark, sf_dir, "conversations")
        .select(
            number.alias("id"),
            "text",
            F.timestamp_add("MINUTE", minutes, ntz("2024-01-01 00:00:00")).alias("created_at"),
            (F.col("conv_id") % 1500).alias("user_id"),
            F.lit(None).cast("string").alias("user_name"),
            F.lit(None).cast("bigint").alias("user_followers"),
            (size % 7).alias("retweet_count"),
            (size % 11).alias("reply_count"),
            (size % 13).alias("like_count"),
            (size % 17).alias("quote_count"),
            F.lit(None).cast("string").alias("location"),
            F.lit(None).cast("string").alias("keyword"),
            F.lit("twitter").alias("source"),
            number.alias("seq"),
        )
    )


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.col("url").alias("page_url"),
        F.when(F.col("page_id") % 2 == 0, F.lit("bbc")).otherwise("cnn").alias("source"),
        F.regexp_extract("url", r"https?://[^/]+/([a-z]+)/", 1).alias("category"),
        "html",
    )


def headlines(spark, sf_dir):
    when = F.timestamp_add("MINUTE", F.col("page_id"), ntz("2024-01-02 00:00:00"))
    return extract_headlines(pages(spark, sf_dir), H1, when).select(
        "title",
        F.col("page_url").alias("url"),
        "source",
        "category",
        "extracted_at",
        F.col("page_id").alias("seq"),
    )


#: First terms that are counted once per session and data, for all shorter lists.
VOCAB = 1000


def vocab(spark, sf_dir, size: int = 400):
    """The most frequent terms with their ranks; the texts are read once for all lists."""
    make = lambda: stage(vocabulary(token_counts(documents(spark, sf_dir)), max(size, VOCAB)), "vocab")
    first = _once(spark, "vocab" if size <= VOCAB else f"vocab {size}", sf_dir, make)
    return first.filter(F.col("rank") <= size)


def lexicon_table(spark, sf_dir):
    mixed = (F.length("term") * 7 + F.ascii("term")) % 41
    return (
        vocab(spark, sf_dir)
        .filter(F.col("term").rlike("^[a-z]{3,}$") & (mixed != 20))
        .select(F.col("term").alias("token"), ((mixed - 20).cast("double") / 10).alias("valence"))
    )


def lexicon(spark, sf_dir) -> Lexicon:
    return _once(
        spark, "lexicon", sf_dir, lambda: Lexicon.from_table(lexicon_table(spark, sf_dir))
    )


def topics(spark, sf_dir):
    """Surrogate topics: the fifty most frequent terms dealt to five topics."""
    place = F.col("rank")
    return (
        vocab(spark, sf_dir, 50)
        .groupBy(((place - 1) % 5).cast("int").alias("topic_id"))
        .agg(F.array_sort(F.collect_list(F.struct(place, F.col("term")))).alias("ranked"))
        .select(
            "topic_id",
            F.transform("ranked", lambda r: r["term"]).alias("topic_keywords"),
            ntz("2024-01-01 00:00:00").alias("created_at"),
        )
    )


def feeds(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "posts": posts(spark, sf_dir),
        "tweets": tweets(spark, sf_dir),
        "headlines": headlines(spark, sf_dir),
    }


def unified(spark, sf_dir):
    """Scored and united feeds; processing times spread over thirty days."""
    out = unify_all(
        lexicon(spark, sf_dir),
        run_ts="2024-01-01 00:00:00",
        keep=["seq"],
        news_order=["seq"],
        **feeds(spark, sf_dir),
    )
    seq = F.col("seq")
    day = F.timestamp_add("DAY", seq % 30, ntz("2024-01-01 00:00:00"))
    return out.withColumn("processed_at", F.timestamp_add("MINUTE", seq % 1440, day))


def assignment(spark, sf_dir):
    """Surrogate topic of each post and headline; messages get none of their own."""
    texts = (
        posts(spark, sf_dir)
        .select(F.col("title").alias("text"), F.lit(0).alias("feed"), "seq")
        .unionByName(
            headlines(spark, sf_dir).select(
                F.col("title").alias("text"), F.lit(1).alias("feed"), "seq"
            )
        )
    )
    return texts.select(
        "text",
        "feed",
        "seq",
        (F.col("seq") % 5).cast("int").alias("topic_id"),
        ((F.col("seq") % 50 + 50).cast("double") / 100).alias("topic_confidence"),
    ).join(topics(spark, sf_dir).select("topic_id", "topic_keywords"), "topic_id")


def results(spark, sf_dir):
    return topic_enrich(unified(spark, sf_dir), assignment(spark, sf_dir), ["feed", "seq"])


def sums(spark, sf_dir):
    """Results summed up for the panels; read once per session and data."""
    return _once(spark, "sums", sf_dir, lambda: stage(panel_sums(results(spark, sf_dir)), "sums"))


def model(spark, sf_dir) -> TopicModel:
    """The fitted model over whole documents; fitted once per session and data."""
    return _once(
        spark,
        "model",
        sf_dir,
        lambda: fit_topics(documents(spark, sf_dir), TOPICS),
    )


# Stand-ins that put words of the rules into the invented prose.
CUES = [
    (" of ", " not "),
    (" is ", " very "),
    (" to ", " but "),
    (" it ", " never "),
    (" in ", " so "),
    (" and ", " kind of "),
    (" that ", " least "),
    (" for ", " yeah right "),
    (" with ", " REALLY "),
    (" be ", " isn't "),
    (" are ", " at "),
    (" was ", " sort of "),
    (" as ", " barely "),
    (" by ", " cut the mustard "),
    ("st. ", "st?? "),
    ("e. ", "e! "),
]


def cued_documents(spark, sf_dir):
    text = F.col("text")
    for old, new in CUES:
        text = F.replace(text, F.lit(old), F.lit(new))
    return documents(spark, sf_dir).select("doc_id", text.alias("text"))
