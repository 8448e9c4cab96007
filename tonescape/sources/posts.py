"""Posts: landed dumps, listing orders, limit per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescape import schemas
from tonescape.functions.scalar import from_epoch, to_epoch
from tonescape.operators.ranking import first_per_group

# Fixed values of the published "hot" order.
_HOT_START = 1134028003
_HOT_SCALE = 45000

SORTS = ("hot", "new", "top", "controversial")


def scan_posts(raw: DataFrame) -> DataFrame:
    """Raw fields to the posts table. Counts that are not numbers become null."""
    return raw.select(
        F.col("id").cast("string").alias("id"),
        F.col("title").cast("string").alias("title"),
        F.col("selftext").cast("string").alias("text"),
        from_epoch(F.col("created_utc")).alias("created_utc"),
        F.col("score").try_cast("int").alias("score"),
        F.col("num_comments").try_cast("int").alias("num_comments"),
        F.col("url").cast("string").alias("url"),
        F.col("author").cast("string").alias("author"),
        F.col("subreddit").cast("string").alias("subreddit"),
        F.lit("reddit").alias("source"),
    )


def read_posts(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return scan_posts(spark.read.schema(schemas.RAW_POSTS).format(fmt).load(path))


def hot_rank(score: Column, created: Column) -> Column:
    """Published order: logarithm of the score plus age, seven decimals."""
    magnitude = F.log10(F.greatest(F.abs(score), F.lit(1)))
    return F.round(
        F.signum(score) * magnitude + (to_epoch(created) - _HOT_START) / _HOT_SCALE, 7
    )


def controversy(ups: Column, downs: Column) -> Column:
    """Published order: many votes, evenly split."""
    balance = F.least(ups, downs) / F.greatest(ups, downs)
    value = F.pow((ups + downs).cast("double"), balance)
    return F.when((ups <= 0) | (downs <= 0), F.lit(0.0)).otherwise(value)


def _sort_key(posts: DataFrame, sort: str) -> Column:
    if sort == "hot":
        return hot_rank(F.col("score"), F.col("created_utc"))
    if sort == "new":
        return F.col("created_utc")
    if sort == "top":
        return F.col("score")
    if sort == "controversial":
        if not {"ups", "downs"} <= set(posts.columns):
            raise ValueError("the controversial order needs the columns ups and downs")
        return controversy(F.col("ups"), F.col("downs"))
    raise ValueError(f"unknown sort {sort!r}; use one of {', '.join(SORTS)}")


def list_posts(
    posts: DataFrame, limit: int = 100, sort: str = "hot", groups: Sequence[str] | None = None
) -> DataFrame:
    """The first ``limit`` posts of every group, of the named groups when given."""
    key = _sort_key(posts, sort)
    if groups is not None:
        posts = posts.filter(F.col("subreddit").isin(list(groups)))
    return first_per_group(posts, ["subreddit"], [key.desc(), F.col("id")], limit)
