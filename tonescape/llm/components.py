"""Connected components of links between long ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.llm.storage import Stored


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _smallest(both).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    low = _smallest(links)
    others = links.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.unionByName(low.select("a", F.col("low").alias("b")))


def components(links: DataFrame, label: str) -> Stored:
    """a, b for every id that is linked: b is the smallest id of a's component, a <> b.

    ``links`` has a > b. Rounds grow with the logarithm of the longest path; each is stored,
    and none gathers a node's neighbours in one row.
    """

    def summary(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = Stored(links.select("a", "b").distinct(), label)
    before = summary(current.frame)
    while True:
        larger = _large_star(current.frame).distinct()
        following = Stored(_small_star(larger).distinct(), label)
        current.drop()
        current, after = following, summary(following.frame)
        if after == before:
            return current
        before = after
