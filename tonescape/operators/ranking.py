"""First rows per group, written so that one large group does not end in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts a group is cut into before its final ranking.
PARTS = 64

#: Spark's own bound (``spark.sql.optimizer.windowGroupLimitThreshold``) for the early cut.
CUT_LIMIT = 1000


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, parts: int = PARTS
) -> DataFrame:
    """The first ``limit`` rows of every group.

    Rows are ranked inside (group, part) first, where the part is the input partition, so
    even a group with a third of all rows is spread evenly; the final ranking then sees at
    most ``parts * limit`` rows per group. Up to ``CUT_LIMIT`` Spark cuts each round to
    ``limit`` rows before its shuffle, so input partitions may share ``parts`` parts;
    beyond, every input partition is a part of its own in a round before that.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    part, rank = "_part", "_rank"
    own = df.withColumn(part, F.spark_partition_id())
    rounds = [[*keys, part], [*keys, F.pmod(part, F.lit(parts))], [*keys]]
    for group in rounds if limit > CUT_LIMIT else rounds[1:]:
        window = Window.partitionBy(*group).orderBy(*order)
        own = own.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= limit)
    return own.drop(part, rank)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; nulls are equal to each other.

    Keys are mostly distinct, so one round is right: every map task sends at most one
    row of a repeated key.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def rank_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Adds ``rank``; for aggregated rows, whose groups are small."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
