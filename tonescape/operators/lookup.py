"""Left lookup joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key are cut into parts of at most this share of all rows,
PARTS = 10_000
#: but not into parts of fewer rows than this.
PART_ROWS = 100_000


def unique_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the last in ``order``, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_row")).select(*keys, "_row.*")


def hot_keys(df: DataFrame, key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Hashes of keys with more rows than one part, and the number of parts they need.

    A part has at least 1/PARTS of all rows, so there are fewer than PARTS hot keys, and
    fewer than 2 * PARTS parts of them, however large the table is.
    """
    hashes = df.select(F.xxhash64(key).alias("_key"))
    total = hashes.agg(F.count(F.lit(1)).alias("n")).scalar()
    part = F.greatest(total / PARTS, F.lit(float(part_rows)))
    return (
        hashes.groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > part)
        .select("_key", F.ceil(F.col("_n") / part).cast("int").alias("_parts"))
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: Sequence[str],
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``left`` joined with ``right`` (unique by ``key``), unmatched rows kept.

    Rows of a hot key are spread over parts by a salt, and its one row of ``right`` is
    repeated for each part; rows without a key are spread as well. Nothing else is
    repeated, and the only side broadcast by hand is the list of hot keys, whose size is
    bounded. ``spread`` names left columns that vary within a key.
    """
    hot = F.broadcast(hot_keys(left, key, part_rows))
    mixed = F.xxhash64(*spread, F.spark_partition_id())
    parts = F.when(F.col(key).isNull(), F.lit(PARTS)).otherwise(F.coalesce("_parts", F.lit(1)))
    salted_left = (
        left.withColumn("_key", F.xxhash64(key))
        .join(hot, "_key", "left")
        .withColumn("_salt", F.pmod(mixed, parts).cast("int"))
        .drop("_key", "_parts")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    salted_right = (
        right.withColumn("_key", F.xxhash64(key))
        .join(hot, "_key", "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_key", "_parts")
    )
    return salted_left.join(salted_right, [key, "_salt"], "left").drop("_salt")
