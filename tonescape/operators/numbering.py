"""Running numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonescape.session import stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row in the low 33 bits


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number rows from 1 in ``order`` without sorting them in one task.

    Rows are range-partitioned and sorted, and their places are stored before anything
    is derived from them. What is left is one offset per partition. ``order`` should be
    unique: rows that tie cannot be split over partitions. The ranges are found by a pass
    over stored rows, so ``df`` is worked out once.
    """
    placed = (
        stage(df, "unnumbered")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    rows = stage(placed, "numbered").withColumn("_block", F.shiftright("_place", _ROW_BITS))
    # One row per partition, so the window and the broadcast stay small at any scale.
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    number = F.col("_offset") + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return (
        rows.join(F.broadcast(offsets), "_block")
        .withColumn(name, number)
        .drop("_block", "_place", "_offset")
    )
