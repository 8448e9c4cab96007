"""Results summed up once for all panels: counts and whole sums per run, day, source, topic, bin.

The sums are whole numbers, so that merging them gives the same means as the rows do, to the
last digit. Their number depends on groups, not on rows. A panel merges what it needs; none
reads the results again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescape.functions.scalar import ntz
from tonescape.operators import report

UNIT = 1_000_000
COMPONENTS = ("compound", "positive", "neutral", "negative")
KEYS = ("run_id", "day", "late", "source", "topic_id", "bin")
#: Columns of the sums. ``late`` marks the rest of a day's last second, which a range of days
#: that ends there leaves out; ``bin`` is null where a row has no compound value.
SUMS = (
    "run_id string, day date, late boolean, source string, topic_id int, bin int, n bigint, nonzero bigint, "
    + ", ".join(f"{c}_n bigint, {c}_sum bigint" for c in COMPONENTS)
    + ", first_time timestamp_ntz, last_time timestamp_ntz"
)


def panel_sums(results: DataFrame) -> DataFrame:
    """One row per group of ``KEYS``; a null in a key is a value of its own.

    Results without a ``run_id`` column belong to the null run. Rows combine per task before
    the one shuffle, which carries groups only.
    """
    if "run_id" not in results.columns:
        results = results.withColumn("run_id", F.lit(None).cast("string"))
    day = F.to_date("processed_at")
    end = day.cast("timestamp_ntz") + F.expr("interval '86399' second")
    sums: list[Column] = []
    for name in COMPONENTS:
        value = F.col(f"sentiment_{name}")
        sums += [F.count(value).alias(f"{name}_n"), F.sum(F.floor(value * UNIT + 0.5).cast("long")).alias(f"{name}_sum")]
    return results.groupBy(
        "run_id",
        day.alias("day"),
        (F.col("processed_at") > end).alias("late"),
        "source",
        "topic_id",
        report.bin_of(F.col(report.COMPOUND)).alias("bin"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(report.COMPOUND) != 0).alias("nonzero"),
        *sums,
        F.min("processed_at").alias("first_time"),
        F.max("processed_at").alias("last_time"),
    )


def _mean(name: str) -> Column:
    return F.sum(f"{name}_sum").cast("double") / F.lit(float(UNIT)) / F.sum(f"{name}_n")


def in_days(sums: DataFrame, start, end) -> DataFrame:
    """``report.in_days`` on sums: both days, the second one up to 23:59:59."""
    first, last = (ntz(day).cast("date") for day in (start, end))
    return sums.filter((F.col("day") >= first) & ((F.col("day") < last) | (F.col("day") == last) & ~F.col("late")))


def last_week(sums: DataFrame) -> DataFrame:
    """``report.last_week`` on sums; only sums are read for its bounds."""
    bounds = sums.agg(F.min("day").alias("low"), F.max("day").alias("high"))
    start = bounds.select(F.greatest("low", F.date_sub("high", 7))).scalar()
    end = bounds.select("high").scalar()
    return sums.filter((F.col("day") >= start) & ((F.col("day") < end) | ~F.col("late")))


def overview(sums: DataFrame) -> DataFrame:
    """Rows, sources and topics; null counts as a value of its own."""
    # Distinct groups are few; the rows they stand for are added up beside them.
    counted = report.overview(sums).select("sources", "topics")
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("datapoints")).scalar()
    return counted.select(total.alias("datapoints"), "sources", "topics")


def any_nonzero(sums: DataFrame) -> DataFrame:
    return sums.agg((F.coalesce(F.sum("nonzero"), F.lit(0)) > 0).alias("has_sentiment"))


def mean_by(sums: DataFrame, key: str) -> DataFrame:
    """Mean compound per key, in key order; rows without a key are left out."""
    return sums.filter(F.col(key).isNotNull()).groupBy(key).agg(_mean("compound").alias("avg_compound")).orderBy(key)


def group_mean_count(sums: DataFrame) -> DataFrame:
    return sums.groupBy("source").agg(_mean("compound").alias("average_sentiment"), F.sum("n").alias("n"))


def mean_components(sums: DataFrame) -> DataFrame:
    means = [_mean(name).alias(f"mean_{name}") for name in COMPONENTS[1:]]
    return sums.agg(*means, F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def histogram(sums: DataFrame) -> DataFrame:
    return sums.filter(F.col("bin").isNotNull()).groupBy("source", "bin").agg(F.sum("n").alias("n"))


def topics_by_source(sums: DataFrame) -> DataFrame:
    known = sums.filter(F.col("source").isNotNull() & F.col("topic_id").isNotNull())
    return known.groupBy("source", "topic_id").agg(F.sum("n").alias("n"))
