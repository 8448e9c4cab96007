"""Report operators on the result table: filters, counts, means, rankings.

All aggregates combine per task before their one shuffle, whose size depends on the
number of groups, not of rows. Means are integer sums, so they repeat exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescape.functions.scalar import exact_mean, joined, ntz
from tonescape.operators.ranking import keep_first, rank_in_group

COMPOUND = "sentiment_compound"
BINS = 20


def _rows() -> Column:
    return F.count(F.lit(1))


def in_days(results: DataFrame, start, end, column: str = "processed_at") -> DataFrame:
    """From the start of one day to one second before the end of another, both kept."""
    last = ntz(end).cast("date").cast("timestamp_ntz") + F.expr("interval '86399' second")
    first = ntz(start).cast("date").cast("timestamp_ntz")
    return results.filter((F.col(column) >= first) & (F.col(column) <= last))


def date_bounds(results: DataFrame, column: str = "processed_at") -> DataFrame:
    return results.agg(
        F.to_date(F.min(column)).alias("min_date"), F.to_date(F.max(column)).alias("max_date")
    )


def last_week(results: DataFrame, column: str = "processed_at") -> DataFrame:
    """The default range: seven days up to the last day, but not before the first."""
    bounds = date_bounds(results, column)
    start = bounds.select(F.greatest("min_date", F.date_sub("max_date", 7))).scalar()
    end = bounds.select("max_date").scalar()
    last = end.cast("timestamp_ntz") + F.expr("interval '86399' second")
    return results.filter(
        (F.col(column) >= start.cast("timestamp_ntz")) & (F.col(column) <= last)
    )


def with_topics(results: DataFrame, selected: Sequence[int]) -> DataFrame:
    """Rows of the selected topics; an empty selection means all."""
    return results.filter(F.col("topic_id").isin(list(selected))) if selected else results


def topic_options(results: DataFrame) -> DataFrame:
    return results.select("topic_id").distinct().orderBy("topic_id")


def from_source(results: DataFrame, source: str) -> DataFrame:
    return results.filter(F.col("source") == source)


def any_nonzero(results: DataFrame) -> DataFrame:
    return results.agg(
        F.coalesce(F.bool_or(F.col(COMPOUND) != 0), F.lit(False)).alias("has_sentiment")
    )


def collection_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        table.agg(_rows().alias("n")).select(F.lit(name).alias("collection"), "n")
        for name, table in tables.items()
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


def overview(results: DataFrame) -> DataFrame:
    """Rows, sources and topics; null counts as a value of its own."""

    def values(column: str) -> Column:
        has_null = F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
        return F.countDistinct(column) + has_null

    return results.agg(
        _rows().alias("datapoints"),
        values("source").alias("sources"),
        values("topic_id").alias("topics"),
    )


def mean_by(results: DataFrame, key: str) -> DataFrame:
    """Mean compound per key, in key order; rows without a key are left out."""
    return (
        results.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(exact_mean(F.col(COMPOUND)).alias("avg_compound"))
        .orderBy(key)
    )


def group_mean_count(results: DataFrame) -> DataFrame:
    """Mean and count per source; rows without a source are a group of their own."""
    return results.groupBy("source").agg(
        exact_mean(F.col(COMPOUND)).alias("average_sentiment"), _rows().alias("n")
    )


def topics_by_source(results: DataFrame) -> DataFrame:
    return (
        results.filter(F.col("source").isNotNull() & F.col("topic_id").isNotNull())
        .groupBy("source", "topic_id")
        .agg(_rows().alias("n"))
    )


def rank_topics(by_source: DataFrame) -> DataFrame:
    return rank_in_group(by_source, ["source"], [F.col("n").desc(), F.col("topic_id")])


def first_topic_rows(topics: DataFrame, order: Sequence[str] = ("created_at",)) -> DataFrame:
    return keep_first(topics, ["topic_id"], [F.col(c) for c in order])


def topics_by_source_keywords(
    by_source: DataFrame, topics: DataFrame, order: Sequence[str] = ("created_at",)
) -> DataFrame:
    """Ranked topics per source with their keywords; null where there are none."""
    dimension = first_topic_rows(topics, order).select(
        "topic_id",
        F.when(F.size("topic_keywords") > 0, joined(F.col("topic_keywords"), 5, ", ")).alias(
            "keywords"
        ),
    )
    return rank_topics(by_source).join(dimension, "topic_id", "left")


def mean_components(results: DataFrame) -> DataFrame:
    return results.agg(
        *[
            exact_mean(F.col(f"sentiment_{name}")).alias(f"mean_{name}")
            for name in ("positive", "neutral", "negative")
        ],
        _rows().alias("n"),
    )


def bin_of(value: Column) -> Column:
    """One of twenty bins of width 0.1 from -1 on; 1.0 falls into the last, null into none."""
    steps = F.floor(value * 10_000 + 0.5).cast("long") + 10_000
    place = F.least(F.floor(steps / (2 * 10_000 // BINS)), F.lit(BINS - 1)).cast("int")
    return F.when(value.isNotNull(), place)


def histogram(results: DataFrame) -> DataFrame:
    """Counts per source and bin."""
    return (
        results.filter(F.col(COMPOUND).isNotNull())
        .groupBy("source", bin_of(F.col(COMPOUND)).alias("bin"))
        .agg(_rows().alias("n"))
    )


def id_counts(results: DataFrame, source: str = "news") -> DataFrame:
    return (
        from_source(results, source)
        .groupBy("source_id")
        .agg(_rows().alias("n"))
        .orderBy(F.col("n").desc(), "source_id")
    )


def crosstab(results: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Texts per topic and source, zero where there are none."""
    return (
        results.groupBy("topic_id").pivot("source", list(sources)).agg(_rows()).na.fill(0)
    )


def dominant_topic(results: DataFrame) -> DataFrame:
    """The most frequent topic per source; the lowest id on ties."""
    return (
        topics_by_source(results)
        .groupBy("source")
        .agg(F.max_by("topic_id", F.struct("n", -F.col("topic_id"))).alias("topic_id"))
    )


def distinct_values(table: DataFrame, column: str) -> DataFrame:
    return table.select(column).distinct()


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    def counts(table: DataFrame, stage: str) -> DataFrame:
        return table.agg(
            _rows().alias("records"), F.count_if(F.col("source") == "news").alias("news_records")
        ).select(F.lit(stage).alias("stage"), "records", "news_records")

    return counts(before, "before").unionByName(counts(after, "after"))


def head(table: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return table.orderBy(*order).limit(n)
