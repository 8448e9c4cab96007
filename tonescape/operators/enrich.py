"""Topic columns of the unified table, looked up by text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape import schemas
from tonescape.functions.scalar import joined
from tonescape.operators.lookup import lookup_join, unique_last


def topic_columns(keywords: str = "topic_keywords") -> dict:
    """Defaults for rows without a topic, and the first five keywords as one string."""
    found = F.col("topic_id").isNotNull()
    return {
        "topic_keywords": F.when(found, joined(F.col(keywords), 5)).otherwise(
            schemas.NO_TOPIC_KEYWORDS
        ),
        "topic_confidence": F.coalesce("topic_confidence", F.lit(schemas.NO_TOPIC_CONFIDENCE)),
        "topic_id": F.coalesce("topic_id", F.lit(schemas.NO_TOPIC_ID)),
    }


def topic_enrich(
    unified: DataFrame,
    assignment: DataFrame,
    order: Sequence[str] = ("topic_confidence", "topic_id"),
    spread: Sequence[str] = ("source", "source_id"),
) -> DataFrame:
    """Left join on the text; of several assignments of a text the last one counts.

    Rows meet by a digest of 128 bits, which is what is hashed, sorted and compared, however
    long the texts are; the texts themselves are compared once rows have met. The pipeline
    itself does not need this join: a model assigns topics row by row.
    """
    columns = ["text", "topic_id", "topic_confidence", "topic_keywords"]
    extra = [c for c in order if c not in columns]
    digest = F.unhex(F.substring(F.sha2("text", 256), 1, 32))
    keyed = assignment.select(*columns, *extra, digest.alias("_digest"))
    unique = unique_last(keyed, ["_digest"], [F.col(c) for c in order]).drop(*extra)
    unique = unique.filter(F.col("_digest").isNotNull()).withColumnRenamed("text", "_text")
    met = lookup_join(unified.withColumn("_digest", digest), unique, "_digest", spread)
    same = F.col("_text") == F.col("text")
    topics = {c: F.when(same, F.col(c)) for c in columns[1:]}
    return met.withColumns(topics).drop("_digest", "_text").withColumns(topic_columns())
