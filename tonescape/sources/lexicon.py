"""Lexicon files: tab-separated, token and mean valence first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tonescape import schemas


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``(token, valence)``; further columns are ignored, quotes belong to the token."""
    lines = spark.read.csv(
        path,
        sep="\t",
        schema=f"{schemas.LEXICON}, spread string, ratings string",
        quote="",
        escape="",
        ignoreLeadingWhiteSpace=False,
    )
    return lines.select("token", "valence").filter("token is not null and valence is not null")
