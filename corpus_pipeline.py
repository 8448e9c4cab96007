"""A corpus made ready for training: filtered, deduplicated, decontaminated, redacted, packed.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns rows;
its result is written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tonescape.llm import chosen_path, pattern_packing, qgram_match, secret_scan, toxicity
from tonescape.session import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network rejects go; it learns from the labelled ones."""
    network = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, network)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar documents stays, the one with the smallest id."""
    return chosen_path.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return qgram_match.without_benchmark(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that look live are replaced; every document stays."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their training sequence and place in it."""
    import public_tokenizers

    return pattern_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near-copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: SQL cannot state a trained score or the packing; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder before the next."""
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{root}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
