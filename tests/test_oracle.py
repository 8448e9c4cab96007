"""Every registered query against its SQL twin; the others against invariants."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["source", "avg_compound"]
    assert {r.source for r in frame.collect()} == {"reddit", "twitter", "news"}


def test_lda_invariants(spark):
    keywords = QUERIES["topic_keywords"](spark, SF_DIR).collect()
    assert {r.topic_id for r in keywords} == set(range(5))
    assert max(r.place for r in keywords) == 9
    vocab = {r.term for r in QUERIES["tokenize_counts"](spark, SF_DIR).collect()}
    assert {r.keyword for r in keywords} <= vocab
    weights = QUERIES["lda_topics"](spark, SF_DIR).collect()
    assert all(0 < r.weight <= 1 for r in weights)
    assigned = QUERIES["topic_assign"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert len(assigned) == docs.count()
    assert all(0 <= r.topic_id < 5 and 0 < r.topic_confidence <= 1 for r in assigned)
    dimension = QUERIES["topics_dimension"](spark, SF_DIR).collect()
    assert all(r.topic_name.startswith(f"Topic {r.topic_id}: ") for r in dimension)
