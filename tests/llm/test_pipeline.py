"""The pipeline on a small table against the stages' plain versions."""

import corpus_pipeline
from tests.llm import brute
from tonescape.llm import toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    left = sorted(r["doc_id"] for r in scored if r["predicted"] == 0)
    classes = brute.jaccard_classes([(d, texts[d]) for d in left])
    left = [d for d in left if classes[d][0] == d]
    left = [d for d in left if not any(i in texts[d] for i in items)]
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in got if r["piece"] == 0) == left


def test_every_stage_but_the_last_keeps_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
