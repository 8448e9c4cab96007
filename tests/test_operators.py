"""Ties, nulls, duplicates and skew on hand-made rows."""

import collections
import datetime as dt
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from fixtures import views
from tonescape.functions import scalar, term_batch
from tonescape.functions.sentiment import Lexicon
from tonescape.functions.text import TERM, terms
from tonescape.operators import enrich, fold_in, frequent, graph, panels, report, topics, unify
from tonescape.operators.lookup import hot_keys, lookup_join
from tonescape.operators.numbering import number_rows
from tonescape.operators.ranking import first_per_group
from tonescape.plans import dashboard

LEXICON = Lexicon({"great": 3.1, "terrible": -2.1, "love": 3.2, "record": 1.0})
NOW = dt.datetime(2024, 1, 1)


def tuples(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_number_rows_has_no_gaps(spark):
    frame = spark.range(10_000).select(((F.col("id") * 7919) % 10_007).alias("k"))
    numbered = number_rows(frame, [F.col("k")], "n").orderBy("k").collect()
    assert [r.n for r in numbered] == list(range(1, 10_001))
    assert number_rows(frame.limit(0), [F.col("k")], "n").count() == 0


def test_first_per_group_with_a_hot_group(spark):
    frame = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50))
        .alias("g"),
        "id",
    )
    got = first_per_group(frame, ["g"], [F.col("id").desc()], 7).collect()
    hot = sorted((r.id for r in got if r.g == "hot"), reverse=True)
    assert hot == [i for i in range(29_999, 0, -1) if i % 3 < 2][:7]
    assert len(got) == 7 * len({r.g for r in got})


def test_lookup_join_keeps_every_row(spark):
    left = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot")
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        "id",
    )
    right = spark.createDataFrame([("hot", 1), ("k2", 2), ("zz", 3)], "key string, v int")
    assert [r._parts for r in hot_keys(left.filter("key is not null"), "key", 500).collect()] == [6]
    assert hot_keys(left, "key").count() == 0
    out = lookup_join(left, right, "key", ["id"], part_rows=500)
    assert out.count() == 9_000
    assert out.filter("v = 1").count() == 3_000
    assert tuples(out.filter("v = 2").select("id")) == [(2,)]
    assert out.filter("v is null").count() == 5_999


def test_enrich_defaults_and_last_assignment(spark):
    unified = spark.createDataFrame(
        [("reddit", "1", "x"), ("news", "2", "y"), ("news", "3", "x"), ("news", "4", None)],
        "source string, source_id string, text string",
    )
    assigned = spark.createDataFrame(
        [
            Row(text="x", topic_id=1, topic_confidence=0.5, topic_keywords=["a"], n=1),
            Row(text="x", topic_id=2, topic_confidence=0.4, topic_keywords=list("abcdefg"), n=2),
        ]
    )
    out = enrich.topic_enrich(unified, assigned, ["n"])
    assert tuples(out.select("source_id", "topic_id", "topic_confidence", "topic_keywords")) == [
        ("1", 2, 0.4, "a,b,c,d,e"), ("2", -1, 0.0, "Unknown"),
        ("3", 2, 0.4, "a,b,c,d,e"), ("4", -1, 0.0, "Unknown"),
    ]


def feeds(spark):
    posts = spark.createDataFrame(
        [("1", "Great news about the economy", "", "Fine"), ("2", "Terrible weather", None, None)],
        "id string, title string, url string, text string",
    ).withColumn("created_utc", F.lit(NOW).cast("timestamp_ntz"))
    tweets = spark.createDataFrame([(789, "I love it!"), (101, "ok")], "id bigint, text string")
    tweets = tweets.withColumn("created_at", F.lit(NOW).cast("timestamp_ntz"))
    headlines = spark.createDataFrame(
        [("Record high", "u1", "a"), ("Concerns", "u2", "b")],
        "title string, url string, category string",
    ).withColumns(
        {"source": F.lit("bbc"), "extracted_at": F.lit(NOW).cast("timestamp_ntz")}
    )
    return {"posts": posts, "tweets": tweets, "headlines": headlines}


def test_unify(spark):
    out = unify.unify_all(LEXICON, run_ts=NOW, **feeds(spark))
    rows = {(r.source, r.source_id): r for r in out.collect()}
    assert set(rows) == {
        ("reddit", "Great news about the economy"), ("reddit", "Terrible weather"),
        ("twitter", "789"), ("twitter", "101"), ("news", "news_1"), ("news", "news_2"),
    }
    assert rows["news", "news_1"].text == "Record high"
    assert rows["reddit", "Terrible weather"].sentiment_compound < 0
    assert all(r.processed_at == NOW for r in rows.values())
    only = unify.unify_all(LEXICON, tweets=feeds(spark)["tweets"])
    assert only.count() == 2
    by_url = unify.unify_all(LEXICON, headlines=feeds(spark)["headlines"], news_id="url")
    assert {len(r.source_id) for r in by_url.collect()} == {64}
    with pytest.raises(ValueError):
        unify.unify_all(LEXICON)


def test_dedup_is_null_safe(spark):
    frame = spark.createDataFrame(
        [(None, "u", 2), (None, "u", 1), ("t", None, 4), ("t", None, 3), ("t", "u", 5)],
        "title string, url string, n int",
    )
    assert tuples(unify.dedup_headlines(frame, ["n"])) == [
        ("t", "u", 5), ("t", None, 3), (None, "u", 1),
    ]


def results(spark, rows):
    return spark.createDataFrame(
        rows, "source string, topic_id int, sentiment_compound double, processed_at timestamp_ntz"
    )


def test_report_nulls_and_ties(spark):
    table = results(
        spark,
        [
            ("a", 0, 0.5, NOW), ("a", 1, -0.5, NOW), ("a", 1, None, NOW), ("a", 0, 0.0, NOW),
            (None, 0, 1.0, NOW), ("b", None, 0.1, NOW),
        ],
    )
    assert tuples(report.mean_by(table, "source")) == [("a", 0.0), ("b", 0.1)]
    assert tuples(report.group_mean_count(table)) == [("a", 0.0, 4), ("b", 0.1, 1), (None, 1.0, 1)]
    assert tuples(report.overview(table)) == [(6, 3, 3)]
    assert tuples(report.dominant_topic(table)) == [("a", 0)]
    ranked = report.rank_topics(report.topics_by_source(table))
    assert tuples(ranked.select("topic_id", "rank")) == [(0, 1), (1, 2)]
    assert tuples(report.overview(table.limit(0))) == [(0, 0, 0)]
    assert tuples(report.any_nonzero(table.limit(0))) == [(False,)]
    wide = report.crosstab(table, ["a", "b"]).filter("topic_id = 1")
    assert tuples(wide) == [(1, 2, 0)]


def test_histogram_edges(spark):
    values = [-1.0, -0.9, 0.0, 0.3, 0.2999, 1.0, None]
    table = results(spark, [("a", 0, v, NOW) for v in values])
    assert tuples(report.histogram(table).select("bin", "n")) == [
        (0, 1), (1, 1), (10, 1), (12, 1), (13, 1), (19, 1),
    ]


def test_date_filters(spark):
    day = dt.datetime
    times = [
        day(2024, 1, 1), day(2024, 1, 4, 23, 59, 59), day(2024, 1, 4, 23, 59, 59, 500000),
        day(2024, 1, 5), day(2024, 1, 20),
    ]
    table = results(spark, [("a", 0, 0.0, t) for t in times])
    kept = report.in_days(table, "2024-01-01", "2024-01-04").select("processed_at")
    assert [r.processed_at for r in kept.collect()] == times[:2]
    assert report.last_week(table).count() == 1
    assert report.last_week(table.filter("processed_at < '2024-01-06'")).count() == 5 - 1
    assert report.with_topics(table, []).count() == 5
    assert report.with_topics(table, [1]).count() == 0


def test_topic_names_and_terms(spark):
    table = spark.createDataFrame(
        [(0, []), (1, ["a"]), (2, ["a", "b"]), (3, [f"k{i}" for i in range(12)])],
        "topic_id int, topic_keywords array<string>",
    )
    assert tuples(topics.topic_names(table)) == [
        (0, "Topic 0"), (1, "Topic 1"), (2, "Topic 2: a - b"), (3, "Topic 3: k0 - k1"),
    ]
    terms = graph.topic_terms(table)
    assert terms.filter("topic_id = 3").agg(F.min("score"), F.max("score")).first() == (1, 10)
    strong = graph.strong_terms(terms)
    means = spark.createDataFrame([(2, 0.5)], "topic_id int, avg_compound double")
    nodes = tuples(graph.graph_nodes(strong, means).filter("type = 'topic'").drop("type"))
    assert nodes == [("Topic 1", 0.0), ("Topic 2", 0.5), ("Topic 3", 0.0)]
    assert graph.graph_edges(strong.unionByName(strong)).count() == strong.count()
    assert graph.topic_terms(table.limit(0)).count() == 0


def test_first_topic_row_counts(spark):
    table = spark.createDataFrame(
        [(0, ["new"], 2), (0, ["old"], 1), (1, [], 1)],
        "topic_id int, topic_keywords array<string>, created_at int",
    )
    counts = spark.createDataFrame(
        [("a", 0, 5), ("a", 1, 4), ("a", 2, 3)], "source string, topic_id int, n bigint"
    )
    out = report.topics_by_source_keywords(counts, table).select("topic_id", "keywords")
    assert tuples(out) == [(0, "old"), (1, None), (2, None)]


def test_argmax_takes_the_first(spark):
    frame = spark.createDataFrame([([0.2, 0.4, 0.4],), ([1.0],)], "v array<double>")
    assert [r.a for r in frame.select(scalar.argmax(F.col("v")).alias("a")).collect()] == [1, 0]


def test_fit_guard_and_assignment(spark):
    texts = [f"apple banana cherry {i}" for i in range(6)] + [f"dog cat bird {i}" for i in range(5)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    options = topics.TopicOptions(n_topics=2)
    assert topics.fit_topics(docs.limit(10), options) is None
    model = topics.fit_topics(docs, options)
    assert len(model.keywords) == 2 and all(0 < len(k) <= 10 for k in model.keywords)
    probe = docs.unionByName(docs).unionByName(
        spark.createDataFrame([("zzz",), ("",), (None,)], "text string")
    )
    rows = model.assign(probe).collect()
    assert len(rows) == 25
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text, set()).add((r.topic_id, r.topic_confidence))
    assert all(len(found) == 1 for found in by_text.values())
    for text in ("zzz", "", None):
        assert by_text[text] == {(0, 0.5)}
    again = topics.fit_topics(docs, options)
    assert again.keywords == model.keywords
    plan = model.assign(probe)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_fit_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    options = topics.TopicOptions(max_features=200, passes=3)
    models = [topics.fit_topics(d, options) for d in (docs.coalesce(1), docs.repartition(13), docs.orderBy("text"))]
    for model in models[1:]:
        assert (model.matrix.counts == models[0].matrix.counts).all()
    assigned = [{r.doc_id: r.s for r in fold_in.term_vectors(d, models[0].vocab).select(
        "doc_id", fold_in.shares(models[0].matrix).alias("s")).collect()} for d in (docs.coalesce(1), docs.repartition(7))]
    assert assigned[0] == assigned[1]
    assert all(abs(sum(s) - 1) < 1e-9 and len(s) == 5 for s in assigned[0].values())


def test_held_out_perplexity_falls(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    learnt, held = (docs.filter(F.col("doc_id") % 5 == 0 if x else F.col("doc_id") % 5 != 0) for x in (0, 1))
    rows = frequent.vocabulary(frequent.token_counts(learnt), 500).collect()
    vocab = sorted(r.term for r in rows)
    learnt, held = (fold_in.term_vectors(d, vocab).select("_places", "_times").cache() for d in (learnt, held))
    priors, found = fold_in.Priors(), []
    for passes in (0, 1, 2, 4, 8):
        matrix = fold_in.fit(learnt, len(vocab), 5, passes, 30, priors)
        total, words = fold_in.log_likelihood(held, matrix)
        found.append(-total / words)
    assert found == sorted(found, reverse=True) and found[-1] < found[0] - 0.1


def test_fold_in_by_hand(spark):
    """Two topics, three terms: the parts of each round in plain arithmetic."""
    matrix = fold_in.TopicMatrix([[8_000_000, 1_000_000, 0], [0, 1_000_000, 5_000_000]], fold_in.Priors(rounds=2))
    weights = [[(c + 10_000) / (sum(row) + 30_000) for c in row] for row in matrix.counts.tolist()]
    counts = {0: 3, 1: 1}
    shares = [0.5, 0.5]
    for _ in range(2):
        sums = [0, 0]
        for term, n in counts.items():
            likely = [shares[k] * weights[k][term] for k in (0, 1)]
            for k in (0, 1):
                sums[k] += math.floor(n * 1e6 * (likely[k] / (likely[0] + likely[1])) + 0.5)
        shares = [(x + 100_000) / (sum(sums) + 200_000) for x in sums]
    docs = spark.createDataFrame([("a a b a",), (None,), ("",), ("zz",)], "text string")
    docs = docs.withColumn("text", F.replace("text", F.lit("a"), F.lit("aa"))).withColumn("text", F.replace("text", F.lit("b"), F.lit("bb")))
    got = fold_in.term_vectors(docs, ["aa", "bb", "cc"]).select(fold_in.shares(matrix).alias("s")).collect()
    assert [r.s for r in got] == [shares, [0.5, 0.5], [0.5, 0.5], [0.5, 0.5]]


def test_online_method(spark):
    texts = [f"apple banana cherry {i}" for i in range(30)] + [f"dog cat bird {i}" for i in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = topics.fit_topics(docs, topics.TopicOptions(n_topics=2, method="online"))
    assert len(model.keywords) == 2 and model.assign(docs).count() == 60
    with pytest.raises(ValueError):
        topics.fit_topics(docs, topics.TopicOptions(method="other"))


def test_topics_part_texts_that_share_no_word(spark):
    texts = [f"apple banana cherry {i}" for i in range(30)] + [f"dog cat bird {i}" for i in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = topics.fit_topics(docs, topics.TopicOptions(n_topics=2))
    found = {(r.text.split()[0], r.topic_id) for r in model.assign(docs).collect()}
    assert len(found) == 2 and len({topic for _, topic in found}) == 2


@pytest.mark.parametrize("share", [0.05, 0.2, 0.3, 1.0])
def test_all_passes_run(share):
    options = topics.TopicOptions(share=share)
    assert options.iterations * share >= options.passes > (options.iterations - 1) * share - 1e-6


def test_texts_meet_by_digest(spark):
    """No exchange or sort has a text of the looked-up side as its key."""
    left = spark.createDataFrame([("a", "1", "x" * 50), ("a", "2", None), ("a", "3", "y")], "source string, source_id string, text string")
    right = spark.createDataFrame(
        [("x" * 50, 1, 0.5, ["k"]), ("x" * 50, 2, 0.7, ["l"]), (None, 3, 0.9, ["m"])],
        "text string, topic_id int, topic_confidence double, topic_keywords array<string>",
    )
    with_conf = enrich.topic_enrich(left, right)
    assert sorted(tuple(r)[1:] for r in with_conf.select("source", "source_id", "topic_id", "topic_keywords").collect()) == [
        ("1", 2, "l"), ("2", -1, "Unknown"), ("3", -1, "Unknown"),
    ]
    plan = with_conf._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "hashpartitioning(" in line or " Sort [" in line]
    assert any("_digest" in line for line in keys)
    for line in keys:
        part = line.split("hashpartitioning(")[1].split(")")[0] if "hashpartitioning(" in line else line.split("Sort [")[1].split("]")[0]
        assert "text" not in part


def test_panels_equal_the_reports_on_rows(spark):
    """Nulls in every column, ties, the last second of a day, runs, and no rows."""
    day = dt.datetime
    times = [day(2024, 1, 1), day(2024, 1, 4, 23, 59, 59, 500000), day(2024, 1, 4, 23, 59, 59), day(2024, 1, 9), None]
    values = [0.5, -0.1, 0.0, None, 1.0, -1.0, 0.3333]
    rows = [
        ("r" if i % 2 else None, ("a", "b", None)[i % 3], (0, 1, None)[i // 3 % 3], values[i % 7], values[(i + 1) % 7],
         values[(i + 2) % 7], values[(i + 3) % 7], times[i % 5])
        for i in range(400)
    ]
    table = spark.createDataFrame(
        rows,
        "run_id string, source string, topic_id int, sentiment_compound double, sentiment_positive double, "
        "sentiment_neutral double, sentiment_negative double, processed_at timestamp_ntz",
    )
    for results_ in (table, table.repartition(5), table.drop("run_id"), table.filter("source = 'none'")):
        sums = panels.panel_sums(results_)
        if results_ is table:
            assert sums.columns == [part.split()[0] for part in panels.SUMS.split(", ")]
        for of_rows, of_sums in (
            (results_, sums),
            (report.in_days(results_, "2024-01-01", "2024-01-04"), panels.in_days(sums, "2024-01-01", "2024-01-04")),
            (report.in_days(results_, "2024-01-04", "2024-01-03"), panels.in_days(sums, "2024-01-04", "2024-01-03")),
            (report.last_week(results_), panels.last_week(sums)),
        ):
            for name in ("overview", "any_nonzero", "group_mean_count", "mean_components", "histogram", "topics_by_source"):
                expected, found = (getattr(module, name)(frame) for module, frame in ((report, of_rows), (panels, of_sums)))
                assert sorted(map(str, tuples(expected))) == sorted(map(str, tuples(found))), name
            for key in ("source", "topic_id"):
                assert tuples(report.mean_by(of_rows, key)) == tuples(panels.mean_by(of_sums, key))


def test_panels_read_results_once(spark):
    """No panel's plan scans the results: only their sums, and a shuffle of groups."""
    table = results(spark, [("a", 0, 0.5, NOW)]).withColumns(
        {f"sentiment_{c}": F.lit(0.5) for c in ("positive", "neutral", "negative")}
    )
    topic_rows = spark.createDataFrame([(0, ["x", "y"], NOW)], "topic_id int, topic_keywords array<string>, created_at timestamp_ntz")
    for name, panel in dashboard.reports(table, topic_rows).items():
        plan = panel._jdf.queryExecution().optimizedPlan().toString()
        assert "sentiment_compound" not in plan, name
        assert panel.count() > 0, name


def _plain_vocabulary(texts, size):
    counts = collections.Counter(w for t in texts if t for w in t.split())
    ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]
    return [(term, n, place + 1) for place, (term, n) in enumerate(ranked)]


def _ranked(frame):
    return sorted(tuples(frame), key=lambda r: r[2])


def test_frequent_terms_by_bounded_summaries(spark, monkeypatch):
    """Few frequent terms among many that stand once; ties at the end; nulls and empty texts."""
    random.seed(5)
    texts = [None, ""]
    for i in range(3000):
        common = [f"common{min(int(random.paretovariate(0.7)), 60)}" for _ in range(20)]
        texts.append(" ".join([*common, *(f"rare{i}_{j}" for j in range(15))]))
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    rows = frequent.summaries(docs, 200).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in rows) <= 201
    error = frequent.summaries(docs, 200).filter("term is null").agg(F.sum("n")).first()[0]
    assert 0 < error <= 3000 * 35 / 201
    assert frequent.candidates(docs, 10, 200).count() < 400
    monkeypatch.setattr(frequent, "token_counts", lambda *a: 1 / 0)  # not all terms are counted
    for size, capacity in ((1, 200), (10, 200), (10, 1000), (30, 2000), (100, None)):
        assert _ranked(frequent.frequent_terms(docs, size, capacity=capacity)) == _plain_vocabulary(texts, size)
    empty = docs.filter("text = 'none'")
    assert frequent.frequent_terms(empty, 5).count() == 0 == frequent.frequent_terms(docs.filter("text = ''"), 5).count()


def test_frequent_terms_counts_all_where_summaries_cannot_tell(spark):
    """Every term as frequent as any other: ties by term decide."""
    texts = [" ".join(f"t{(i * 37 + j) % 900:03}" for j in range(30)) for i in range(900)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    assert frequent.candidates(docs, 20, 10) is None and frequent.candidates(docs, 20, 80) is None
    assert _ranked(frequent.frequent_terms(docs, 20, capacity=10)) == _plain_vocabulary(texts, 20)


def test_numbering_works_its_input_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 1000, 1, 4).mapInArrow(count, "id long")
    got = number_rows(rows, [F.col("id")], "number").collect()
    assert sorted((r.id, r.number) for r in got) == [(i, i + 1) for i in range(1000)]
    assert seen.value == 1000


def test_term_lists_read_the_texts_once(spark):
    folder = "/root/testdata/sf0.001"
    first, second = (views.vocab(spark, folder, n) for n in (50, 400))
    assert not any("documents" in name for df in (first, second) for name in df.inputFiles())
    counted = frequent.vocabulary(frequent.token_counts(views.documents(spark, folder)), 50)
    assert sorted(first.collect()) == sorted(counted.select(first.columns).collect())


def _odd_texts():
    """Letters of every script and width beside marks, lone letters, and texts that end within words."""
    random.seed(11)
    points = [0x61, 0x5A, 0x5F, 0x30, 0xE9, 0x130, 0x3A3, 0x660, 0x870, 0x2160, 0x4E2D, 0xFF21, 0x10400, 0x1D7D8, 0x1F600, 0x2EBF0, 0x31350]
    marks = [0, 0x20, 0x0A, 0x2D, 0xA0, 0x301, 0x2014, 0xFFFD, 0x1F600, 0x10FFFF]
    texts = [None, "", "a", "é", "a b", "ab", "中", "中文", "x", "", None, "𐐀", "𐐀𐐀", " ab", "ab ", "ΑΣ ΑΣ", "áb", "ab" * 40]
    for _ in range(300):
        texts.append("".join(chr(random.choice(points if random.random() < 0.7 else marks)) for _ in range(random.randrange(30))))
    return texts


def test_terms_by_array_arithmetic_are_those_of_the_expression(spark, monkeypatch):
    texts = _odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(5)
    listed = {r.id: collections.Counter(r.t or []) for r in docs.select("id", terms(F.col("text")).alias("t")).collect()}
    total = sum(listed.values(), collections.Counter())
    vocab = sorted(total)[::2]
    for block in (1, 64, 1 << 21):
        monkeypatch.setattr(term_batch, "BLOCK", block)
        for some in (vocab, ["none"], []):
            got = fold_in.term_vectors(docs, some).collect()
            assert len(got) == len(texts)
            for r in got:
                assert dict(zip(r._places, r._times)) == {i: listed[r.id][w] for i, w in enumerate(some) if listed[r.id][w]}
                assert r._places == sorted(r._places)
        lowered = pa.record_batch([pa.array([None if t is None else t.lower() for t in texts[:18]]).slice(3)], ["text"])
        packed = term_batch.packed_letters(spark)
        counted = collections.Counter()
        for names, sums in term_batch.counts(iter([lowered]), packed):
            counted.update(dict(zip(names.to_pylist(), sums.tolist())))
        assert counted == sum((listed[i] for i in range(3, 18)), collections.Counter())
    ranked = sorted(total.items(), key=lambda x: (-x[1], x[0].encode()))
    for size in (5, len(total) + 1):
        expected = [(w, n, i + 1) for i, (w, n) in enumerate(ranked[:size])]
        assert _ranked(frequent.frequent_terms(docs, size)) == expected


def test_every_letter_of_the_engine_is_one_of_the_table(spark):
    """Also those of Unicode versions that Python and the engine do not share."""
    points = [i for i in range(0x2FFFF) if not 0xD800 <= i <= 0xDFFF]
    data = "\n".join(f"q{chr(i)}" for i in points).encode()
    found, n = term_batch.find_terms(np.frombuffer(data, np.uint8), np.array([0, len(data)]), term_batch.letters(spark))
    text = spark.createDataFrame([(data.decode(),)], "text string")
    expected = text.select(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))).first()[0]
    assert found.to_pylist() == expected and n.tolist() == [len(expected)]


def test_counts_do_not_pass_terms_one_by_one(spark):
    """Vocabulary and vectors: a task gets texts, never the list of each text's terms."""
    docs = spark.createDataFrame([("aa bb",)], "text string")
    for frame in (frequent.summaries(docs, 10), fold_in.term_vectors(docs, ["aa"])):
        assert "regexp_extract_all" not in frame._jdf.queryExecution().optimizedPlan().toString()
