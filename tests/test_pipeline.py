"""The whole job: twice, with missing feeds, and with too few texts."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fixtures import views
from tonescape import session
from tonescape.functions.sentiment import Lexicon
from tonescape.operators.topics import TopicOptions
from tonescape.plans import dashboard, pipeline
from tonescape.sources import tables

SF = "/root/testdata/sf0.001"
OPTIONS = TopicOptions()


def test_two_runs_append(spark, tmp_path):
    root = str(tmp_path / "out")
    feeds = views.feeds(spark, SF)
    twice = feeds["headlines"].unionByName(feeds["headlines"])
    expected = {
        tables.RAW_POSTS: feeds["posts"].count(),
        tables.RAW_TWEETS: feeds["tweets"].count(),
        tables.RAW_HEADLINES: feeds["headlines"].dropDuplicates(["title", "url"]).count(),
        tables.TOPICS: 5,
    }
    runs = []
    for day in (1, 2):
        run = pipeline.run(
            spark, root, views.lexicon(spark, SF), feeds["posts"], feeds["tweets"], twice,
            OPTIONS, run_ts=dt.datetime(2024, 1, day),
        )
        runs.append(run)
        for name, n in expected.items():
            assert run.rows[name] == n
            assert tables.read_table(spark, root, name).count() == n * day
        stored = tables.read_table(spark, root, tables.SENTIMENT)
        assert stored.count() == run.rows[tables.SENTIMENT] * day
    one = tables.read_table(spark, root, tables.SENTIMENT, runs[1].run_id)
    assert one.select("source", "source_id").distinct().count() == one.count()
    assert one.filter("topic_id < 0 or topic_confidence <= 0").count() == 0
    assert one.filter(F.size(F.split("topic_keywords", ",")) > 5).count() == 0
    latest = tables.latest_run(tables.read_table(spark, root, tables.TOPICS))
    assert {r.run_id for r in latest.collect()} == {runs[1].run_id}

    panels = dashboard.reports(tables.read_table(spark, root, tables.SENTIMENT), latest)
    assert panels["overview"].first().sources == 3
    assert panels["sentiment_by_source"].count() == 3
    for panel in panels.values():
        assert panel.count() > 0

    stored = dashboard.stored_reports(spark, root)
    assert stored.keys() == panels.keys()
    for name, panel in stored.items():
        assert sorted(map(str, panel.collect())) == sorted(map(str, panels[name].collect())), name
        assert "sentiment_compound" not in panel._jdf.queryExecution().optimizedPlan().toString()

    plan = one.select("sentiment_compound").filter("source = 'news'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "source" in text.split("PartitionFilters")[1]
    assert "text:string" not in text


def test_too_few_texts_are_still_stored(spark, tmp_path):
    tweets = views.tweets(spark, SF).orderBy("id").limit(3)
    run = pipeline.run(spark, str(tmp_path), Lexicon({"the": 1.0}), tweets=tweets)
    assert run.rows == {tables.RAW_TWEETS: 3, tables.SENTIMENT: 3}
    stored = tables.read_table(spark, str(tmp_path), tables.SENTIMENT).collect()
    assert {(r.topic_id, r.topic_confidence, r.topic_keywords) for r in stored} == {
        (-1, 0.0, "Unknown")
    }


def test_no_feeds(spark, tmp_path):
    assert pipeline.run(spark, str(tmp_path), Lexicon({})).rows == {}


def test_empty_append_is_harmless(spark, tmp_path):
    tweets = views.tweets(spark, SF)
    assert tables.append_table(tweets.limit(0), str(tmp_path), tables.RAW_TWEETS, "a") == 0
    assert tables.append_table(tweets, str(tmp_path), tables.RAW_TWEETS, "b") == tweets.count()
    assert tables.read_table(spark, str(tmp_path), tables.RAW_TWEETS).count() == tweets.count()


def test_a_broken_run_can_be_started_again(spark, tmp_path, monkeypatch):
    root, feeds = str(tmp_path), views.feeds(spark, SF)
    options = TopicOptions(passes=1, max_features=50)

    def run():
        return pipeline.run(
            spark, root, Lexicon({"the": 1.0}), feeds["posts"], feeds["tweets"], feeds["headlines"], options,
            run_ts=dt.datetime(2024, 1, 1), run_id="night-1",
        )

    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "fit_topics", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert tables.read_table(spark, root, tables.RAW_TWEETS).count() == feeds["tweets"].count()
    first = run()
    second = run()
    assert first.rows == second.rows
    for name, n in second.rows.items():
        assert tables.read_table(spark, root, name).count() == n
    assert [tuple(r) for r in tables.run_log(spark, root).select("run_id", "n").collect()] == [
        ("night-1", second.rows[tables.SENTIMENT])
    ]
    assert tables.default_days(spark, root) == (dt.date(2024, 1, 1),) * 2


def test_days_are_read_from_their_runs_only(spark, tmp_path):
    root = str(tmp_path)
    for day in (1, 2, 5, 20):
        rows = [("reddit", f"{day}-{i}", dt.datetime(2024, 1, day, 23, 59, 59, 999999)) for i in range(3)]
        frame = spark.createDataFrame(rows, "source string, source_id string, processed_at timestamp_ntz")
        kinds = dict(part.split() for part in tables.LAYOUT[tables.SENTIMENT][0].split(", "))
        frame = frame.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in frame.columns})
        tables.append_table(frame, root, tables.SENTIMENT, f"day{day}")
        if day != 5:  # not finished
            tables.finish_run(spark, root, f"day{day}")
    found = tables.read_days(spark, root, "2024-01-02", dt.date(2024, 1, 19))
    assert sorted(r.source_id for r in found.collect()) == ["2-0", "2-1", "2-2"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "run_id" in pruned and "day2" in pruned and "day20" not in pruned
    assert tables.default_days(spark, root) == (dt.date(2024, 1, 13), dt.date(2024, 1, 20))
    assert {r.source_id for r in tables.read_last_week(spark, root).collect()} == {"20-0", "20-1", "20-2"}
    with pytest.raises(ValueError):
        tables.append_table(frame, root, tables.SENTIMENT, "../x")


def test_no_results_have_no_range(spark, tmp_path):
    tables.append_table(tables.schemas.empty(spark, tables.LAYOUT[tables.SENTIMENT][0]), str(tmp_path), tables.SENTIMENT, "a")
    tables.finish_run(spark, str(tmp_path), "a")
    assert tables.default_days(spark, str(tmp_path)) is None
    assert tables.read_last_week(spark, str(tmp_path)).count() == 0


class FakeSession:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId="fake")


def test_shared_dir_setting_is_used():
    assert session.shared_dir(FakeSession("spark://x", "/cluster/shared/")) == "/cluster/shared"
    assert session.shared_dir(FakeSession("local[2]", "/own")) == "/own"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("spark://x"))
