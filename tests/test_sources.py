"""Scans, listings, searches and headline extraction on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tonescape import schemas
from tonescape.sources import headlines as hl
from tonescape.sources import posts as ps
from tonescape.sources import tweets as tw


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_posts_from_json(spark, tmp_path):
    (tmp_path / "posts.json").write_text(
        '{"id":"a","title":"T","selftext":"B","created_utc":86400.5,"score":"7",'
        '"num_comments":"x","url":null,"subreddit":"news"}\n'
    )
    row = ps.read_posts(spark, str(tmp_path / "posts.json")).first()
    assert row.created_utc == dt.datetime(1970, 1, 2, 0, 0, 0, 500000)
    assert (row.score, row.num_comments, row.url, row.author) == (7, None, None, None)
    assert row.source == "reddit"
    assert ps.read_posts(spark, str(tmp_path / "posts.json")).columns == schemas.columns(schemas.POSTS)


@pytest.fixture(scope="module")
def posts(spark):
    data = [("a", 5), ("b", 5), ("c", 9), ("d", 1)]
    big = [("g1", i, s, dt.datetime(2024, 1, d + 1)) for d, (i, s) in enumerate(data)]
    small = [("g2", "e", 3, dt.datetime(2024, 1, 1)), ("g3", "f", 0, dt.datetime(2024, 1, 1))]
    return spark.createDataFrame(
        big + small, "subreddit string, id string, score int, created_utc timestamp_ntz"
    ).repartition(3)


def test_listing_limits_every_group(posts):
    top = ps.list_posts(posts, 3, "top")
    assert rows(top, "subreddit", "id") == [
        ("g1", "a"), ("g1", "b"), ("g1", "c"), ("g2", "e"), ("g3", "f"),
    ]
    assert rows(ps.list_posts(posts, 2, "top", ["g1"]), "id") == [("a",), ("c",)]
    assert rows(ps.list_posts(posts, 1, "new"), "id") == [("d",), ("e",), ("f",)]
    assert rows(ps.list_posts(posts, 1, "hot", ["g1"]), "id") == [("d",)]
    assert ps.list_posts(posts, 0, "new").count() == 0


def test_listing_errors(posts):
    with pytest.raises(ValueError, match="unknown sort"):
        ps.list_posts(posts, 1, "best")
    with pytest.raises(ValueError, match="ups and downs"):
        ps.list_posts(posts, 1, "controversial")
    with pytest.raises(ValueError, match="negative"):
        ps.list_posts(posts, -1, "top")


def test_controversial(posts):
    voted = posts.withColumns({"ups": F.lit(10), "downs": F.col("score")})
    assert rows(ps.list_posts(voted, 1, "controversial"), "id") == [("c",), ("e",), ("f",)]


def test_group_limit_is_cut_before_the_shuffle(posts):
    plan = ps.list_posts(posts, 3, "top")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3 and "Partial" in plan


@pytest.mark.parametrize(
    ("asked", "limit"), [(0, 0), (1, 10), (9, 10), (10, 10), (100, 100), (101, 100)]
)
def test_clamp(asked, limit):
    assert tw.clamp_limit(asked) == limit


def test_clamp_negative():
    with pytest.raises(ValueError):
        tw.clamp_limit(-1)


@pytest.fixture(scope="module")
def tweets(spark):
    texts = [
        "Climate change now", "change of climate", "climatechange", "RT @x: climate change",
        "economy and climate, change!", None,
    ]
    return spark.createDataFrame(
        [(i, t, dt.datetime(2024, 1, i + 1)) for i, t in enumerate(texts)],
        "id bigint, text string, created_at timestamp_ntz",
    )


def test_search(tweets):
    found = tw.search_terms(tweets, ["climate change", "economy", "economy", "none"], 10)
    assert rows(found, "keyword", "id") == [
        ("climate change", 0), ("climate change", 1), ("climate change", 4), ("economy", 4),
    ]
    with_shared = tw.search(tweets, "climate change", 10, include_retweets=True)
    assert rows(with_shared, "id") == [(0,), (1,), (3,), (4,)]


def test_terms_are_the_broadcast_side(tweets, monkeypatch):
    plan = tw.search(tweets, "climate")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(tw, "INDEX_BYTES", 0)
    assert rows(tw.search(tweets, "economy"), "id") == [(4,)]


def test_the_index_does_not_change_what_is_found(spark, tweets, monkeypatch):
    many = tweets.unionByName(
        spark.range(300).select(
            (F.col("id") + 100).alias("id"),
            F.concat(F.lit("the W"), (F.col("id") % 40).cast("string"), F.lit(" and so on the")).alias("text"),
            F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz").alias("created_at"),
        )
    )
    terms = [f"the w{i}" for i in range(0, 80, 3)] + ["the", "climate change", "the nowhere", "so on", "w3 climate", "The AND"]
    found = rows(tw.match_terms(many, terms), "keyword", "id")
    assert len([x for x in found if x[0] == "the"]) == 300 and ("the w3", 103) in found
    for few, size in ((0, 1 << 20), (0, 0), (100, 0)):
        monkeypatch.setattr(tw, "FEW_TERMS", few)
        monkeypatch.setattr(tw, "INDEX_BYTES", size)
        assert rows(tw.match_terms(many, terms), "keyword", "id") == found
    assert tw.match_terms(many, []).count() == 0


def test_many_terms_are_keyed_by_their_rarest_word(tweets, monkeypatch):
    monkeypatch.setattr(tw, "FEW_TERMS", 0)
    listed = {t: tw.term_words(t) for t in ["climate change", "climate economy", "climate", "climate nowhere"]}
    assert tw._keys(tweets, listed) == {
        "change": ["climate change"], "economy": ["climate economy"], "climate": ["climate"],
    }
    plan = tw.match_terms(tweets, list(listed))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_search_limits(tweets):
    many = tweets.filter("id = 0").select(
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(130).cast("bigint"))).alias("id"),
        "text",
        "created_at",
    )
    assert rows(tw.search(many, "climate", 5), "id") == [(i,) for i in range(121, 131)]
    assert tw.search(many, "climate", 500).count() == 100
    empty = tw.search(many, "climate", 0)
    assert empty.count() == 0 and "keyword" in empty.columns


def test_authors(spark):
    raw = spark.createDataFrame(
        [(1, 10), (2, 11), (3, None)] + [(i, 12) for i in range(4, 3000)],
        "id bigint, author_id bigint",
    ).select(
        "id", F.lit("t").alias("text"), F.lit(None).cast("timestamp_ntz").alias("created_at"),
        "author_id",
        *[F.lit(0).cast("bigint").alias(c) for c in
          ("retweet_count", "reply_count", "like_count", "quote_count")],
    )
    users = spark.createDataFrame(
        [(10, "old", 1, None, 1), (10, "new", 1, "x", 2), (12, "hot", 9, None, 1)],
        "id bigint, username string, followers_count bigint, location string, landed_at int",
    )
    out = tw.with_authors(raw, users)
    assert out.columns == schemas.columns(schemas.TWEETS)
    named = {r.id: (r.user_name, r.location) for r in out.collect()}
    assert len(named) == 2999 and out.count() == 2999
    assert named[1] == ("new", "x") and named[2] == (None, None) and named[3] == (None, None)
    assert all(named[i] == ("hot", None) for i in range(4, 3000))


PAGE_A = """<div><a class="x" href="/one?a=1&amp;b=2"><h2 data-testid="card-headline">
  First &amp; <b>best</b> &#8217;s &#x41;&lt;</h2></a>
<a href="/two"><img src="i"><p>tag</p><h2 class="z" data-testid='card-headline'>Second</h2></a>
<a href="/far"><div><h2 data-testid="card-headline">Nested</h2></div></a>
<a href="/before">x</a><h2 data-testid="card-headline">Plain</h2>
<h2>Other</h2></div>"""

PAGE_B = """<a class="l" href="/1"><div class="w"><span class="a container__headline-text b">One
<span>in</span> two</span></div></a>
<div><p><span class="container__headline-text" data-x="1">No link</span></p></div>
<a href="/3"><div><span class="container__headline-textual">Other class</span></div></a>
<span class="container__headline-text">Alone</span>"""


def extracted(spark, html, profile):
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id int, html string")
    found = hl.extract_headlines(pages, profile, "2024-01-01").orderBy("position")
    return [(r.title, r.url) for r in found.collect()]


def test_parent_link(spark):
    assert extracted(spark, PAGE_A, hl.PARENT_LINK) == [
        ("First & best ’s A<", "/one?a=1&b=2"),
        ("Second", "/two"),
        ("Nested", None),
        ("Plain", None),
    ]


def test_grandparent_link(spark):
    assert extracted(spark, PAGE_B, hl.GRANDPARENT_LINK) == [
        ("One\nin two", "/1"),
        ("No link", None),
        ("Alone", None),
    ]


def test_entities(spark):
    from tonescape.functions.text import decode_entities

    texts = [
        "&amp;lt; &lt;", "&#128512;&#x1F600;", "&#9999999; &unknown; &", "no", "&eacute;&nbsp;x",
        "a &#38;lt; b", "caf&agrave; &ntilde;", "&#146;&#129;", "&#x0002019;&#0;&#xD800;", "&", None,
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.d for r in frame.select(decode_entities(F.col("t")).alias("d")).collect()]
    assert got == [
        "&lt; <", "😀😀", "\ufffd &unknown; &", "no", "é\u00a0x",
        "a &lt; b", "cafà ñ", "’\x81", "’\ufffd\ufffd", "&", None,
    ]


def test_long_page_does_not_overflow(spark):
    html = "<a href='/x'>" + "<i>y</i>text " * 50_000 + PAGE_A
    assert len(extracted(spark, html, hl.PARENT_LINK)) == 4


def test_all_sources(spark):
    pages = spark.createDataFrame(
        [
            (1, "bbc", "news", PAGE_A), (2, "bbc", "sport", PAGE_A),
            (3, "cnn", "world", PAGE_B), (4, "cnn", "news", PAGE_B),
        ],
        schemas.PAGES,
    )
    found = hl.extract_all(pages, {"bbc": ["news"], "cnn": ["world", "news"]}, 2)
    assert rows(found, "source", "category", "title") == [
        ("bbc", "news", "First & best ’s A<"), ("bbc", "news", "Second"),
        ("cnn", "world", "No link"), ("cnn", "world", "One\nin two"),
    ]
    assert {r.source for r in hl.extract_all(pages, None, 20).collect()} == {"bbc"} | {"cnn"}


@pytest.mark.parametrize(
    ("html", "profile", "expected"),
    [
        ('<a href="P"><div><p>x</p></div><h2 data-testid="card-headline">T</h2></a>', "bbc", [("T", "P")]),
        ("<a href=P><h2 data-testid=card-headline>T</h2></a>", "bbc", [("T", "P")]),
        ('<a href="Y"><div><svg></svg><span class="container__headline-text">T</span></div></a>', "cnn", [("T", "Y")]),
        ('<div><a href="X"><img><span class="container__headline-text">T</span></a></div>', "cnn", [("T", None)]),
        ("<a href=/z><div><span class=container__headline-text>T</span></div></a>", "cnn", [("T", "/z")]),
        ("<a href='/q'><i>a</i><b><u>c</u></b><h2 data-testid='card-headline'>T", "bbc", [("T", "/q")]),
        ('<script>"</a><h2 data-testid=card-headline>no</h2>"</script>', "bbc", []),
    ],
)
def test_links_by_structure(spark, html, profile, expected):
    assert extracted(spark, html, hl.PROFILES[profile]) == expected


MARK = ' data-testid="card-headline"'


TAGS = [
    ('<a title="the href=wrong" href="/right">', "/right"),
    ("<a data-href='/no' href='/right'>", "/right"),
    ("<a href = /right class=x>", "/right"),
    ('<a class="x"href="/right">', "/right"),
    ('<a href="/first" href="/last">', "/last"),
    ("<a HREF='/right'>", "/right"),
    ("<a 'href=/no' \"href=/no\" href=/right>", "/right"),
    ('<a title="a > b" href="/right"\n>', "/right"),
    ('<a href="it\'s">', "it's"),
    ("<a href>", None), ('<a href="">', None), ("<a>", None), ('<a xhref="/no">', None), ('<a title="href=/no">', None),
]


def test_attributes_in_order(spark):
    html = [(i, f"{tag}<h2{MARK}>T</h2></a>") for i, (tag, _) in enumerate(TAGS)]
    found = hl.extract_headlines(spark.createDataFrame(html, "page_id int, html string"), hl.PARENT_LINK).collect()
    assert {TAGS[r.page_id][0]: r.url for r in found} == dict(TAGS)


CARD_TITLE = hl.Profile("H2", "Class", "CardTitle")


@pytest.mark.parametrize(
    ("profile", "taken", "left"),
    [
        (
            hl.PARENT_LINK,
            ['data-testid="x" data-testid="card-headline"', "DATA-TESTID=card-headline"],
            ['data-testid="card-headline wide"', 'data-testid=" card-headline"', 'data-testid="Card-headline"',
             """title='data-testid="card-headline"'""", 'class="card-headline"'],
        ),
        (
            CARD_TITLE,
            ['class="a CardTitle b"', "CLASS=CardTitle", 'class="\n CardTitle\t"'],
            ['class="cardtitle"', 'class="CardTitles"', 'id="CardTitle"'],
        ),
        (hl.Profile("h2", "id", "a b"), ['id="a b"'], ['id="a"', 'id="a  b"']),
    ],
)
def test_marks(spark, profile, taken, left):
    pages = [(i, f"<div><h2 {mark}>T</h2></div>") for i, mark in enumerate([*taken, *left])]
    found = hl.extract_headlines(spark.createDataFrame(pages, "page_id int, html string"), profile).collect()
    assert sorted(r.page_id for r in found) == list(range(len(taken)))


def test_text_around_stray_marks(spark):
    html = f"before <h2{MARK}>a < b <!-- <h2> --> c<script>x</script> d<br/>e</p> f</h2> after"
    assert extracted(spark, html, hl.PARENT_LINK) == [("a < b  c de f", None)]


def test_many_headlines_on_a_page(spark):
    html = "".join(f"<a href=/{i}><h2{MARK}>t{i}</h2></a>" for i in range(5000))
    found = extracted(spark, html, hl.PARENT_LINK)
    assert found == [(f"t{i}", f"/{i}") for i in range(5000)]


def test_pages_without_text(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "card-headline")], "page_id int, html string")
    assert hl.extract_headlines(pages, hl.PARENT_LINK).count() == 0


def test_terms_with_punctuation(spark):
    texts = ["about COVID-19 now", "the U.S. economy", "#climate!", "covid 20", "climate economy u s"]
    frame = spark.createDataFrame(
        [(i, t, dt.datetime(2024, 1, 1)) for i, t in enumerate(texts)], "id bigint, text string, created_at timestamp_ntz"
    )
    found = tw.search_terms(frame, ["covid-19", "u.s. economy", "#climate"], 10)
    assert rows(found, "keyword", "id") == [
        ("#climate", 2), ("#climate", 4), ("covid-19", 0), ("u.s. economy", 1), ("u.s. economy", 4),
    ]
    with pytest.raises(ValueError):
        tw.search(frame, "!?")


def test_authors_of_found_messages_only(spark):
    raw = spark.createDataFrame(
        [(1, "RT @a climate", 10, True), (2, "climate", 10, False), (3, "climate", 11, None)],
        "id bigint, text string, author_id bigint, is_retweet boolean",
    ).withColumns(
        {"created_at": F.lit(None).cast("timestamp_ntz")}
        | {c: F.lit(0).cast("bigint") for c in ("retweet_count", "reply_count", "like_count", "quote_count")}
    )
    users = spark.createDataFrame([(10, "n", 1, "x")], "id bigint, username string, followers_count bigint, location string")
    found = tw.search_with_authors(raw, users, ["climate"])
    assert rows(found, "id", "keyword", "user_name") == [(2, "climate", "n"), (3, "climate", None)]


def test_group_limit_over_sparks_own_bound(posts):
    plan = ps.list_posts(posts, 5000, "top")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") >= 3
    assert ps.list_posts(posts, 5000, "top").count() == posts.count()
