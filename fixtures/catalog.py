"""Registered queries: each with its Spark side and, where SQL can say it, its SQL side."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import views as v
from fixtures.oracle import decoded, lit, mean, statement
from tonescape.functions import scalar
from tonescape.functions.sentiment import score
from tonescape.functions.text import SPACE, TERM, WORD, strip_space
from tonescape.operators import enrich, frequent, graph, panels, report, scoring, topics, unify
from tonescape.plans import dashboard
from tonescape.session import shared_dir
from tonescape.sources import headlines as hl
from tonescape.sources import posts as ps
from tonescape.sources import tables
from tonescape.sources import tweets as tw

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = statement(sql)
        return function

    return register


def _scores(struct: str = "s") -> list:
    return [F.col(f"{struct}.{name}").alias(name) for name in ("compound", "pos", "neu", "neg")]


# --- Posts -------------------------------------------------------------------------

_POST = "id, title, text, created_utc, score, num_comments, url, author, subreddit, source"
_LISTED = "id, subreddit, score, created_utc"


@query(f"select {_POST} from v_posts")
def posts_scan(spark, sf_dir):
    return ps.scan_posts(v.raw_posts(spark, sf_dir))


def _listing(order: str, limit: int, source: str = "v_posts", where: str = "true") -> str:
    return f"""select {_LISTED} from (
        select *, row_number() over (partition by subreddit order by {order} desc, id) rn
        from {source} where {where}) where rn <= {limit}"""


@query(_listing("score", 20))
def posts_top_per_group(spark, sf_dir):
    return ps.list_posts(v.posts(spark, sf_dir), 20, "top").select(*_LISTED.split(", "))


@query(_listing("created_utc", 20))
def posts_new_per_group(spark, sf_dir):
    return ps.list_posts(v.posts(spark, sf_dir), 20, "new").select(*_LISTED.split(", "))


@query(
    _listing(
        "round(sign(score) * log10(greatest(abs(score), 1))"
        " + (epoch(created_utc) - 1134028003) / 45000.0::double, 7)",
        20,
    )
)
def posts_hot_per_group(spark, sf_dir):
    return ps.list_posts(v.posts(spark, sf_dir), 20, "hot").select(*_LISTED.split(", "))


@query(
    _listing(
        "case when score <= 0 or num_comments <= 0 then 0 else pow(score + num_comments * 10.0,"
        " least(score, num_comments * 10) / cast(greatest(score, num_comments * 10) as double))"
        " end",
        20,
    )
)
def posts_controversial_per_group(spark, sf_dir):
    voted = v.posts(spark, sf_dir).withColumns(
        {"ups": F.col("score"), "downs": F.col("num_comments") * 10}
    )
    return ps.list_posts(voted, 20, "controversial").select(*_LISTED.split(", "))


@query(_listing("created_utc", 10, where="subreddit in ('src0', 'src3', 'src7')"))
def posts_multi_group(spark, sf_dir):
    listed = ps.list_posts(v.posts(spark, sf_dir), 10, "new", ["src0", "src3", "src7"])
    return listed.select(*_LISTED.split(", "))


# --- Messages ----------------------------------------------------------------------

_TERMS = ["the", "de la", "und", "of and"]


def _has_words(term: str) -> str:
    found = f"regexp_extract_all(lower(text), '{WORD}')"
    return " and ".join(f"list_contains({found}, {lit(w)})" for w in term.split())


def _search(term: str, limit: int, tag: str) -> str:
    return f"""(select {tag}, id, created_at from v_tweets
        where {_has_words(term)} and text not like 'RT @%'
        order by created_at desc, id desc limit {limit})"""


@query(_search("of and", 100, "'of and' keyword"))
def tweets_keyword_search(spark, sf_dir):
    return tw.search(v.tweets(spark, sf_dir), "of and").select("keyword", "id", "created_at")


@query(
    " union all ".join(
        _search("the", limit, f"{asked} requested")
        for asked, limit in [(0, 0), (5, 10), (50, 50), (500, 100)]
    )
)
def tweets_limit_clamp(spark, sf_dir):
    parts = [
        tw.search(v.tweets(spark, sf_dir), "the", asked).select(
            F.lit(asked).alias("requested"), "id", "created_at"
        )
        for asked in (0, 5, 50, 500)
    ]
    return unify.union_all(parts)


@query(" union all ".join(_search(t, 20, f"{lit(t)} keyword") for t in _TERMS))
def tweets_all_terms(spark, sf_dir):
    found = tw.search_terms(v.tweets(spark, sf_dir), _TERMS, 20)
    return found.select("keyword", "id", "created_at")


@query(
    f"""select keyword, id, created_at from (
          select concat('the ', term) keyword, id, created_at,
                 row_number() over (partition by term order by created_at desc, id desc) place
          from (select id, created_at, regexp_extract_all(lower(text), '{WORD}') found from v_tweets
                where text not like 'RT @%') m
               join v_vocab on list_contains(found, 'the') and list_contains(found, term))
        where place <= 20"""
)
def tweets_many_terms(spark, sf_dir):
    """Hundreds of terms that all begin with the most frequent word."""
    terms = [f"the {r.term}" for r in v.vocab(spark, sf_dir).collect()]
    found = tw.search_terms(v.tweets(spark, sf_dir), terms, 20)
    return found.select("keyword", "id", "created_at")


@query("select id, text from v_tweets where like_count <> 0")
def tweets_no_retweets(spark, sf_dir):
    text = F.when(F.col("like_count") == 0, F.concat(F.lit("RT @a: "), "text"))
    shared = v.tweets(spark, sf_dir).withColumn("text", F.coalesce(text, "text"))
    return tw.drop_retweets(shared).select("id", "text")


@query(
    """select event_id id, event_type as text, ts created_at, user_id,
              c.c_name user_name, cast(floor(c.c_acctbal) as bigint) user_followers,
              c.c_mktsegment "location"
       from events e left join customer c on e.user_id = c.c_custkey"""
)
def tweet_author_join(spark, sf_dir):
    zero = F.lit(0).cast("bigint")
    messages = v.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("text"),
        F.col("ts").alias("created_at"),
        F.col("user_id").alias("author_id"),
        *[zero.alias(c) for c in ("retweet_count", "reply_count", "like_count", "quote_count")],
    )
    landed = v.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("username"),
        F.floor("c_acctbal").cast("bigint").alias("followers_count"),
        F.col("c_mktsegment").alias("location"),
        F.lit(2).alias("landed_at"),
    )
    older = landed.withColumns({"username": F.lit("old"), "landed_at": F.lit(1)})
    return tw.with_authors(messages, landed.unionByName(older)).select(
        "id", "text", "created_at", "user_id", "user_name", "user_followers", "location"
    )


# --- Headlines ---------------------------------------------------------------------


@query("select seq, title, url, source, category, extracted_at from v_headlines")
def headlines_profile_a(spark, sf_dir):
    return v.headlines(spark, sf_dir).select(
        "seq", "title", "url", "source", "category", "extracted_at"
    )


@query(
    rf"""select page_id, cast(p - 1 as integer) "position",
         regexp_replace({decoded('m')}, {lit(f"^{SPACE}+|{SPACE}+$")}, '', 'g') title,
         nullif(replace(regexp_extract(m, 'href="([^"]*)"', 1), '&amp;', '&'), '') url
     from (select page_id, unnest(l) m, generate_subscripts(l, 1) p
           from (select page_id, regexp_extract_all(html, '(?s)<a\b[^>]*>.*?</a>') l from pages))"""
)
def headlines_profile_b(spark, sf_dir):
    found = hl.extract_headlines(v.pages(spark, sf_dir), v.ANCHOR, "2024-01-02")
    return found.select("page_id", "position", "title", "url")


def _marked_pages(spark, sf_dir, first: str, last: str) -> DataFrame:
    """The pages with their headlines in a site's own markup; {} stands for the page's number."""
    number = F.col("page_id").cast("string")
    before, after = (F.replace(F.lit(text), F.lit("{}"), number) for text in (first, last))
    html = F.replace(F.replace("html", F.lit("<h1>"), before), F.lit("</h1>"), after)
    return v.pages(spark, sf_dir).withColumn("html", html)


# Each mark beside near misses: a link and a mark inside other values, a mark as one word of an
# attribute that is no list, a class that only begins alike, capitals in names, no link at all.
_CARD = (
    """<h2 data-testid="card-headline wide">no</h2><h2 title='data-testid="card-headline"'>no</h2>"""
    """<A title="the href=wrong" HREF="/card/{}?a=1&amp;b=2"><H2 class=x Data-TestId='card-headline'>""",
    """</H2></A><div href="/no"><h2 data-testid=card-headline>alone</h2></div>""",
)
_CONTAINER = (
    """<span class="container__headline-textual">no</span><span data-class="container__headline-text">no</span>"""
    """<a data-x='href="/no"' href=/text/{}><div title="a > b"><br><span class="a container__headline-text\nb"><!-- <i> -->""",
    """</span></div></a><p><span class="Container__headline-text">no</span></p>""",
)


@query(
    """select page_id, 0 "position", title, concat('/card/', cast(page_id as varchar), '?a=1&b=2') url
       from v_headlines join pages p on p.page_id = seq
       union all select page_id, 1, 'alone', null from pages"""
)
def headlines_card_mark(spark, sf_dir):
    found = hl.extract_headlines(_marked_pages(spark, sf_dir, *_CARD), hl.PARENT_LINK, "2024-01-02")
    return found.select("page_id", "position", "title", "url")


@query(
    """select page_id, 0 "position", title, concat('/text/', cast(page_id as varchar)) url
       from v_headlines join pages p on p.page_id = seq"""
)
def headlines_container_mark(spark, sf_dir):
    found = hl.extract_headlines(_marked_pages(spark, sf_dir, *_CONTAINER), hl.GRANDPARENT_LINK, "2024-01-02")
    return found.select("page_id", "position", "title", "url")


@query(
    """select seq, source, category, title from v_headlines
       where source <> 'cnn' or category in ('en', 'fr')"""
)
def headlines_category_whitelist(spark, sf_dir):
    kept = hl.keep_allowed(v.headlines(spark, sf_dir), {"cnn": ["en", "fr"]})
    return kept.select("seq", "source", "category", "title")


@query(
    """select seq, source, category, title from (
         select *, row_number() over (partition by source, category order by seq) rn
         from v_headlines
         where (source = 'bbc' and category in ('en', 'de'))
            or (source = 'cnn' and category in ('en', 'fr')))
       where rn <= 5"""
)
def headlines_limit_per_category(spark, sf_dir):
    found = hl.list_headlines(
        v.headlines(spark, sf_dir),
        {"bbc": ["en", "de"], "cnn": ["en", "es", "fr"]},
        5,
        ["seq"],
        {"cnn": ["en", "fr"]},
    )
    return found.select("seq", "source", "category", "title")


@query(
    """select source, seq, title, url, category, extracted_at from (
         select *, row_number() over (partition by title, url order by seq) rn from (
           select * from v_headlines
           union all select * replace (seq + 1000000 as seq) from v_headlines))
       where rn = 1"""
)
def dedup_headlines(spark, sf_dir):
    once = v.headlines(spark, sf_dir)
    twice = once.unionByName(once.withColumn("seq", F.col("seq") + 1_000_000))
    return unify.dedup_headlines(twice, ["seq"]).select(
        "source", "seq", "title", "url", "category", "extracted_at"
    )


# --- Sentiment ---------------------------------------------------------------------


@query("select token, valence from v_lexicon")
def lexicon_table(spark, sf_dir):
    return v.lexicon_table(spark, sf_dir)


@query("select k doc_id, compound, pos, neu, neg from v_doc_scores")
def sentiment_base(spark, sf_dir):
    lexicon = v.lexicon(spark, sf_dir)
    scored = v.documents(spark, sf_dir).select("doc_id", score("text", lexicon).alias("s"))
    return scored.select("doc_id", *_scores())


@query("select k doc_id, compound, pos, neu, neg from v_cued_scores")
def sentiment_rules(spark, sf_dir):
    lexicon = v.lexicon(spark, sf_dir)
    scored = v.cued_documents(spark, sf_dir).select(
        "doc_id", score("text", lexicon).alias("s")
    )
    return scored.select("doc_id", *_scores())


@query(
    """select doc_id, variant, 0.0::double compound, 0.0::double pos,
              case when variant = 'marks' and length(t) > 1 then 1.0::double
                   else 0.0::double end neu, 0.0::double neg
       from (select doc_id, 'null' variant, cast(null as varchar) t from documents
             union all select doc_id, 'empty', '' from documents
             union all
             select doc_id, 'marks', repeat('!', cast(n_chars % 4 as integer)) from documents)"""
)
def sentiment_empty_text(spark, sf_dir):
    """Null and empty texts score zero; a text of marks alone is neutral."""
    marks = F.expr("repeat('!', cast(n_chars % 4 as int))")
    variants = F.array(
        *[
            F.struct(F.lit(name).alias("variant"), text.alias("t"))
            for name, text in [
                ("null", F.lit(None).cast("string")), ("empty", F.lit("")), ("marks", marks)
            ]
        ]
    )
    return (
        v.documents(spark, sf_dir)
        .select("doc_id", F.explode(variants).alias("x"))
        .select("doc_id", "x.variant", score("x.t", v.lexicon(spark, sf_dir)).alias("s"))
        .select("doc_id", "variant", *_scores())
    )


def _four(prefix: str) -> str:
    names = {"compound": "compound", "positive": "pos", "neutral": "neu", "negative": "neg"}
    return ", ".join(f"s.{short} {prefix}_{name}" for name, short in names.items())


def _flat(prefix: str) -> list[str]:
    return [f"{prefix}_{name}" for name in ("compound", "positive", "neutral", "negative")]


_RUN = "2024-03-01 12:00:00"


@query(
    f"""select p.id, {_four('title_sentiment')}, d.compound text_sentiment_compound,
               timestamp '{_RUN}' processed_at
        from v_posts p join v_feed_scores s on s.k = concat('reddit:', p.id)
        join v_doc_scores d on d.k = p.seq"""
)
def score_posts(spark, sf_dir):
    scored = scoring.score_posts(v.posts(spark, sf_dir), v.lexicon(spark, sf_dir), _RUN)
    return scored.select(
        "id", *_flat("title_sentiment"), "text_sentiment_compound", "processed_at"
    )


@query(
    f"""select t.id, {_four('sentiment')}, timestamp '{_RUN}' processed_at
        from v_tweets t join v_feed_scores s on s.k = concat('twitter:', cast(t.id as varchar))"""
)
def score_tweets(spark, sf_dir):
    scored = scoring.score_tweets(v.tweets(spark, sf_dir), v.lexicon(spark, sf_dir), _RUN)
    return scored.select("id", *_flat("sentiment"), "processed_at")


@query(
    f"""select h.seq, h.title, {_four('sentiment')}, timestamp '{_RUN}' processed_at
        from v_headlines h join v_feed_scores s on s.k = concat('news:', cast(h.seq as varchar))"""
)
def score_headlines(spark, sf_dir):
    scored = scoring.score_headlines(v.headlines(spark, sf_dir), v.lexicon(spark, sf_dir), _RUN)
    return scored.select("seq", "title", *_flat("sentiment"), "processed_at")


# --- Unified table -----------------------------------------------------------------

_UNIFIED = (
    "source, source_id, text, created_at, sentiment_compound, sentiment_positive, "
    "sentiment_neutral, sentiment_negative"
)
_UNIFIED_SQL = _UNIFIED.replace("text", '"text"', 1)


def _unified(source: str) -> str:
    return f"select {_UNIFIED_SQL} from v_unified where source = '{source}'"


@query(_unified("reddit"))
def unify_posts(spark, sf_dir):
    scored = scoring.score_posts(v.posts(spark, sf_dir), v.lexicon(spark, sf_dir))
    return unify.unify_posts(scored).select(*_UNIFIED.split(", "))


@query(_unified("twitter"))
def unify_tweets(spark, sf_dir):
    scored = scoring.score_tweets(v.tweets(spark, sf_dir), v.lexicon(spark, sf_dir))
    return unify.unify_tweets(scored).select(*_UNIFIED.split(", "))


@query(_unified("news"))
def unify_news(spark, sf_dir):
    scored = scoring.score_headlines(v.headlines(spark, sf_dir), v.lexicon(spark, sf_dir))
    return unify.unify_news(scored, order=["seq"]).select(*_UNIFIED.split(", "))


@query(f"select {_UNIFIED_SQL}, processed_at from v_unified")
def unified_sentiment(spark, sf_dir):
    return v.unified(spark, sf_dir).select(*_UNIFIED.split(", "), "processed_at")


@query(
    """select source, seq, title, "text", url, subreddit, category from (
         select source, seq, title, text as "text", url, subreddit, null category from v_posts
         union all select source, seq, null, text, null, null, null from v_tweets
         union all select source, seq, title, null, url, null, category from v_headlines)"""
)
def union_feeds(spark, sf_dir):
    return unify.union_all(list(v.feeds(spark, sf_dir).values())).select(
        "source", "seq", "title", "text", "url", "subreddit", "category"
    )


@query(
    """select source, source_id, seq from (
         select *, row_number() over (partition by source, source_id order by seq) rn from (
           select source, source_id, seq from v_results
           union all select source, source_id, seq + 1000000 from v_results))
       where rn = 1"""
)
def dedup_unified(spark, sf_dir):
    once = v.results(spark, sf_dir)
    twice = once.unionByName(once.withColumn("seq", F.col("seq") + 1_000_000))
    return unify.dedup_unified(twice, ["seq"]).select("source", "source_id", "seq")


@query(
    """select 'reddit' source, title as "text" from v_posts
       union all select 'twitter', text from v_tweets
       union all select 'news', title from v_headlines"""
)
def corpus_union(spark, sf_dir):
    return unify.corpus(**v.feeds(spark, sf_dir))


_RESULT = "source, source_id, seq, topic_id, topic_confidence, topic_keywords"


@query(f"select {_RESULT} from v_results")
def topic_enrich(spark, sf_dir):
    enriched = enrich.topic_enrich(
        v.unified(spark, sf_dir), v.assignment(spark, sf_dir), ["feed", "seq"]
    )
    return enriched.select(*_RESULT.split(", "))


# --- Tables ------------------------------------------------------------------------


def _three_runs(spark, sf_dir) -> str:
    """The results stored as runs of ten days each; one is written twice."""
    root, found = _new_root(spark), v.results(spark, sf_dir)
    day = F.date_diff(F.to_date("processed_at"), F.lit("2024-01-01").cast("date"))
    for run in (0, 1, 2, 1):
        tables.append_table(found.filter(F.floor(day / 10) == run), root, tables.SENTIMENT, f"run{run}")
        tables.finish_run(spark, root, f"run{run}")
    return root


@query(
    """select source, source_id, processed_at, topic_id from v_results
       where cast(processed_at as date) between date '2024-01-08' and date '2024-01-12'"""
)
def stored_days(spark, sf_dir):
    """A range of days over two of three runs."""
    found = tables.read_days(spark, _three_runs(spark, sf_dir), "2024-01-08", "2024-01-12")
    return found.select("source", "source_id", "processed_at", "topic_id")


@query(
    """select source, source_id, processed_at, topic_id from v_results
       where cast(processed_at as date) >= (
         select greatest(min(cast(processed_at as date)), max(cast(processed_at as date)) - 7) from v_results)"""
)
def stored_last_week(spark, sf_dir):
    """The default range, its bounds from the log of runs."""
    found = tables.read_last_week(spark, _three_runs(spark, sf_dir))
    return found.select("source", "source_id", "processed_at", "topic_id")


@query(
    """select 'none' feed, cast(0 as bigint) written, cast(0 as bigint) stored
       union all select 'repeated', count(*), count(*) from v_tweets
       union all select 'both', cast(0 as bigint), 2 * count(*) from v_tweets"""
)
def sink_only_when_rows(spark, sf_dir):
    """Nothing is written without rows; a run that is written again is there once."""
    root, rows, found = _new_root(spark), [], v.tweets(spark, sf_dir)
    stored = lambda: tables.read_table(spark, root, tables.RAW_TWEETS).count()
    tables.append_table(found.limit(0), root, tables.RAW_TWEETS, "empty")
    rows.append(("none", tables.append_if_any(found.filter("like_count < 0"), root, tables.RAW_TWEETS, "a"), stored()))
    tables.append_if_any(found.filter("like_count > 3"), root, tables.RAW_TWEETS, "a")
    rows.append(("repeated", tables.append_if_any(found, root, tables.RAW_TWEETS, "a"), stored()))
    tables.append_table(found, root, tables.RAW_TWEETS, "b")
    rows.append(("both", 0, stored()))
    return spark.createDataFrame(rows, "feed string, written long, stored long")


def _new_root(spark) -> str:
    return f"{shared_dir(spark)}/tables-{uuid.uuid4().hex}"


@query(f"select {_UNIFIED_SQL}, processed_at, topic_id, topic_confidence from v_results")
def results_scan(spark, sf_dir):
    root = _new_root(spark)
    tables.append_table(v.results(spark, sf_dir), root, tables.SENTIMENT, "run")
    stored = tables.read_table(spark, root, tables.SENTIMENT, "run")
    return stored.select(*_UNIFIED.split(", "), "processed_at", "topic_id", "topic_confidence")


_TOPIC_NAME = "concat('Topic ', topic_id, ': ', topic_keywords[1], ' - ', topic_keywords[2])"


def _named_topics(spark, sf_dir):
    surrogate = v.topics(spark, sf_dir)
    return surrogate.join(topics.topic_names(surrogate), "topic_id")


_STORED_TOPICS = f"""select topic_id, {_TOPIC_NAME} topic_name,
    array_to_string(topic_keywords, ' ') keywords, created_at from v_topics"""


@query(_STORED_TOPICS)
def topics_scan(spark, sf_dir):
    """Two runs are stored, and the newest one is read."""
    root = _new_root(spark)
    named = _named_topics(spark, sf_dir)
    older = named.withColumn("created_at", scalar.ntz("2023-12-01 00:00:00"))
    tables.append_table(older, root, tables.TOPICS, "first")
    tables.append_table(named, root, tables.TOPICS, "second")
    stored = tables.latest_run(tables.read_table(spark, root, tables.TOPICS))
    keywords = F.concat_ws(" ", "topic_keywords").alias("keywords")
    return stored.select("topic_id", "topic_name", keywords, "created_at")


@query(f"select {_POST}, cast(run as varchar) run_id from v_posts, (values (1), (2)) r(run)")
def sink_roundtrip(spark, sf_dir):
    """Two appends: the second adds rows and leaves the first alone."""
    root = _new_root(spark)
    for run_id in ("1", "2"):
        tables.append_table(v.posts(spark, sf_dir), root, tables.RAW_POSTS, run_id)
    return tables.read_table(spark, root, tables.RAW_POSTS)


@query(_STORED_TOPICS)
def topics_sink_roundtrip(spark, sf_dir):
    root = _new_root(spark)
    tables.append_table(_named_topics(spark, sf_dir), root, tables.TOPICS, "run")
    keywords = F.concat_ws(" ", "topic_keywords").alias("keywords")
    stored = tables.read_table(spark, root, tables.TOPICS)
    return stored.select("topic_id", "topic_name", keywords, "created_at")


# --- Filters -----------------------------------------------------------------------

_KEY = ["source", "source_id", "processed_at", "topic_id"]
_KEYS = ", ".join(_KEY)


@query(
    f"""select {_KEYS} from v_results where processed_at >= timestamp '2024-01-05 00:00:00'
        and processed_at <= timestamp '2024-01-20 23:59:59'"""
)
def filter_date_range(spark, sf_dir):
    return report.in_days(v.results(spark, sf_dir), "2024-01-05", "2024-01-20").select(*_KEY)


@query(
    f"""select {_KEYS} from v_results,
          (select max(processed_at)::date hi, min(processed_at)::date lo from v_results) b
        where processed_at >= greatest(lo, hi - 7)::timestamp
          and processed_at <= hi::timestamp + interval 86399 seconds"""
)
def filter_default_last_week(spark, sf_dir):
    return report.last_week(v.results(spark, sf_dir)).select(*_KEY)


@query(f"select {_KEYS} from v_results where topic_id in (1, 3)")
def filter_topics_isin(spark, sf_dir):
    return report.with_topics(v.results(spark, sf_dir), [1, 3]).select(*_KEY)


@query("select distinct topic_id from v_results")
def topic_options(spark, sf_dir):
    return report.topic_options(v.results(spark, sf_dir))


@query(f"select {_KEYS} from v_results where source = 'news'")
def filter_source(spark, sf_dir):
    return report.from_source(v.results(spark, sf_dir), "news").select(*_KEY)


@query("select bool_or(sentiment_compound <> 0) has_sentiment from v_results")
def any_nonzero_sentiment(spark, sf_dir):
    return report.any_nonzero(v.results(spark, sf_dir))


# --- Aggregates --------------------------------------------------------------------


@query(
    """select 'raw_reddit_posts' collection, count(*) n from v_posts
       union all select 'raw_twitter_posts', count(*) from v_tweets
       union all select 'raw_news_articles', count(*) from v_headlines
       union all select 'topics', count(*) from v_topics"""
)
def collection_counts(spark, sf_dir):
    feeds = v.feeds(spark, sf_dir)
    return report.collection_counts(
        {
            tables.RAW_POSTS: feeds["posts"],
            tables.RAW_TWEETS: feeds["tweets"],
            tables.RAW_HEADLINES: feeds["headlines"],
            tables.TOPICS: v.topics(spark, sf_dir),
        }
    )


@query(
    """select count(*) datapoints, count(distinct source) sources, count(distinct topic_id) topics
       from v_results"""
)
def overview_metrics(spark, sf_dir):
    return report.overview(v.results(spark, sf_dir))


@query(f"select source, {mean('sentiment_compound')} avg_compound from v_results group by source")
def avg_sentiment_by_source(spark, sf_dir):
    return report.mean_by(v.results(spark, sf_dir), "source")


@query(
    f"select topic_id, {mean('sentiment_compound')} avg_compound from v_results group by topic_id"
)
def avg_sentiment_by_topic(spark, sf_dir):
    return report.mean_by(v.results(spark, sf_dir), "topic_id")


@query(
    f"""select source, {mean('sentiment_compound')} average_sentiment, count(*) n
        from v_results group by source"""
)
def sentiment_group_avg_count(spark, sf_dir):
    return report.group_mean_count(v.results(spark, sf_dir))


@query("select source, topic_id, n from v_by_source")
def topics_by_source(spark, sf_dir):
    return report.topics_by_source(v.results(spark, sf_dir))


@query(
    """select min(processed_at)::date::varchar min_date, max(processed_at)::date::varchar max_date
       from v_results"""
)
def date_bounds(spark, sf_dir):
    bounds = report.date_bounds(v.results(spark, sf_dir))
    return bounds.select(*[F.col(c).cast("string").alias(c) for c in bounds.columns])


@query(
    f"""select {mean('sentiment_positive')} mean_positive,
               {mean('sentiment_neutral')} mean_neutral,
               {mean('sentiment_negative')} mean_negative, count(*) n from v_results"""
)
def mean_components(spark, sf_dir):
    return report.mean_components(v.results(spark, sf_dir))


@query(
    """select source, cast(least(floor((cast(floor(sentiment_compound * 10000 + 0.5::double)
              as bigint) + 10000) / 1000.0::double), 19) as integer) bin, count(*) n
       from v_results group by all"""
)
def sentiment_histogram(spark, sf_dir):
    return report.histogram(v.results(spark, sf_dir))


@query("select source_id, count(*) n from v_results where source = 'news' group by source_id")
def news_id_counts(spark, sf_dir):
    return report.id_counts(v.results(spark, sf_dir))


_SOURCES = ["reddit", "twitter", "news"]


@query(
    "select topic_id, "
    + ", ".join(f"count(*) filter (where source = '{s}') {s}" for s in _SOURCES)
    + " from v_results group by topic_id"
)
def topic_source_crosstab(spark, sf_dir):
    return report.crosstab(v.results(spark, sf_dir), _SOURCES)


@query("select source, arg_max(topic_id, n * 100 - topic_id) topic_id from v_by_source group by 1")
def dominant_topic_by_source(spark, sf_dir):
    return report.dominant_topic(v.results(spark, sf_dir))


@query(
    """select source, topic_id, n, cast(row_number() over (
         partition by source order by n desc, topic_id) as integer) "rank" from v_by_source"""
)
def rank_topics_in_source(spark, sf_dir):
    return report.rank_topics(report.topics_by_source(v.results(spark, sf_dir)))


@query(
    """select s.source, s.topic_id, s.n, cast(row_number() over (
         partition by s.source order by s.n desc, s.topic_id) as integer) "rank",
         array_to_string(t.topic_keywords[1:5], ', ') keywords
       from v_by_source s left join v_topics t on s.topic_id = t.topic_id"""
)
def topics_by_source_keywords(spark, sf_dir):
    by_source = report.topics_by_source(v.results(spark, sf_dir))
    out = report.topics_by_source_keywords(by_source, v.topics(spark, sf_dir))
    return out.select("source", "topic_id", "n", "rank", "keywords")


@query("select distinct keyword from v_terms")
def distinct_keywords(spark, sf_dir):
    return report.distinct_values(graph.topic_terms(v.topics(spark, sf_dir)), "keyword")


@query(
    """select 'before' stage, 2 * count(*) records,
              2 * count(*) filter (where source = 'news') news_records from v_results
       union all
       select 'after', count(*), count(*) filter (where source = 'news')
       from (select distinct source, source_id from v_results)"""
)
def dedup_report(spark, sf_dir):
    once = v.results(spark, sf_dir)
    twice = once.unionByName(once.withColumn("seq", F.col("seq") + 1_000_000))
    return report.dedup_report(twice, unify.dedup_unified(twice, ["seq"]))


@query(
    """select source, source_id, seq from v_results order by created_at, source, source_id
       limit 5"""
)
def head_sample(spark, sf_dir):
    first = report.head(v.results(spark, sf_dir), ["created_at", "source", "source_id"])
    return first.select("source", "source_id", "seq")


# --- Panels, from results that are read once -----------------------------------------

_BIN = """cast(least(floor((cast(floor(sentiment_compound * 10000 + 0.5::double) as bigint) + 10000)
    / 1000.0::double), 19) as integer)"""


@query(
    f"""select processed_at::date::varchar "day", source, topic_id, {_BIN} bin, count(*) n,
               count(*) filter (where sentiment_compound <> 0) nonzero, """
    + ", ".join(
        f"count(sentiment_{c}) {c}_n, cast(sum(cast(floor(sentiment_{c} * 1000000 + 0.5::double) as bigint)) as bigint) {c}_sum"
        for c in panels.COMPONENTS
    )
    + ", min(processed_at) first_time, max(processed_at) last_time from v_results group by 1, 2, 3, 4"
)
def panel_sums(spark, sf_dir):
    # Times are whole minutes here, so no row is late.
    sums = panels.panel_sums(v.results(spark, sf_dir)).withColumn("day", F.col("day").cast("string"))
    return sums.drop("run_id", "late")


def _panel(name, spark, sf_dir, start="2024-01-05", end="2024-01-20"):
    return dashboard.from_sums(v.sums(spark, sf_dir), v.topics(spark, sf_dir), start, end)[name]


@query("select count(*) datapoints, count(distinct source) sources, count(distinct topic_id) topics from v_days")
def panel_overview(spark, sf_dir):
    return _panel("overview", spark, sf_dir)


@query(
    """select count(*) datapoints, count(distinct source) sources, count(distinct topic_id) topics
       from v_results, (select max(processed_at)::date hi, min(processed_at)::date lo from v_results) b
       where processed_at >= greatest(lo, hi - 7)::timestamp
         and processed_at <= hi::timestamp + interval 86399 seconds"""
)
def panel_overview_last_week(spark, sf_dir):
    return _panel("overview", spark, sf_dir, None, None)


@query("select distinct topic_id from v_results")
def panel_topic_options(spark, sf_dir):
    return _panel("topic_options", spark, sf_dir)


@query(f"select source, {_BIN} bin, count(*) n from v_days group by all")
def panel_histogram(spark, sf_dir):
    return _panel("histogram", spark, sf_dir)


@query(f"select source, {mean('sentiment_compound')} avg_compound from v_days group by source")
def panel_by_source(spark, sf_dir):
    return _panel("sentiment_by_source", spark, sf_dir)


@query(f"select topic_id, {mean('sentiment_compound')} avg_compound from v_days group by topic_id")
def panel_by_topic(spark, sf_dir):
    return _panel("sentiment_by_topic", spark, sf_dir)


@query(
    """select s.source, s.topic_id, s.n, cast(row_number() over (
         partition by s.source order by s.n desc, s.topic_id) as integer) "rank",
         array_to_string(t.topic_keywords[1:5], ', ') keywords
       from (select source, topic_id, count(*) n from v_days
             where source is not null and topic_id is not null group by all) s
            left join v_topics t on s.topic_id = t.topic_id"""
)
def panel_topics_by_source(spark, sf_dir):
    return _panel("topics_by_source", spark, sf_dir).select("source", "topic_id", "n", "rank", "keywords")


@query(
    f"""select concat('Topic ', t.topic_id) id, 'topic' "type", coalesce(m.m, 0.0::double) sentiment
        from (select distinct topic_id from v_terms where score >= 5) t
        left join (select topic_id, {mean('sentiment_compound')} m from v_days group by topic_id) m
          on t.topic_id = m.topic_id
        union all
        select distinct keyword, 'keyword', null::double from v_terms where score >= 5"""
)
def panel_nodes(spark, sf_dir):
    return _panel("nodes", spark, sf_dir)


@query(
    f"""select {mean('sentiment_positive')} mean_positive,
               {mean('sentiment_neutral')} mean_neutral,
               {mean('sentiment_negative')} mean_negative, count(*) n from v_results"""
)
def panel_components(spark, sf_dir):
    return panels.mean_components(v.sums(spark, sf_dir))


# --- Topics ------------------------------------------------------------------------


_ALL_TERMS = f"(select unnest(regexp_extract_all(lower(text), '{TERM}')) w from documents)"


@query(f"select w term, count(*) n from {_ALL_TERMS} group by w")
def tokenize_counts(spark, sf_dir):
    return frequent.token_counts(v.documents(spark, sf_dir))


@query(
    f"""select w term, count(*) n from {_ALL_TERMS}
        where w not in (select term from v_vocab where rnk <= 20) group by w"""
)
def stopword_filter(spark, sf_dir):
    """The twenty most frequent terms serve as the stop words."""
    stop_words = [r.term for r in v.vocab(spark, sf_dir, 20).collect()]
    return topics.drop_stop_words(frequent.token_counts(v.documents(spark, sf_dir)), stop_words)


_TOP = f"""select w term, count(*) n, cast(row_number() over (order by count(*) desc, w) as integer)
    "rank" from {_ALL_TERMS} group by w order by 2 desc, 1 limit 1000"""


@query(_TOP)
def vocabulary_topk(spark, sf_dir):
    return frequent.frequent_terms(v.documents(spark, sf_dir), 1000)


@query(
    f"""select doc_id, w term, count(*) n
        from (select doc_id, unnest(regexp_extract_all(lower(text), '{TERM}')) w from documents)
        where w in (select term from ({_TOP})) group by all"""
)
def doc_term_counts(spark, sf_dir):
    docs = v.documents(spark, sf_dir)
    return topics.doc_term_counts(docs, v.vocab(spark, sf_dir, 1000), "doc_id")


@query(
    """select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as integer) topic_id,
              cast(list_max(embedding) as double) topic_confidence from embeddings"""
)
def topic_argmax(spark, sf_dir):
    vector = F.col("embedding")
    return v.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        scalar.argmax(vector).alias("topic_id"),
        F.array_max(vector).cast("double").alias("topic_confidence"),
    )


@query("select topic_id, place, term, weight from v_lda_top")
def lda_topics(spark, sf_dir):
    """Weights of the top terms of every fitted topic."""
    return v.model(spark, sf_dir).top_terms(spark)


@query(
    """select more, more = 0 fitted, cast(case when more = 0 then 2 else 0 end as integer) topics
       from (select unnest([0, 1]) more) where (select count(*) from documents) > 0"""
)
def topic_minimum(spark, sf_dir):
    """No model where one text more is asked for than there are."""
    docs, rows = v.documents(spark, sf_dir), []
    n = docs.count()
    for more in (0, 1):
        options = topics.TopicOptions(n_topics=2, max_features=50, passes=1, min_texts=n + more)
        model = topics.fit_topics(docs, options)
        rows.append((more, model is not None, 0 if model is None else model.n_topics))
    return spark.createDataFrame(rows, "more int, fitted boolean, topics int")


@query("select topic_id, place, term keyword from v_lda_top")
def topic_keywords(spark, sf_dir):
    found = v.model(spark, sf_dir).topics(spark)
    return found.select("topic_id", F.posexplode("topic_keywords").alias("place", "keyword"))


@query(
    """select doc_id, topic_id, list_max(shares) topic_confidence, array_to_string(topic_keywords, ',') topic_keywords
       from (select doc_id, shares, cast(list_position(shares, list_max(shares)) - 1 as integer) topic_id
             from v_lda_shares) join v_lda_topics using (topic_id)"""
)
def topic_assign(spark, sf_dir):
    assigned = v.model(spark, sf_dir).assign(v.documents(spark, sf_dir))
    keywords = F.concat_ws(",", "topic_keywords").alias("topic_keywords")
    return assigned.select("doc_id", "topic_id", "topic_confidence", keywords)


@query(
    f"""select topic_id, {_TOPIC_NAME} topic_name, array_to_string(topic_keywords, ',') topic_keywords,
               timestamp '2024-03-01 12:00:00' created_at, 'run' run_id from v_lda_topics"""
)
def topics_dimension(spark, sf_dir):
    found = v.model(spark, sf_dir).topics(spark, _RUN, "run")
    keywords = F.concat_ws(",", "topic_keywords").alias("topic_keywords")
    return found.select("topic_id", "topic_name", keywords, "created_at", "run_id")


@query(
    """select r.source, r.source_id, coalesce(array_to_string(t.topic_keywords, ','), '') keywords
       from v_results r left join v_topics t on r.topic_id = t.topic_id"""
)
def topic_keywords_lookup(spark, sf_dir):
    """Keywords by topic id; nothing for ids without a topic."""
    rows = v.topics(spark, sf_dir).orderBy("topic_id").collect()
    lookup = topics.TopicModel([], None, [list(r.topic_keywords) for r in rows], None)
    keywords = F.concat_ws(",", lookup.keywords_of(F.col("topic_id"))).alias("keywords")
    return v.results(spark, sf_dir).select("source", "source_id", keywords)


@query(f"select topic_id, {_TOPIC_NAME} topic_name from v_topics")
def topic_names(spark, sf_dir):
    return topics.topic_names(v.topics(spark, sf_dir))


@query(
    """select topic_id, array_to_string(topic_keywords[1:5], ',') first5,
              array_to_string(topic_keywords[1:10], ', ') first10 from v_topics"""
)
def keyword_prefix(spark, sf_dir):
    words = F.col("topic_keywords")
    return v.topics(spark, sf_dir).select(
        "topic_id",
        scalar.joined(words, 5).alias("first5"),
        scalar.joined(words, 10, ", ").alias("first10"),
    )


# --- Graph -------------------------------------------------------------------------

_MEANS = f"""(select topic_id, {mean('sentiment_compound')} m from v_results group by topic_id)"""


@query("select topic_id, keyword, score from v_terms")
def topic_terms(spark, sf_dir):
    return graph.topic_terms(v.topics(spark, sf_dir))


@query("select topic_id, keyword, score from v_terms where score >= 5")
def strong_terms(spark, sf_dir):
    return graph.strong_terms(graph.topic_terms(v.topics(spark, sf_dir)))


def _strong(spark, sf_dir):
    return graph.strong_terms(graph.topic_terms(v.topics(spark, sf_dir)))


def _nodes(spark, sf_dir):
    means = report.mean_by(v.results(spark, sf_dir), "topic_id")
    return graph.graph_nodes(_strong(spark, sf_dir), means)


@query(
    f"""select concat('Topic ', t.topic_id) id, 'topic' "type", coalesce(m.m, 0.0::double) sentiment
        from (select distinct topic_id from v_terms where score >= 5) t
        left join {_MEANS} m on t.topic_id = m.topic_id
        union all
        select distinct keyword, 'keyword', null::double from v_terms where score >= 5"""
)
def graph_nodes(spark, sf_dir):
    return _nodes(spark, sf_dir)


@query(
    """select concat('Topic ', topic_id) src, keyword dst, max(score) weight
       from v_terms where score >= 5 group by all"""
)
def graph_edges(spark, sf_dir):
    return graph.graph_edges(_strong(spark, sf_dir))


@query(
    "select keyword, "
    + ", ".join(
        f"max(score) filter (where topic_id = {i}) topic_{i}" for i in range(5)
    )
    + " from v_terms group by keyword"
)
def topic_keyword_matrix(spark, sf_dir):
    return graph.keyword_matrix(graph.topic_terms(v.topics(spark, sf_dir)), range(5))


@query(
    f"""select concat('Topic ', t.topic_id) id,
               (coalesce(m.m, 0.0::double) + 1) / 2.0::double normalized
        from (select distinct topic_id from v_terms where score >= 5) t
        left join {_MEANS} m on t.topic_id = m.topic_id"""
)
def normalized_topic_sentiment(spark, sf_dir):
    return graph.normalized_sentiment(_nodes(spark, sf_dir))


# --- Scalars -----------------------------------------------------------------------


@query(
    f"""select id, regexp_replace("text", {lit(f"^{SPACE}+|{SPACE}+$")}, '', 'g') stripped,
          coalesce(nullif(url, ''), title) url_or_title, substr("text", 1, 50) head50,
          substr("text", 1, 100) head100, printf('%.2f', score / 100.0::double) formatted,
          least(score, 100) clamped, created_utc::date::varchar created_date,
          (created_utc::date - 7)::varchar week_before, concat('Topic ', score) label,
          cast(epoch(created_utc) as bigint) epoch_seconds
        from (select id, text as "text", title, url, score, created_utc from v_posts)"""
)
def scalar_text_date(spark, sf_dir):
    created = F.to_date("created_utc")
    return v.posts(spark, sf_dir).select(
        "id",
        strip_space(F.col("text")).alias("stripped"),
        F.coalesce(F.nullif("url", F.lit("")), "title").alias("url_or_title"),
        F.substring("text", 1, 50).alias("head50"),
        F.substring("text", 1, 100).alias("head100"),
        F.format_string("%.2f", F.col("score") / 100.0).alias("formatted"),
        F.least("score", F.lit(100)).alias("clamped"),
        created.cast("string").alias("created_date"),
        F.date_sub(created, 7).cast("string").alias("week_before"),
        scalar.topic_label(F.col("score")).alias("label"),
        scalar.to_epoch(F.col("created_utc")).alias("epoch_seconds"),
    )
