"""The fixture views in SQL, composed into one statement per query."""

from __future__ import annotations

import re

from fixtures.views import CUES, STOP_WORDS
from tonescape.functions.sentiment import (
    BOOST_DOWN,
    BOOST_UP,
    EDGE_MARKS,
    IDIOMS,
    NEGATIONS,
)
from tonescape.functions.text import SPACE, TERM


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(str(c) for c in row) + ")" for row in rows)


def decoded(html: str) -> str:
    """Text of an HTML piece: tags dropped, the references that occur in the pages replaced."""
    text = f"regexp_replace({html}, '<[^>]*>', '', 'g')"
    # Fixed values, stated apart from the engine's table.
    for name, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        text = f"replace({text}, {lit(name)}, {lit(char)})"
    return text


def _cued() -> str:
    text = "text"
    for old, new in CUES:
        text = f"replace({text}, {lit(old)}, {lit(new)})"
    return text


_marks = "|".join(re.escape(m) for m in sorted(EDGE_MARKS, key=len, reverse=True))
_edged = rf"^(?:([^[:punct:]]{{2,}})(?:{_marks})|(?:{_marks})([^[:punct:]]{{2,}}))$"

VIEWS: dict[str, str] = {
    "v_posts": """
        select cast(doc_id as varchar) id, split_part(text, chr(10), 1) title, text,
               timestamp '2024-01-01 00:00:00' + to_minutes(doc_id) created_utc,
               cast(n_chars % 1000 as integer) score,
               cast(n_chars % 37 as integer) num_comments,
               case when doc_id % 10 = 0 then ''
                    else concat('https://x.example/', cast(doc_id as varchar)) end url,
               lang author, source subreddit, 'reddit' source, doc_id seq
        from documents""",
    "v_tweets": """
        select conv_id * 100 + turn id, text,
               timestamp '2024-01-01 00:00:00' + to_minutes(conv_id * 10 + turn) created_at,
               conv_id % 1500 user_id, cast(null as varchar) user_name,
               cast(null as bigint) user_followers,
               length(text) % 7 retweet_count, length(text) % 11 reply_count,
               length(text) % 13 like_count, length(text) % 17 quote_count,
               cast(null as varchar) location, cast(null as varchar) keyword,
               'twitter' source, conv_id * 100 + turn seq
        from conversations""",
    "v_headlines": rf"""
        select trim({decoded('m')}) title,
               url, case when page_id % 2 = 0 then 'bbc' else 'cnn' end source,
               regexp_extract(url, 'https?://[^/]+/([a-z]+)/', 1) category,
               timestamp '2024-01-02 00:00:00' + to_minutes(page_id) extracted_at,
               page_id seq
        from (select page_id, url, unnest(regexp_extract_all(html, '(?s)<h1\b[^>]*>.*?</h1>')) m
              from pages)""",
    "v_vocab": f"""
        select w term, n, row_number() over (order by n desc, w) rnk
        from (select w, count(*) n
              from (select unnest(regexp_extract_all(lower(text), '{TERM}')) w from documents)
              group by w order by n desc, w limit 400)""",
    "v_lexicon": """
        select term token,
               cast((length(term) * 7 + ascii(term)) % 41 - 20 as double) / 10 valence
        from v_vocab
        where term ~ '^[a-z]{3,}$' and (length(term) * 7 + ascii(term)) % 41 <> 20""",
    "v_topics": """
        select cast((rnk - 1) % 5 as integer) topic_id, list(term order by rnk) topic_keywords,
               timestamp '2024-01-01 00:00:00' created_at
        from v_vocab where rnk <= 50 group by 1""",
    "v_feed": """
        select 'reddit' source, coalesce(nullif(url, ''), title) source_id, title as text,
               created_utc created_at, seq from v_posts
        union all
        select 'twitter', cast(id as varchar), text, created_at, seq from v_tweets
        union all
        select 'news', concat('news_', cast(row_number() over (order by seq) as varchar)),
               title, extracted_at, seq from v_headlines""",
    "v_feed_texts": "select concat(source, ':', cast(seq as varchar)) k, text as t from v_feed",
    "v_doc_texts": "select doc_id k, text as t from documents",
    "v_cued_texts": f"select doc_id k, {_cued()} as t from documents",
    "v_unified": """
        select f.source, f.source_id, f.text, f.created_at,
               s.compound sentiment_compound, s.pos sentiment_positive,
               s.neu sentiment_neutral, s.neg sentiment_negative,
               timestamp '2024-01-01 00:00:00' + to_days(cast(f.seq % 30 as integer))
                 + to_minutes(f.seq % 1440) processed_at,
               f.seq
        from v_feed f join v_feed_scores s on s.k = concat(f.source, ':', cast(f.seq as varchar))""",
    "v_assignment": """
        select * from (
          select text, feed, seq, topic_id, topic_confidence, topic_keywords,
                 row_number() over (partition by text order by feed desc, seq desc) rn
          from (select a.*, t.topic_keywords
                from (select title as text, 0 feed, seq, cast(seq % 5 as integer) topic_id,
                             cast(seq % 50 + 50 as double) / 100 topic_confidence from v_posts
                      union all
                      select title, 1, seq, cast(seq % 5 as integer),
                             cast(seq % 50 + 50 as double) / 100 from v_headlines) a
                join v_topics t using (topic_id)))
        where rn = 1""",
    "v_results": """
        select u.source, u.source_id, u.text, u.created_at, u.sentiment_compound,
               u.sentiment_positive, u.sentiment_neutral, u.sentiment_negative, u.processed_at,
               u.seq, coalesce(a.topic_id, -1) topic_id,
               coalesce(a.topic_confidence, 0.0::double) topic_confidence,
               case when a.topic_id is null then 'Unknown'
                    else array_to_string(a.topic_keywords[1:5], ',') end topic_keywords
        from v_unified u left join v_assignment a on u.text = a.text""",
    "v_days": """
        select * from v_results where processed_at >= timestamp '2024-01-05 00:00:00'
          and processed_at <= timestamp '2024-01-20 23:59:59'""",
    "v_by_source": """
        select source, topic_id, count(*) n from v_results
        where source is not null and topic_id is not null group by all""",
    "v_terms": """
        select topic_id, unnest(topic_keywords[1:10]) keyword,
               cast(11 - generate_subscripts(topic_keywords[1:10], 1) as integer) score
        from v_topics""",
    "v_entries": f"""
        select coalesce(l.token, c.token) token, l.valence v, c.boost b,
               coalesce(c.negates, false) n
        from v_lexicon l full join
             (select token, max(boost) boost, bool_or(negates) negates
              from (values {values(
                  [(lit(w), "0.293::double", "false") for w in BOOST_UP]
                  + [(lit(w), "-0.293::double", "false") for w in BOOST_DOWN]
                  + [(lit(w), "null", "true") for w in NEGATIONS])}) c(token, boost, negates)
              group by token) c on l.token = c.token""",
    "v_idioms": f"""
        select * from (values {values(
            [(lit(k), f"{v}::double") for k, v in IDIOMS.items()])}) i(phrase, value)""",
}


def mean(column: str) -> str:
    """Mean through an integer sum of millionths."""
    return (
        f"cast(sum(cast(floor({column} * 1000000 + 0.5::double) as bigint)) as double)"
        f" / 1000000.0::double / count({column})"
    )


def _never(distance: int) -> str:
    plain = f"case when n{distance} then -0.74::double else 1.0::double end"
    if distance == 1:
        return plain
    near = "coalesce(r1 in ('so', 'this'), false)"
    if distance == 2:
        return f"case when r2 = 'never' and {near} then 1.5::double else {plain} end"
    far = "coalesce(r3 = 'never' and r2 in ('so', 'this'), false)"
    return f"case when {far} or {near} then 1.25::double else {plain} end"


def _step(distance: int) -> str:
    d, before = distance, f"x{distance - 1}"
    damping = ["1.0", "0.95", "0.9"][d - 1]
    shift = f"""coalesce(((case when {before} < 0 then -b{d} else b{d} end)
        + (case when mixed and c{d} then (case when {before} > 0 then 0.733::double
                else -0.733::double end) else 0.0::double end)) * {damping}::double,
        0.0::double)"""
    changed = f"({before} + {shift}) * ({_never(d)})"
    return f"(i > {d} and v{d} is null)", changed


def _idiom(changed: str) -> tuple[str, str]:
    """Joins and value for phrases around a token."""
    seqs = {
        "a": "r0 || ' ' || f1 || ' ' || f2",
        "b": "r0 || ' ' || f1",
        "c": "r1 || ' ' || r0",
        "d": "r2 || ' ' || r1 || ' ' || r0",
        "e": "r2 || ' ' || r1",
        "f": "r3 || ' ' || r2 || ' ' || r1",
        "g": "r3 || ' ' || r2",
    }
    joins = "\n".join(
        f"left join v_idioms p{n} on p{n}.phrase = {seq}" for n, seq in seqs.items()
    )
    value = f"coalesce({', '.join(f'p{n}.value' for n in seqs)}, {changed})"
    pairs = ", ".join(lit(w) for w in BOOST_DOWN if " " in w)
    dampened = f"coalesce(r3 || ' ' || r2 in ({pairs}), false) or " \
               f"coalesce(r2 || ' ' || r1 in ({pairs}), false)"
    return joins, f"case when {dampened} then {value} - 0.293::double else {value} end"


def scoring(name: str, source: str) -> dict[str, str]:
    """Views that score ``source(k, t)``; the last one is ``name``."""
    p = name + "_"
    step1, step2, (applies3, changed3) = _step(1), _step(2), _step(3)
    joins, idiom = _idiom(changed3)
    lags = ", ".join(
        f"lag(raw, {d}) over w r{d}, lag(low, {d}) over w l{d}, lag(v, {d}) over w v{d}, "
        f"lag(b, {d}) over w b{d}, lag(caps, {d}) over w c{d}, "
        f"coalesce(lag(neg, {d}) over w, false) n{d}"
        for d in (1, 2, 3)
    )
    amp = f"""least(length(t) - length(replace(t, '!', '')), 4) * 292000
        + case when length(t) - length(replace(t, '?', '')) <= 1 then 0
               when length(t) - length(replace(t, '?', '')) <= 3
               then (length(t) - length(replace(t, '?', ''))) * 180000
               else 960000 end"""
    rounded = lambda x, d: f"floor({x} * {10**d} + 0.5::double) / {10**d}"
    return {
        p + "raw": f"""
            select k, unnest(l) raw0, generate_subscripts(l, 1) i
            from (select k, list_filter(string_split_regex(t, {lit(SPACE + "+")}),
                                        lambda x: length(x) > 1) l
                  from {source})""",
        p + "tok": f"""
            select k, i, raw, lower(raw) low, upper(raw) = raw and lower(raw) <> raw caps
            from (select k, i, regexp_replace(raw0, {lit(_edged)}, '\\1\\2') raw
                  from {p}raw)""",
        p + "hit": f"""
            select t.*, e.v, e.b, coalesce(e.n, false) or contains(low, 'n''t') neg
            from {p}tok t left join v_entries e on t.low = e.token""",
        p + "ctx": f"""
            select k, i, raw r0, low l0, v v0, b b0, caps c0, {lags},
                   lead(raw, 1) over w f1, lead(raw, 2) over w f2, lead(low, 1) over w fl1,
                   bool_or(caps) over (partition by k)
                     and bool_or(not caps) over (partition by k) mixed,
                   min(case when low = 'but' then i end) over (partition by k) but_at
            from {p}hit window w as (partition by k order by i)""",
        p + "x0": f"""
            select *, v0 + case when mixed and c0
                then (case when v0 > 0 then 0.733::double else -0.733::double end)
                else 0.0::double end x0
            from {p}ctx
            where v0 is not null and b0 is null and not coalesce(l0 = 'kind' and fl1 = 'of', false)""",
        p + "x1": f"select *, case when {step1[0]} then {step1[1]} else x0 end x1 from {p}x0",
        p + "x2": f"select *, case when {step2[0]} then {step2[1]} else x1 end x2 from {p}x1",
        p + "x3": f"""
            select x.*, case when {applies3} then {idiom} else x2 end x3
            from {p}x2 x {joins}""",
        p + "val": f"""
            select k, cast(floor(x3
                * (case when l1 = 'least' and v1 is null
                         and not coalesce(i > 2 and l2 in ('at', 'very'), false)
                   then -0.74::double else 1.0::double end)
                * (case when but_at is null or i = but_at then 1.0::double
                        when i < but_at then 0.5::double else 1.5::double end)
                * 1000000 + 0.5::double) as bigint) m
            from {p}x3""",
        p + "sum": f"""
            select d.k, cast({amp} as bigint) amp, coalesce(c.n, 0) n,
                   coalesce(s.total, 0) total, coalesce(s.pos, 0) pos, coalesce(s.neg, 0) neg,
                   coalesce(c.n, 0) - coalesce(s.hits, 0) neutral
            from {source} d
            left join (select k, count(*) n from {p}raw group by k) c on c.k = d.k
            left join (select k, cast(sum(m) as bigint) total,
                              cast(sum(case when m > 0 then m + 1000000 else 0 end) as bigint) pos,
                              cast(sum(case when m < 0 then 1000000 - m else 0 end) as bigint) neg,
                              count(*) filter (where m <> 0) hits
                       from {p}val group by k) s on s.k = d.k""",
        p + "all": f"""
            select k, n, cast(total + case when total > 0 then amp when total < 0 then -amp
                         else 0 end as double) / 1e6::double s,
                   pos + case when pos > neg then amp else 0 end pos,
                   neg + case when pos < neg then amp else 0 end neg,
                   neutral * 1000000 neu
            from {p}sum""",
        name: f"""
            select k,
                   case when n > 0 then {rounded("least(1.0::double, greatest(-1.0::double, s / sqrt(s * s + 15.0::double)))", 4)} else 0.0::double end compound,
                   case when n > 0 then {rounded("cast(pos as double) / cast(pos + neg + neu as double)", 3)} else 0.0::double end pos,
                   case when n > 0 then {rounded("cast(neu as double) / cast(pos + neg + neu as double)", 3)} else 0.0::double end neu,
                   case when n > 0 then {rounded("cast(neg as double) / cast(pos + neg + neu as double)", 3)} else 0.0::double end neg
            from {p}all""",
    }


VIEWS |= scoring("v_feed_scores", "v_feed_texts")
VIEWS |= scoring("v_doc_scores", "v_doc_texts")
VIEWS |= scoring("v_cued_scores", "v_cued_texts")



def lda(topics: int = 5, terms: int = 1000, passes: int = 10, rounds: int = 3, seed: int = 30) -> dict[str, str]:
    """The topic-term matrix over documents: one view per round; the last is ``v_lda_matrix``.

    Fixed values, stated apart from the engine: the unit of a million, the priors of 0.1 for
    topics and 0.01 for terms, and the uneven first counts.
    """
    each = range(topics)
    counts = ", ".join(f"cast((w * {i + 1} * 7919 + {seed} * 104729) % 1009 + 100 as bigint) c{i}" for i in each)
    unit, share, term = "1000000.0::double", 100_000, 10_000
    found = {
        "v_lda_terms": f"""
            select term, row_number() over (order by term) w from (
              select w term, count(*) n
              from (select unnest(regexp_extract_all(lower(text), '{TERM}')) w from documents)
              where w not in ({", ".join(map(lit, STOP_WORDS))})
              group by w order by n desc, w limit {terms})""",
        "v_lda_n": f"""
            select doc_id d, w, cast(count(*) as double) n
            from (select doc_id, unnest(regexp_extract_all(lower(text), '{TERM}')) term from documents)
                 join v_lda_terms using (term)
            group by doc_id, w""",
        "v_lda_m0": f"select w, {counts} from v_lda_terms",
        "v_lda_s": "select doc_id d, " + ", ".join(f"1.0::double / {topics} t{i}" for i in each) + " from documents",
    }
    sums = ", ".join(f"cast(sum(x{i}) as bigint) c{i}" for i in each)
    known = ", ".join(f"coalesce(c{i}, 0) c{i}" for i in each)

    def shares(parts: str) -> str:
        total = " + ".join(f"coalesce(c{i}, 0)" for i in each)
        rows = ", ".join(
            f"cast(coalesce(c{i}, 0) + {share} as double) / cast({total} + {topics * share} as double) t{i}" for i in each
        )
        return f"""select doc_id d, {rows} from documents
            left join (select d, {sums} from {parts} group by d) on d = doc_id"""

    for step in range(passes + 1):
        weights = ", ".join(
            f"cast(c{i} + {term} as double) / cast(sum(c{i}) over () + {term} * count(*) over () as double) p{i}" for i in each
        )
        found[f"v_lda_p{step}"] = f"select w, {weights} from v_lda_m{step}"
        before = "v_lda_s"
        for turn in range(1, rounds + 1):
            name = f"v_lda_x{step}_{turn}"
            likely = ", ".join(f"t{i} * p{i} q{i}" for i in each)
            whole = " + ".join(f"q{i}" for i in each)
            parts = ", ".join(f"cast(floor(n * {unit} * (q{i} / ({whole})) + 0.5::double) as bigint) x{i}" for i in each)
            found[name] = f"""select d, w, {parts}
                from (select d, w, n, {likely} from v_lda_n join v_lda_p{step} using (w) join {before} using (d))"""
            before = f"v_lda_t{step}_{turn}"
            found[before] = shares(name)
        if step < passes:
            found[f"v_lda_m{step + 1}"] = f"""
                select w, {known} from v_lda_terms left join (
                  select w, {sums} from v_lda_x{step}_{rounds} group by w) using (w)"""
    best = " union all ".join(
        f"""select {i} topic_id, cast(row_number() over (order by c{i} desc, w) - 1 as integer) place, term, p{i} weight
            from v_lda_m{passes} join v_lda_p{passes} using (w) join v_lda_terms using (w)
            qualify row_number() over (order by c{i} desc, w) <= 10"""
        for i in each
    )
    found["v_lda_top"] = f"select cast(topic_id as integer) topic_id, place, term, weight from ({best})"
    found["v_lda_topics"] = "select topic_id, list(term order by place) topic_keywords from v_lda_top group by topic_id"
    found["v_lda_shares"] = f"""
        select d doc_id, [{", ".join(f"t{i}" for i in each)}] shares from v_lda_t{passes}_{rounds}"""
    return found


VIEWS |= lda()

_NAME = re.compile(r"\bv_[a-z0-9_]+")


def statement(select: str) -> str:
    """``select`` with the views it needs, in order, as common table expressions."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(select)
    if not needed:
        return select
    ctes = ",\n".join(f"{name} as materialized ({VIEWS[name]})" for name in needed)
    return f"with {ctes}\n{select}"
