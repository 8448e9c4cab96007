"""Hand-made texts for every rule, with scores worked out from the rules."""

import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tonescape.functions import sentiment_batch
from tonescape.functions.sentiment import Lexicon, Rules, score, tokens
from tonescape.sources.lexicon import read_lexicon

WORDS = {
    "great": 3.1, "good": 1.9, "happy": 2.7, "love": 3.2, "bad": -2.5, "terrible": -2.1,
    "kind": 2.4, "mustard": 0.5, "hot": 1.0,
}


@pytest.fixture(scope="module")
def scored(spark):
    lexicon = Lexicon(WORDS)

    def run(*texts):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
        rows = frame.select("i", score("text", lexicon).alias("s")).orderBy("i").collect()
        return [tuple(r.s) for r in rows]

    return run


def compound(valence):
    return math.floor(valence / math.sqrt(valence * valence + 15) * 10_000 + 0.5) / 10_000


def test_nothing_to_score(scored):
    assert scored(None, "", "   ", "a b c") == [(0.0, 0.0, 0.0, 0.0)] * 4


def test_no_hit_is_neutral(scored):
    assert scored("plain words here", "!!!") == [(0.0, 0.0, 1.0, 0.0)] * 2


VALENCES = [
    ("good", 1.9),
    ("bad", -2.5),
    ("not good", 1.9 * -0.74),
    ("isn't good", 1.9 * -0.74),
    ("not xx good", 1.9 * -0.74),
    ("not xx yy good", 1.9 * -0.74),
    ("not xx yy zz good", 1.9),
    ("very good", 1.9 + 0.293),
    ("very xx good", 1.9 + 0.293 * 0.95),
    ("very xx yy good", 1.9 + 0.293 * 0.9),
    ("very bad", -2.5 - 0.293),
    ("barely good", 1.9 - 0.293),
    ("not very good", (1.9 + 0.293) * -0.74),
    ("xx GOOD", 1.9 + 0.733),
    ("XX GOOD", 1.9),
    ("xx VERY good", 1.9 + 0.293 + 0.733),
    ("xx BAD", -2.5 - 0.733),
    ("least good", 1.9 * -0.74),
    ("at least good", 1.9),
    ("xx least good", 1.9 * -0.74),
    ("never so good", (1.9 + 0.293) * 1.5),
    ("never this good", 1.9 * 1.5),
    ("never so xx good", (1.9 + 0.293 * 0.95) * 1.25),
    ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("good!", 1.9 + 0.292),
    ("good good!!!!", 1.9 + 4 * 0.292),
    ("good good!!!!!!", 1.9 + 4 * 0.292),
    ("good xx?", 1.9),
    ("good xx??", 1.9 + 2 * 0.18),
    ("good xx?????", 1.9 + 0.96),
    ("bad!", -2.5 - 0.292),
    ("kind of", 0.0),
    ("kind", 2.4),
    # Four marks are no known ending, so the word stays unknown.
    ("xx good!!!!", 0.0),
]


def test_valence(scored):
    got = scored(*[text for text, _ in VALENCES])
    want = [compound(valence) for _, valence in VALENCES]
    for (text, _), score_, value in zip(VALENCES, got, want):
        assert score_[0] == pytest.approx(value, abs=2e-4), text


def test_idioms(scored):
    (value,) = scored("they can cut the mustard")
    assert value[0] == pytest.approx(compound(2.0), abs=2e-4)


def test_edge_marks(spark):
    frame = spark.createDataFrame(
        [("a great, 'day' \"good x. (bad) ok?? don't can't! wow!!!! é, ünï.",)], "text string"
    )
    assert frame.select(tokens("text").alias("t")).first().t == [
        "great", "'day'", "good", "x.", "(bad)", "ok", "don't", "can't!", "wow!!!!", "é,", "ünï",
    ]


def test_properties(scored):
    texts = ["good", "not good", "good bad great", "so happy but terrible!", "x good"] * 3
    for compound_, pos, neu, neg in scored(*texts):
        assert -1 <= compound_ <= 1
        assert pos + neu + neg == pytest.approx(1, abs=2e-3)
    plain, negated = scored("good", "not good")
    assert plain[0] > 0 > negated[0]


def test_column_names_do_not_clash(spark):
    lexicon = Lexicon(WORDS)
    for name in ("raw", "t", "i", "doc", "amp"):
        frame = spark.createDataFrame([("good",)], f"{name} string")
        assert frame.select(score(name, lexicon).alias("s")).first().s.compound == compound(1.9)


def test_own_rules(spark):
    lexicon = Lexicon({"good": 1.0}, Rules(boosters={"o'so": 1.0}, negations=["nah"], idioms={}))
    frame = spark.createDataFrame([("o'so good",), ("nah good",), ("very good",)], "text string")
    got = [r.c for r in frame.select(score("text", lexicon).compound.alias("c")).collect()]
    assert got == [compound(2.0), compound(-0.74), compound(1.0)]


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    lines = ["good\t1.9\t0.9\t[2, 1]", ":'(\t-2.2\t0.7\t[-2]", '"x\t1.5', "\\o/\t2.2\t1.1\t[1]", "bad"]
    path.write_text("\n".join(lines) + "\n")
    table = read_lexicon(spark, str(path))
    assert {r.token: r.valence for r in table.collect()} == {
        "good": 1.9, ":'(": -2.2, '"x': 1.5, "\\o/": 2.2,
    }
    frame = spark.createDataFrame([("xx :'(",), ("xx \\o/",)], "text string")
    lexicon = Lexicon.from_table(table)
    got = [r.c for r in frame.select(score("text", lexicon).compound.alias("c")).collect()]
    assert got == [compound(-2.2), compound(2.2)]


def test_lexicon_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr("tonescape.functions.sentiment.MAX_ENTRIES", 3)
    table = spark.range(5).select(
        F.col("id").cast("string").alias("token"), F.lit(1.0).alias("valence")
    )
    with pytest.raises(ValueError, match="at most 3"):
        Lexicon.from_table(table)


def test_scoring_does_not_shuffle(spark):
    frame = spark.range(10).select(F.lit("good").alias("text"))
    frame = frame.select(score("text", Lexicon(WORDS)))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_batches_do_not_change_scores(spark, scored, monkeypatch):
    """Short runs, one partition per text and a small token table give the same scores."""
    texts = [text for text, _ in VALENCES] + ["", None, "they can cut the mustard", "the kind of good"] * 3
    whole = scored(*texts)
    kernel = Lexicon(WORDS).kernel()
    monkeypatch.setattr(sentiment_batch, "RUN_CHARS", 5)
    monkeypatch.setattr(sentiment_batch, "KEPT_TOKENS", 3)
    parts = sentiment_batch.score_column(kernel, pa.array(texts, pa.string())).to_pylist()
    assert [tuple(p[n] for n in ("compound", "pos", "neu", "neg")) for p in parts] == whole
    assert len(sentiment_batch.score_column(kernel, pa.array([], pa.string()))) == 0


def test_rules_stop_at_the_ends_of_texts(scored):
    """A word of the text before or after is not a neighbour."""
    assert scored("good", "xx not", "good", "very", "good of", "kind", "of good")[2] == scored("good")[0]
    assert scored("kind", "of")[0][0] == compound(2.4)
    assert scored("xx but", "good")[1][0] == compound(1.9)
    assert scored("cut the", "mustard")[1][0] == compound(0.5)


PHRASES = [
    ("this is the bomb good", 3.0),
    ("this is the BOMB good", 1.9),
    ("the bomb good", 1.9),  # fewer than three words before it
    ("oh yeah right good", -2.0),
    ("xx kind of good", 1.9 - 0.293),
    ("xx sort of xx good", 1.9 - 0.293),
    ("xx yy good ass", 1.9),
    ("xx yy zz bad ass", 1.5),
]


def test_phrases_of_words(scored):
    for (text, value), got in zip(PHRASES, scored(*[text for text, _ in PHRASES])):
        assert got[0] == pytest.approx(compound(value), abs=2e-4), text


def test_token_table_is_bounded(monkeypatch):
    """Neither the table nor the arrays grow with distinct tokens, and no score changes."""
    lexicon = Lexicon({"good": 1.5, "bad": -2.0})
    texts = [f"w{i}a W{i}B very GOOD x{i}, not bad but y{i}! good" for i in range(3000)]
    expected = lexicon.kernel().scores(texts)
    monkeypatch.setattr(sentiment_batch, "KEPT_TOKENS", 100)
    kernel = Lexicon({"good": 1.5, "bad": -2.0, "other": 1.0}).kernel()
    for start in range(0, len(texts), 500):
        got = kernel.scores(texts[start : start + 500])
        assert all((got[name] == expected[name][start : start + 500]).all() for name in expected)
        assert len(kernel._tokens) <= 100 and len(kernel._tokens.arrays()["valence"]) < 50
