"""Rule-based sentiment of a text as one column.

The method is the published one for short social texts (Hutto and Gilbert, ICWSM
2014): a valence lexicon, adjusted by up to three preceding tokens (boosters and
negations), emphasis by capitals and punctuation, and a contrast word.

The column is narrow: it needs no row key, no shuffle and no second pass over the texts, so
scoring a feed costs one scan of it. The rules run on batches of texts (``sentiment_batch``);
the lexicon travels with the task, which is why its size is checked.

All sums are integers (millionths of a valence point), so a score does not depend
on the order of additions.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescape.functions.sentiment_batch import Kernel, score_column
from tonescape.functions.text import SPACE

# Fixed values of the published method.
BOOST = 0.293
CAPS = 0.733
NEGATE = -0.74
BUT_BEFORE = 0.5
BUT_AFTER = 1.5
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
NORMALIZER = 15
EXCLAMATION = 0.292
EXCLAMATION_MAX = 4
QUESTION = 0.18
QUESTION_MAX = 0.96

# Words that raise the intensity of what follows.
BOOST_UP = """
absolutely amazingly awfully completely considerably decidedly deeply effing
enormously entirely especially exceptionally extremely fabulously flipping flippin
fricking frickin frigging friggin fully fucking greatly hella highly hugely
incredibly intensely majorly more most particularly purely quite really remarkably
so substantially thoroughly totally tremendously uber unbelievably unusually utterly
very
""".split()

# Words and pairs that lower it.
BOOST_DOWN = [
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof",
    "kind-of", "less", "little", "marginally", "occasionally", "partly", "scarcely",
    "slightly", "somewhat", "sort of", "sorta", "sortof", "sort-of",
]

# Negations. Any token with "n't" inside negates as well.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't
didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't
haven't isn't mightn't mustn't neednt needn't never none nope nor not nothing nowhere
oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't
without wont wouldnt won't wouldn't rarely seldom despite
""".split()

# Phrases with a valence of their own.
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# Punctuation that is cut from one end of a word.
EDGE_MARKS = [
    ".", "!", "?", ",", ";", ":", "-", "'", '"', "!!", "!!!", "??", "???", "?!?", "!?!",
    "?!?!", "!?!?",
]

#: Most entries a lexicon may have: it is shipped to every task, so its size is checked.
MAX_ENTRIES = 200_000

@dataclass(frozen=True)
class Rules:
    """Word lists of the method; the defaults are the published ones."""

    boosters: Mapping[str, float] = field(
        default_factory=lambda: {w: BOOST for w in BOOST_UP} | {w: -BOOST for w in BOOST_DOWN}
    )
    negations: Sequence[str] = tuple(NEGATIONS)
    idioms: Mapping[str, float] = field(default_factory=lambda: dict(IDIOMS))


class Lexicon:
    """Valence, booster and negation entries, ready to be used in an expression."""

    def __init__(self, valences: Mapping[str, float], rules: Rules | None = None):
        self.rules = rules or Rules()
        entries: dict[str, dict] = {}
        for token, valence in valences.items():
            entries.setdefault(token, {})["v"] = float(valence)
        for token, boost in self.rules.boosters.items():
            entries.setdefault(token, {})["b"] = float(boost)
        for token in self.rules.negations:
            entries.setdefault(token, {})["n"] = True
        if len(entries) > MAX_ENTRIES:
            raise ValueError(f"a lexicon may have at most {MAX_ENTRIES} entries")
        self.entries = entries
        stated = [sorted(part.items()) for part in (entries, self.rules.boosters, self.rules.idioms)]
        self._name = hashlib.sha256(json.dumps(stated).encode()).hexdigest()

    def kernel(self) -> Kernel:
        """The process's kernel for this lexicon."""
        if self._name not in _kernels:
            _kernels[self._name] = Kernel(
                self.entries, self.rules.boosters, self.rules.idioms, (_EDGED, _ENDS), _CONSTANTS
            )
        return _kernels[self._name]

    @classmethod
    def from_table(cls, table: DataFrame, rules: Rules | None = None) -> Lexicon:
        """Read ``(token, valence)`` rows; the size is checked before they are kept."""
        rows = table.select("token", "valence").limit(MAX_ENTRIES + 1).collect()
        if len(rows) > MAX_ENTRIES:
            raise ValueError(f"a lexicon may have at most {MAX_ENTRIES} entries")
        return cls({r.token: r.valence for r in rows}, rules)


_kernels: dict[str, Kernel] = {}

_CONSTANTS = {
    "boost": BOOST, "caps": CAPS, "negate": NEGATE, "but_before": BUT_BEFORE, "but_after": BUT_AFTER,
    "damping": DISTANCE_DAMPING, "normalizer": NORMALIZER, "exclamation": EXCLAMATION,
    "exclamation_max": EXCLAMATION_MAX, "question": QUESTION, "question_max": QUESTION_MAX,
}

_MARKS = "|".join(re.escape(m) for m in sorted(EDGE_MARKS, key=len, reverse=True))
_PUNCT = r"!-/:-@\[-`{-~"
_EDGED = rf"^(?:([^{_PUNCT}]{{2,}})(?:{_MARKS})|(?:{_MARKS})([^{_PUNCT}]{{2,}}))$"
_ENDS = frozenset(m[-1] for m in EDGE_MARKS)


def tokens(text: str) -> Column:
    """Tokens of the method in order and in their own case, for a column name or a SQL expression.

    Single characters are dropped, and one mark is cut from either end of a word.
    """
    words = F.filter(F.split(F.expr(text), f"{SPACE}+"), lambda t: F.length(t) > 1)
    return F.transform(words, lambda t: F.regexp_replace(t, _EDGED, "$1$2"))


def score(text: str, lexicon: Lexicon) -> Column:
    """``struct<compound,pos,neu,neg>`` of a text; zeros for null and empty texts.

    ``text`` is a column name or a SQL expression.
    """

    @F.arrow_udf("struct<compound:double,pos:double,neu:double,neg:double>")
    def batch(column: pa.Array) -> pa.Array:
        return score_column(lexicon.kernel(), column)

    return batch(F.expr(text))
