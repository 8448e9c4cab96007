"""The sentiment rules on whole batches of texts, as array arithmetic.

Each distinct token is cut at its edges, lower-cased and looked up, once as long as the
process keeps it. It gets a number, and what the rules ask of it stands in arrays under that
number; tokens of which they ask the same share one, so the arrays are bounded by the word
lists and the table of tokens by ``KEPT_TOKENS``, however many texts there are. A batch is
then one array of numbers with row bounds; a word three places before is an index three less,
and each rule is a few operations over the places of all lexicon words of the batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa

#: Tokens whose numbers a process keeps; a full table is begun anew with the next run of texts.
KEPT_TOKENS = 1 << 17
#: Characters of text that are worked on together (a longer text by itself).
RUN_CHARS = 1 << 20

# Words that a rule names, in their own case or lower-cased.
_RAW_WORDS = {"so": 1, "this": 2, "never": 3}
_LOW_WORDS = {"least": 1, "at": 2, "very": 3, "kind": 4, "of": 5, "but": 6}


class PhraseTable:
    """Values of phrases of one length, looked up for arrays of word numbers."""

    def __init__(self, phrases: Mapping[str, float], words: Mapping[str, int], length: int):
        self._base = len(words) + 1
        known = {}
        for phrase, value in phrases.items():
            parts = phrase.split(" ")
            if len(parts) == length:
                known[self._key([np.int64(words[part]) for part in parts])] = value
        self._keys = np.array(sorted(known), np.int64)
        self._values = np.array([known[key] for key in self._keys.tolist()], np.float64)

    def _key(self, numbers: Sequence) -> np.ndarray:
        key = numbers[0]
        for number in numbers[1:]:
            key = key * self._base + number
        return key

    def of(self, numbers: Sequence[np.ndarray]) -> np.ndarray:
        """Each value, or NaN; number 0 is a word of no phrase, or no word at all."""
        found = np.full(len(numbers[0]), np.nan)
        some = np.flatnonzero(np.logical_and.reduce([number > 0 for number in numbers]))
        if len(self._keys) and len(some):
            key = self._key([number[some] for number in numbers])
            place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            hit = self._keys[place] == key
            found[some[hit]] = self._values[place[hit]]
        return found


class Tokens(dict):
    """Token as written -> its number; the arrays are looked up by number.

    The numbers stay when the table is begun anew.
    """

    FIELDS = ("valence", "boost", "negates", "caps", "raw", "low", "phrase")

    def __init__(self, entries: Mapping[str, Mapping], edges: tuple[str, frozenset[str]], phrase_words: Mapping[str, int]):
        super().__init__()
        self._entries, self._phrase_words = entries, phrase_words
        self._edged, self._ends = re.compile(edges[0]), edges[1]
        self._rows: dict[tuple, int] = {}
        self._arrays: dict[str, np.ndarray] = {}

    def __missing__(self, token: str) -> int:
        raw = token
        if token[-1] in self._ends or token[0] in self._ends:
            cut = self._edged.match(token)
            raw = (cut[1] or cut[2]) if cut else token
        low = raw.lower()
        entry = self._entries.get(low, {})
        row = (
            entry.get("v", np.nan),
            entry.get("b", np.nan),
            entry.get("n", False) or "n't" in low,
            raw.upper() == raw and low != raw,
            _RAW_WORDS.get(raw, 0),
            _LOW_WORDS.get(low, 0),
            self._phrase_words.get(raw, 0),
        )
        number = self._rows.setdefault(row, len(self._rows))
        if len(self) < KEPT_TOKENS:
            self[token] = number
        return number

    def arrays(self) -> dict[str, np.ndarray]:
        """One array per field over all numbers given so far."""
        have = len(self._arrays.get("valence", ()))
        if have < len(self._rows) or not self._arrays:
            kinds = (float, float, bool, bool, np.int8, np.int8, np.int64)
            columns = list(zip(*islice(self._rows, have, None))) or [()] * len(kinds)
            new = {name: np.array(values, kind) for name, values, kind in zip(self.FIELDS, columns, kinds)}
            old = self._arrays
            self._arrays = {name: np.concatenate([old[name], new[name]]) for name in new} if old else new
        return self._arrays

    def trim(self) -> None:
        if len(self) >= KEPT_TOKENS:
            self.clear()


class Kernel:
    """Scores batches with one lexicon. ``constants``: the method's numbers, by name."""

    def __init__(
        self,
        entries: Mapping[str, Mapping],
        boosters: Mapping[str, float],
        idioms: Mapping[str, float],
        edges: tuple[str, frozenset[str]],
        constants: Mapping[str, float],
    ):
        names = sorted({word for phrase in [*idioms, *boosters] if " " in phrase for word in phrase.split(" ")})
        words = {word: place for place, word in enumerate(names, 1)}
        self._tokens = Tokens(entries, edges, words)
        self._idioms = {n: PhraseTable(idioms, words, n) for n in (2, 3)}
        self._boosters = PhraseTable(boosters, words, 2)
        self._fixed = constants

    def scores(self, texts: Sequence[str | None]) -> dict[str, np.ndarray]:
        """compound, pos, neu and neg of each text; zeros where there is no token."""
        tokens = self._tokens
        tokens.trim()
        numbers: list[int] = []
        bounds = [0]
        for text in texts:
            numbers += [tokens[token] for token in (text or "").split() if len(token) > 1]
            bounds.append(len(numbers))
        sums = self._sums(np.array(numbers, np.int64), np.array(bounds))
        return self._shares(sums, np.diff(bounds), self._emphasis(texts))

    def _emphasis(self, texts: Sequence[str | None]) -> np.ndarray:
        fixed = self._fixed
        shouts = np.array([(text or "").count("!") for text in texts], np.int64)
        asks = np.array([(text or "").count("?") for text in texts], np.int64)
        some = np.where(asks <= 3, asks * round(fixed["question"] * 1_000_000), round(fixed["question_max"] * 1_000_000))
        shouted = np.minimum(shouts, fixed["exclamation_max"]) * round(fixed["exclamation"] * 1_000_000)
        return shouted + np.where(asks <= 1, 0, some)

    def _sums(self, number: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        """Sums of the adjusted valences of each row, in millionths."""
        field, rows = self._tokens.arrays(), len(bounds) - 1
        row = np.repeat(np.arange(rows), np.diff(bounds))
        hit = np.flatnonzero(~np.isnan(field["valence"][number]) & np.isnan(field["boost"][number]))
        low = field["low"][number]
        follows = np.append(low[1:], 0)
        last = np.zeros(len(number) + 1, bool)
        last[bounds[1:]] = True  # the place after a row's last one
        of = (follows == _LOW_WORDS["of"]) & ~last[1:]
        hit = hit[~((low[hit] == _LOW_WORDS["kind"]) & of[hit])]
        value = self._values(number, bounds, row, hit)
        add = lambda x: np.bincount(row[hit], x, rows).astype(np.int64)
        return {
            "total": add(value),
            "pos": add(np.where(value > 0, value + 1_000_000, 0)),
            "neg": add(np.where(value < 0, 1_000_000 - value, 0)),
            "hits": add(value != 0),
        }

    def _values(self, number: np.ndarray, bounds: np.ndarray, row: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Adjusted valence, in millionths, of the lexicon words at the places ``hit``."""
        field, fixed = self._tokens.arrays(), self._fixed
        place = hit - bounds[row[hit]]
        size = np.diff(bounds)[row[hit]]
        caps = field["caps"][number]
        shown = np.bincount(row, caps, len(bounds) - 1)
        mixed = ((shown > 0) & (shown < np.diff(bounds)))[row[hit]]

        def at(name: str, offset: int, missing):
            """A field of the words ``offset`` places on, or ``missing`` beyond the row."""
            inside = (place + offset >= 0) & (place + offset < size)
            here = np.where(inside, hit + offset, hit)
            return np.where(inside, field[name][number[here]], missing)

        def shift(offset: int, valence: np.ndarray) -> np.ndarray:
            toward = np.where(valence > 0, fixed["caps"], -fixed["caps"])
            return np.where(mixed & at("caps", offset, False), toward, 0.0)

        raw = {d: at("raw", -d, 0) for d in (1, 2, 3)}
        so = {d: (raw[d] == _RAW_WORDS["so"]) | (raw[d] == _RAW_WORDS["this"]) for d in (1, 2)}
        never = {d: raw[d] == _RAW_WORDS["never"] for d in (2, 3)}
        valence = field["valence"][number[hit]]
        valence = valence + shift(0, valence)
        for distance in (1, 2, 3):
            boost = at("boost", -distance, np.nan)
            boost = (np.where(valence < 0, -boost, boost) + shift(-distance, valence)) * fixed["damping"][distance - 1]
            factor = np.where(at("negates", -distance, False), fixed["negate"], 1.0)
            if distance == 2:
                factor = np.where(never[2] & so[1], 1.5, factor)
            if distance == 3:
                factor = np.where((never[3] & so[2]) | so[1], 1.25, factor)
            changed = (valence + np.where(np.isnan(boost), 0.0, boost)) * factor
            if distance == 3:
                changed = self._phrased(changed, lambda offset: at("phrase", offset, 0))
            applies = (place >= distance) & np.isnan(at("valence", -distance, np.nan))
            valence = np.where(applies, changed, valence)

        least = (at("low", -1, 0) == _LOW_WORDS["least"]) & np.isnan(at("valence", -1, np.nan))
        before = at("low", -2, 0)
        excused = (before == _LOW_WORDS["at"]) | (before == _LOW_WORDS["very"])
        valence = valence * np.where(least & ~excused, fixed["negate"], 1.0)
        return np.floor(valence * self._contrast(number, bounds, row, hit) * 1_000_000 + 0.5)

    def _phrased(self, valence: np.ndarray, word: Callable[[int], np.ndarray]) -> np.ndarray:
        """Valence of the phrase around each place, where there is one."""
        words = {offset: word(offset) for offset in range(-3, 3)}
        value = np.full(len(valence), np.nan)
        for around in ((0, 1, 2), (0, 1), (-1, 0), (-2, -1, 0), (-2, -1), (-3, -2, -1), (-3, -2)):
            found = self._idioms[len(around)].of([words[offset] for offset in around])
            value = np.where(np.isnan(value), found, value)
        value = np.where(np.isnan(value), valence, value)
        damped = [~np.isnan(self._boosters.of([words[a], words[b]])) for a, b in ((-3, -2), (-2, -1))]
        return np.where(damped[0] | damped[1], value - self._fixed["boost"], value)

    def _contrast(self, number: np.ndarray, bounds: np.ndarray, row: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Less weight before a row's first "but", more after it."""
        but = np.flatnonzero(self._tokens.arrays()["low"][number] == _LOW_WORDS["but"])
        first = np.full(len(bounds) - 1, -1)
        first[row[but][::-1]] = but[::-1]
        at = first[row[hit]]
        plain = (at < 0) | (hit == at)
        return np.where(plain, 1.0, np.where(hit < at, self._fixed["but_before"], self._fixed["but_after"]))

    def _shares(self, sums: dict[str, np.ndarray], tokens: np.ndarray, amp: np.ndarray) -> dict[str, np.ndarray]:
        total, pos, neg = sums["total"], sums["pos"], sums["neg"]
        s = (total + np.sign(total) * amp) / 1_000_000.0
        pos, neg = pos + np.where(pos > neg, amp, 0), neg + np.where(pos < neg, amp, 0)
        neu = (tokens - sums["hits"]) * 1_000_000
        some = tokens > 0
        whole = np.where(some, pos + neg + neu, 1).astype(np.float64)
        compound = np.clip(s / np.sqrt(s * s + float(self._fixed["normalizer"])), -1.0, 1.0)
        found = {"compound": np.floor(compound * 10_000 + 0.5) / 10_000.0}
        for name, part in (("pos", pos), ("neu", neu), ("neg", neg)):
            found[name] = np.floor(part / whole * 1000 + 0.5) / 1000.0
        return {name: np.where(some, values, 0.0) for name, values in found.items()}


def runs(texts: Sequence[str | None]) -> Iterator[Sequence[str | None]]:
    """Runs of whole texts of about ``RUN_CHARS``."""
    start = size = 0
    for place, text in enumerate(texts):
        size += len(text or "")
        if size >= RUN_CHARS:
            yield texts[start : place + 1]
            start, size = place + 1, 0
    if start < len(texts):
        yield texts[start:]


def score_column(kernel: Kernel, column: pa.Array) -> pa.StructArray:
    """A column of texts as a column of structs."""
    names = ("compound", "pos", "neu", "neg")
    found = [kernel.scores(some) for some in runs(column.to_pylist())]
    empty = np.empty(0)
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate([empty, *(part[name] for part in found)])) for name in names], names=names
    )
