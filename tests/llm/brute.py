"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_windows(rows: list[tuple[int | None, str | None]], window: int = 20) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) per row; a null doc_id comes first."""
    first: dict[tuple, tuple] = {}
    texts = [(doc, WORD.findall(text or "")) for doc, text in rows]
    age = [(-1 << 63) if doc is None else doc for doc, _ in texts]
    for own, (_, words) in zip(age, texts):
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            first[key] = min(first.get(key, (own, at)), (own, at))
    result = []
    for own, (doc, words) in zip(age, texts):
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < (own, at):
                gone |= set(range(at, at + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        result.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return result


def byte_repeats(rows: list[tuple[int | None, str | None]], size: int = 400) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row."""
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(t[i : i + size] for _, t in texts for i in range(len(t) - size + 1))
    result = []
    for doc, text in texts:
        gone = bytearray(len(text))
        until = 0
        for i in range(len(text) - size + 1):
            if seen[text[i : i + size]] > 1:
                for k in range(max(i, until), i + size):
                    gone[k] = 1
                until = i + size
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        result.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for k in range(len(words) - 2):
        if seen[tuple(words[k : k + 3])] > 1:
            repeated |= {k, k + 1, k + 2}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def shingles(text: str | None, size: int = 5) -> frozenset:
    """Sets of ``size`` words; a shorter text with words is one shingle."""
    words = WORD.findall(text or "")
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def jaccard_classes(rows: list[tuple[int, str | None]], least: float = 0.8) -> dict[int, tuple[int, int]]:
    """doc_id -> (smallest doc_id of its class, number of rows it is linked to)."""
    sets = [(doc, shingles(text)) for doc, text in rows]
    parent = {doc: doc for doc, _ in sets}
    links = Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and len(x & y) >= least * len(x | y):
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc: (root(doc), links[doc]) for doc, _ in sets}


def secrets(text: str | None) -> tuple[int, int, int, str]:
    """n_assign, n_access, n_hex, base_sha256."""
    text = text or ""
    found = []
    names = "|".join("".join(f"[{c.lower()}{c.upper()}]" for c in n) for n in ("password", "passwd", "secret", "token"))
    names += "|[aA][pP][iI]_?[kK][eE][yY]"
    rule = rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(rule, text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    found.sort()
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found)
    counts = [sum(k == kind for _, k, _ in found) for kind in range(3)]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def edit_distance_within(pattern: str, text: str) -> int:
    """Fewest edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
