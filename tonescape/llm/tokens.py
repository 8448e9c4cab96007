"""Token ids of whole texts as bytes, from a public byte-level BPE vocabulary file.

Texts are cut into words by the vocabulary's own rule, and each distinct word is encoded
once per process: most words of a corpus are repeats. Ids are kept as little-endian
unsigned 32-bit bytes, so a text's ids are one join of its words' bytes.
"""

from __future__ import annotations

import json
import re

import tiktoken

# The word rule of this vocabulary family, and its printable stand-ins for
# bytes (the visible Latin-1 characters stand for themselves, the others follow from 256).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

# The same rule for texts of plain characters only, where letters, digits and white space
# are short lists; Python's own pattern engine is much faster on those.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ƿǀ-ɏ"
_PLAIN = re.compile(rf"[\t-\r -~¡-±´-¸º»¿-ɏ]*")
_PLAIN_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"
)

#: Distinct words kept per process; beyond that the table is begun anew.
CACHED_WORDS = 400_000

_encoders: dict[str, WordBytes] = {}


class WordBytes(dict):
    """Word -> its ids as bytes, filled on demand."""

    def __init__(self, path: str):
        super().__init__()
        hidden = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
        byte_of = {hidden.get(b, chr(b)): b for b in range(256)}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        self._four = [i.to_bytes(4, "little") for i in range(max(ranks.values()) + 1)]
        self._bpe = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self._pack(self._bpe._encode_single_piece(word))
        if len(word) <= 64:
            self[word] = value
        return value

    def _pack(self, ids: list[int]) -> bytes:
        return b"".join([self._four[i] for i in ids])

    def encode(self, text: str) -> bytes:
        """The text's ids; strings of special tokens are ordinary text."""
        if _PLAIN.fullmatch(text):
            return b"".join([self[word] for word in _PLAIN_WORDS.findall(text)])
        return self._pack(self._bpe.encode_ordinary(text))


def encoder(path: str) -> WordBytes:
    """The process's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = WordBytes(path)
    return _encoders[path]
