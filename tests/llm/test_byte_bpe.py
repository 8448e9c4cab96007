"""Byte-level BPE against the tokenizer library, and round trips."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tonescape.llm import byte_bpe, queries

SF_DIR = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.codec(PATH, PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = queries.QUERIES["op13_byte_bpe"](spark, SF_DIR).collect()
    expected = {d: library.encode_ordinary(t) for d, t in texts.items()}
    assert sorted(tuple(r) for r in got) == sorted(
        (d, len(expected[d]), sha(packed(expected[d])), sha(t.encode())) for d, t in texts.items()
    )


def test_hard(frame, hard_rows, library):
    rows = [*hard_rows, (20, "<|endoftext|> as text", "a"), (21, "ab" * 9000, "a"), (22, "x" * 5000 + " " * 3000, "a")]
    got = byte_bpe.encode(frame(rows), PATH, PATTERN)
    assert got.columns == [*frame(rows).columns, "token_ids"]
    found = [(r.doc_id, r.text, r.source, bytes(r.token_ids)) for r in got.collect()]
    expected = [(d, t, s, packed(library.encode_ordinary(t or ""))) for d, t, s in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    back = byte_bpe.decode(got, PATH, PATTERN, out="found").select("text", "found").collect()
    assert all(bytes(r.found) == (r.text or "").encode() for r in back)
    assert byte_bpe.digests(frame([]), PATH, PATTERN).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aabcdeing   \n\t'sthe0123éß日本!<>|😀\x1c\x85"), max_size=150), max_size=4))
def test_any_text(library, texts):
    codec = byte_bpe.codec(PATH, PATTERN)
    ids = codec.encode(texts)
    assert ids == [packed(library.encode_ordinary(t)) for t in texts]
    assert codec.decode(ids) == [t.encode() for t in texts]


@pytest.mark.parametrize("piece", [b"ab", b"x" * 65, b"ing" * 100, b"the" * 21 + b"t", bytes(range(256))])
def test_one_tree_and_many_agree(library, piece):
    codec = byte_bpe.codec(PATH, PATTERN)
    size = 1 << (len(piece) - 1).bit_length()
    together = byte_bpe.merge_together([piece, piece[:2], piece], size, codec._byte_id, codec._pairs)
    assert together[0] == together[2] == packed(byte_bpe.merge(piece, codec.ranks))


def test_least_is_leftmost():
    tree = byte_bpe.LeftmostMin([5, 3, 9, 3, 3])
    assert (tree.least(), tree.place()) == (3, 1)
    tree.put(1, 7)
    assert tree.place() == 3
    tree.put(3, 8)
    tree.put(4, 8)
    assert (tree.least(), tree.place()) == (5, 0)


def test_bounded_pieces_and_cache(library, monkeypatch):
    codec = byte_bpe.Codec(PATH, PATTERN)
    texts = [" ".join(f"w{i}q{i * i}" for i in range(n)) for n in (0, 1, 30, 400)]
    monkeypatch.setattr(byte_bpe, "PIECES", 40)
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 50)
    assert codec.encode(texts) == [packed(library.encode_ordinary(t)) for t in texts]
