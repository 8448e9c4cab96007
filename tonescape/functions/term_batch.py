"""Terms of blocks of texts by array arithmetic on their bytes: for passes that need counts.

The terms are those of ``functions.text.terms``. The engine lower-cases; which characters make a
term is asked of its own pattern, once per session, and kept as a table of code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tonescape.functions.text import LETTER

#: Bytes of text that are worked on together; a longer text is worked on by itself.
BLOCK = 1 << 20
#: Bytes of a character by its first one.
_WIDTH = np.repeat([1, 2, 3, 4], [0xC0, 0x20, 0x10, 0x10])

_letters: dict[str, np.ndarray] = {}


def letters(spark: SparkSession) -> np.ndarray:
    """For each code point: is it a letter of a term?"""
    app = spark.sparkContext.applicationId
    if app not in _letters:
        char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        points = spark.range(0x110000).filter(~F.col("id").between(0xD800, 0xDFFF))
        table = np.zeros(0x110000, bool)
        table[points.filter(char.rlike(f"^{LETTER}$")).toArrow()["id"].to_numpy()] = True
        _letters[app] = table
    return _letters[app]


def _in_terms(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 texts belong to letters of a term."""
    mine = table[data]
    high = np.flatnonzero(data >= 0x80)
    mine[high] = False
    lead = high[data[high] >= 0xC0]
    size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
    point = data[lead] & (0xFF >> (size + 1))
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        point[more] = point[more] << 6 | data[lead[more] + k] & 0x3F
    met = table[point]
    lead, size = lead[met], size[met]
    for k in range(4):
        mine[lead[size > k] + k] = True
    return mine


def find_terms(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of lower-cased UTF-8 texts, in order, and how many each text has."""
    mine = _in_terms(data, table)
    # Terms of neighbouring texts do not touch.
    filled = np.diff(bounds) > 0
    opens, closes = mine.copy(), mine.copy()
    opens[1:] &= ~mine[:-1]
    closes[:-1] &= ~mine[1:]
    edge = bounds[:-1][filled]
    opens[edge] = mine[edge]
    edge = bounds[1:][filled] - 1
    closes[edge] = mine[edge]
    first, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = end - first > _WIDTH[data[first]]
    short, size = first[~long], (end - first)[~long]
    for k in range(4):
        mine[short[size > k] + k] = False
    first, end = first[long], end[long]
    ends = np.append(0, np.cumsum(end - first)).astype(np.int32)
    found = pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(data[mine]))
    return found, np.diff(np.searchsorted(first, bounds))


def text_blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``BLOCK`` bytes, as bytes and bounds; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + BLOCK, side="right")) - 1)
        yield data[bounds[start] : bounds[end]], bounds[start : end + 1] - bounds[start]
        start = end


def block_counts(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct terms of a block of texts and how often each occurs."""
    found = find_terms(data, bounds, table)[0].dictionary_encode()
    return found.dictionary, np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))


def block_places(data: np.ndarray, bounds: np.ndarray, table: np.ndarray, vocab: pa.Array) -> list[pa.Array]:
    """Lists of each text's terms of ``vocab``, as their places in it, ascending, and of how often they occur."""
    found, n = find_terms(data, bounds, table)
    found = found.dictionary_encode()
    place = pc.index_in(found.dictionary, value_set=vocab).fill_null(-1).to_numpy()[found.indices.to_numpy()]
    met = place >= 0
    key = np.repeat(np.arange(len(n)), n)[met] * max(len(vocab), 1) + place[met]
    key.sort()
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    row, place = np.divmod(key[new], max(len(vocab), 1))
    ends = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(n)))).astype(np.int32))
    times = np.diff(np.append(new, len(key)))
    return [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (place, times)]


def packed_letters(spark: SparkSession) -> bytes:
    """``letters`` as it is sent to tasks."""
    return np.packbits(letters(spark)).tobytes()


def unpacked(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)


def counts(batches: Iterator[pa.RecordBatch], packed: bytes) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """``block_counts`` of all blocks of a column of lower-cased texts."""
    table = unpacked(packed)
    for batch in batches:
        for data, bounds in text_blocks(batch.column(0)):
            yield block_counts(data, bounds, table)
