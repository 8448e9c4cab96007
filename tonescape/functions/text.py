"""Text expressions: whitespace, tokens, tags and entities. All stay in the JVM."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything the analyzer's host language treats as whitespace.
SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Fixed value: a term is two or more letters, digits or underscores.
LETTER = r"[\p{L}\p{N}_]"
TERM = LETTER + "{2,}"
WORD = LETTER + "+"

#: Named references of the HTML standard, from Python's own copy of its table.
NAMED = {name: char for name, char in html5.items() if name.endswith(";")}
#: Numbers 128 to 159 stand for Windows-1252 characters where it has one.
LATIN = {i: bytes([i]).decode("cp1252") for i in range(128, 160) if i not in (129, 141, 143, 144, 157)}

_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def terms(text: Column) -> Column:
    """Lower-cased terms of a text, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def words(text: Column) -> Column:
    """Lower-cased words of any length, for keyword search."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def title_of(text: Column) -> Column:
    return F.split_part(text, F.lit("\n"), F.lit(1))


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def drop_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]*>", "")


def _numbered(piece: Column) -> Column:
    """The character behind ``&#8217;`` or ``&#x2019;``, with any number of digits."""
    digits = F.regexp_extract(piece, r"&#[xX]?0*([0-9a-fA-F]*);", 1)
    is_hex = F.lower(F.substring(piece, 3, 1)) == "x"
    code = F.when(
        F.length(digits) <= 7,
        F.when(is_hex, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("int"),
    )
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")
    latin = F.from_json(F.lit(json.dumps([LATIN.get(i) for i in range(128, 160)])), "array<string>")
    char = F.when(code.between(128, 159), F.coalesce(F.get(latin, code - 128), char)).otherwise(char)
    return F.when(F.coalesce(valid, F.lit(False)), char).otherwise(F.lit("\ufffd"))


def decode_entities(text: Column) -> Column:
    """Replace HTML character references, each once; unknown names stay as written."""
    pieces = F.regexp_extract_all(text, F.lit(f"{_REFERENCE}|[^&]+|&"), F.lit(0))
    named = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")

    def decode(piece: Column) -> Column:
        name = F.substring(piece, 2, 1 << 30)
        is_reference = (F.substring(piece, 1, 1) == "&") & (F.length(piece) > 2)
        return (
            F.when(~is_reference, piece)
            .when(F.substring(piece, 2, 1) == "#", _numbered(piece))
            .otherwise(F.coalesce(F.try_element_at(named, name), piece))
        )

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decode), "")).otherwise(text)
