"""Headlines from landed HTML pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescape import schemas
from tonescape.functions.scalar import ntz
from tonescape.functions.text import decode_entities, non_empty, strip_space
from tonescape.operators.ranking import first_per_group
from tonescape.session import option_table


@dataclass(frozen=True)
class Profile:
    """How one site marks a headline, and where its link is.

    A headline is an element ``tag`` whose ``attribute`` is ``value`` (any element of that name
    where ``attribute`` is None). A class is a list of words, so ``value`` must be one of them;
    other attributes must be ``value`` as a whole. Both are compared as written, names of
    elements and attributes without regard to case. ``link`` says whose href counts: ``self``,
    ``parent`` (only if it is an ``a``) or ``grandparent`` (whatever it is).
    """

    tag: str
    attribute: str | None = None
    value: str | None = None
    link: str = "self"


# The marks of the two sites.
PARENT_LINK = Profile("h2", "data-testid", "card-headline", "parent")
GRANDPARENT_LINK = Profile("span", "class", "container__headline-text", "grandparent")

PROFILES = {"bbc": PARENT_LINK, "cnn": GRANDPARENT_LINK}

# Categories that can be asked for.
ALLOWED = {"cnn": ["world", "business", "politics"]}
DEFAULT_CATEGORIES = {
    "bbc": ["news", "business", "innovation"],
    "cnn": ["news", "world", "politics"],
}

# Elements without content.
_VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]

# What stands between texts: comments, declarations, scripts and styles whole, and tags, whose
# names with a slash for closing ones are group 1.
_MARKUP = (
    r"<!--.*?(?:-->|$)|<[!?][^>]*>|(?i:<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>)"
    r"|<(/?[A-Za-z][^\s/>]*)(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
)
# A piece is one of those, or a stray <, with the text up to the next one.
_PIECE = rf"(?s)(?:{_MARKUP}|<)[^<]*+"
_OWN_MARKUP = rf"(?s)^(?:{_MARKUP})"

# Attributes in their order: name and value, or a quoted text that belongs to no name.
_ATTRIBUTES = r"(?s)\"[^\"]*\"|'[^']*'|([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?"
_TAG_ATTRIBUTES = r"(?s)^<[A-Za-z][^\s/>]*((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of an opening tag, null where it has none.

    The tag's attributes are read in order, so a name inside another one's value is not taken.
    Of repeated ones the last counts; one without a value is empty.
    """

    def last(inner: Column) -> Column:
        names = F.transform(F.regexp_extract_all(inner, F.lit(_ATTRIBUTES), F.lit(1)), F.lower)
        values = F.regexp_extract_all(inner, F.lit(_ATTRIBUTES), F.lit(2))
        found = F.filter(F.arrays_zip(names.alias("n"), values.alias("v")), lambda x: x["n"] == name.lower())
        value = F.try_element_at(found, F.lit(-1))["v"]
        quoted = F.substring(value, 1, 1).isin('"', "'")
        return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)

    return _let(F.regexp_extract(tag, _TAG_ATTRIBUTES, 1), last)


def _is_headline(piece: Column, profile: Profile) -> Column:
    if profile.attribute is None:
        return F.lit(True)
    value = attribute(piece, profile.attribute)
    if profile.attribute.lower() == "class":
        return F.coalesce(F.array_contains(F.split(value, r"\s+"), profile.value), F.lit(False))
    return F.coalesce(value == profile.value, F.lit(False))


def _events(profile: Profile) -> Column:
    """Tags that open or close an element, with their place among the pieces."""
    skipped = ["", "script", "style", *_VOID]

    def event(name: Column, place: Column) -> Column:
        own = F.coalesce(F.lower(name) == profile.tag.lower(), F.lit(False))
        marked = F.when(own, _is_headline(F.get("_pieces", place), profile)).otherwise(False)
        return F.struct(F.lower(name).alias("name"), place.alias("place"), marked.alias("marked"))

    return F.filter(F.transform("_names", event), lambda x: ~x["name"].isin(skipped))


def _walk(events: Column, profile: Profile) -> Column:
    """Headlines of a page: the pieces where each begins and ends, and that of its link.

    The walk keeps the names and places of the elements that are open. A closing tag closes
    its innermost open element and all within; others are ignored. A headline inside another
    one is part of it.
    """
    up = {"self": 0, "parent": 1, "grandparent": 2}[profile.link]
    found_type = "array<struct<first:int,last:int,link:int>>"
    none = F.lit(None).cast("int")

    def state(names, places, until, first, link, found) -> Column:
        parts = {"names": names, "places": places, "until": until, "first": first, "link": link, "found": found}
        return F.struct(*[value.alias(name) for name, value in parts.items()])

    def opened(s: Column, x: Column) -> Column:
        names, places = F.concat(s["names"], F.array(x["name"])), F.concat(s["places"], F.array(x["place"]))
        link = F.get(places, F.size(places) - 1 - up)
        if profile.link == "parent":
            link = F.when(F.get(names, F.size(names) - 2) == "a", link)
        begins = x["marked"] & (s["until"] == 0)
        return F.when(begins, state(names, places, F.size(names), x["place"], link, s["found"])).otherwise(
            state(names, places, s["until"], s["first"], s["link"], s["found"])
        )

    def closed(s: Column, x: Column) -> Column:
        above = F.array_position(F.reverse(s["names"]), F.substring(x["name"], 2, 1 << 30)).cast("int")

        def cut(above: Column) -> Column:
            left = F.size(s["names"]) - above
            names, places = F.slice(s["names"], 1, left), F.slice(s["places"], 1, left)
            ended = F.struct(s["first"].alias("first"), x["place"].alias("last"), s["link"].alias("link"))
            ends = (s["until"] > 0) & (left < s["until"])
            return (
                F.when(above == 0, s)
                .when(ends, state(names, places, F.lit(0), F.lit(0), none, F.concat(s["found"], F.array(ended))))
                .otherwise(state(names, places, s["until"], s["first"], s["link"], s["found"]))
            )

        return _let(above, cut)

    start = state(
        F.array().cast("array<string>"), F.array().cast("array<int>"), F.lit(0), F.lit(0), none, F.array().cast(found_type)
    )
    marked = F.when(F.exists(events, lambda x: x["marked"]), events)  # nothing to walk for without one
    return F.aggregate(
        marked, start, lambda s, x: F.when(F.startswith(x["name"], F.lit("/")), closed(s, x)).otherwise(opened(s, x))
    )


def _headlines(last: Column) -> Column:
    """Title and link of all headlines of a walk, one that the page's end closes included."""
    open_one = F.struct(last["first"].alias("first"), F.size("_pieces").alias("last"), last["link"].alias("link"))
    found = F.when(last["until"] > 0, F.concat(last["found"], F.array(open_one))).otherwise(last["found"])

    def text(x: Column) -> Column:
        inside = F.slice("_pieces", x["first"] + 1, x["last"] - x["first"])
        return F.array_join(F.transform(inside, lambda p: F.regexp_replace(p, _OWN_MARKUP, "")), "")

    return F.transform(
        found,
        lambda x: F.struct(
            text(x).alias("title"), attribute(F.get("_pieces", x["link"]), "href").alias("link")
        ),
    )


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schemas.PAGES).format(fmt).load(path)


def extract_headlines(pages: DataFrame, profile: Profile, extracted_at=None) -> DataFrame:
    """Every headline of every page, in page order: a narrow pass over the pages."""
    kept = [c for c in pages.columns if c != "html"]
    # Pages without the mark, in whatever case, are not walked.
    likely = F.contains(F.lower("html"), F.lit((profile.value or f"<{profile.tag}").lower()))
    pieces, names = (F.regexp_extract_all("html", F.lit(_PIECE), F.lit(group)) for group in (0, 1))
    found = (
        pages.where(likely)
        .select(*kept, pieces.alias("_pieces"), names.alias("_names"))
        .select(*kept, "_pieces", _events(profile).alias("_events"))
        .select(*kept, "_pieces", _walk(F.col("_events"), profile).alias("_last"))
        .select(*kept, _headlines(F.col("_last")).alias("_found"))
    )
    # The outer form, because for the inner one Spark would walk each page once more to see
    # whether it has any headline.
    items = found.select(*kept, F.posexplode_outer("_found").alias("position", "_item"))
    return items.where(F.col("position").isNotNull()).select(
        *kept,
        "position",
        strip_space(decode_entities(F.col("_item.title"))).alias("title"),
        non_empty(decode_entities(F.col("_item.link"))).alias("url"),
        ntz(extracted_at).alias("extracted_at"),
    )


def _category_table(spark: SparkSession, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    rows = [(s, c) for s, listed in categories.items() for c in listed]
    return option_table(spark, rows, "source string, category string")


def keep_categories(headlines: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows whose (source, category) is listed; unknown categories give nothing."""
    wanted = _category_table(headlines.sparkSession, categories)
    return headlines.join(wanted, ["source", "category"], "left_semi")


def keep_allowed(
    headlines: DataFrame, allowed: Mapping[str, Sequence[str]] = ALLOWED
) -> DataFrame:
    """Sources with a list of allowed categories are held to it; others pass."""
    listed = keep_categories(headlines, allowed)
    free = headlines.filter(~F.coalesce(F.col("source").isin(list(allowed)), F.lit(False)))
    return free.unionByName(listed)


def list_headlines(
    headlines: DataFrame,
    categories: Mapping[str, Sequence[str]] | None = None,
    limit_per_source: int = 20,
    order: Sequence[str] = ("page_id", "position"),
    allowed: Mapping[str, Sequence[str]] = ALLOWED,
) -> DataFrame:
    """The first headlines of every wanted (source, category), in page order."""
    wanted = {
        source: [c for c in listed if source not in allowed or c in allowed[source]]
        for source, listed in (categories or DEFAULT_CATEGORIES).items()
    }
    return first_per_group(
        keep_categories(headlines, wanted),
        ["source", "category"],
        [F.col(c) for c in order],
        limit_per_source,
    )


def extract_all(
    pages: DataFrame,
    categories: Mapping[str, Sequence[str]] | None = None,
    limit_per_source: int = 20,
    extracted_at=None,
) -> DataFrame:
    """Headlines of all sources with their own profiles, limited per category."""
    parts = [
        extract_headlines(pages.filter(F.col("source") == source), profile, extracted_at)
        for source, profile in PROFILES.items()
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return list_headlines(found, categories, limit_per_source)
