"""The article of a web page, by two passes of rules over its text blocks.

A page is cut into blocks at block-level tags. The first pass decides what it can from a
block alone: where it stands, its length, the share of its characters inside links and the
share of stop words among its words. The second pass gives every block left open (short,
or with few stop words) the label of its nearest decided neighbours; the edges of an
article element count as good neighbours.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML's elements by role, and frequent function words of four languages.
_RAW = {"script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "textarea", "title", "head"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section",
    "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_CONTAINERS = {"article", "body", "div", "main", "section", "td"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_BAD = {"nav", "footer", "aside", "form", "menu", "button", "select", "fieldset", "dialog", "label"}
_BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog"}
_BAD_NAME = re.compile(
    r"(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|user|reader|post|article)[-_]?)?"
    r"(?:ads?|adv|advert\w*|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?|cookie-?consent|notices?|consent|gdpr|"
    r"alert|newsletters?|subscribe|subscription|signup|login|search|sidebar|side-bar|aside|menus?|nav|navbar|navigation|"
    r"topnav|breadcrumbs?|footer|foot|header|masthead|toolbar|share|sharing|social|related|recommended|recommendations?|"
    r"popup|modal|overlay|widgets?|pagination|pager|tags?|toc|copyright)"
    r"(?:[-_](?:ads?|area|banner|bar|block|body|box|button|buttons|column|container|content|form|icons|inner|items?|label|"
    r"left|links?|list|main|menu|message|modal|module|nav|notices?|outer|overlay|panel|popup|posts|right|section|sidebar|slot|stories|"
    r"text|title|top|unit|widgets?|wrap|wrapper|\d+))*",
    re.IGNORECASE,
)
_COMMENT_NAME = re.compile(
    r"(?:(?:site|page|user|reader|post|article)[-_]?)?(?:comments?|commentlist|disqus|replies|respond|discussion)"
    r"(?:[-_](?:area|block|body|box|container|content|form|inner|items?|list|section|text|thread|title|wrap|wrapper|\d+))*",
    re.IGNORECASE,
)
_STOP_WORDS = [
    frozenset(words.split())
    for words in (
        "the of and a to in is was he for it with as his on be at by i this had not are but from or have an "
        "they which one you were her all she there would their we him been has when who will more no if out "
        "so said what up its about into than them can only other",
        "le la les de des du un une et en est que qui dans pour sur au aux pas plus par ne se ce cette il elle "
        "on nous vous ils avec sont son sa ses mais ou comme tout être fait",
        "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus "
        "er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war",
        "el la los las de del y en que un una es por con no se su para al lo como más o pero sus le ha me si "
        "sin sobre este ya entre cuando todo esta ser son dos",
    )
]

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
#: One whole attribute, so that a name inside another's name or value is not taken for one.
_ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>\"'][^\s>]*)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass(frozen=True)
class BlockRules:
    """Limits of the first pass: characters of short and of long blocks, the share of
    characters in links from which a block is bad, and the share of stop words that prose
    has at least."""

    short: int = 70
    long: int = 200
    link_density: float = 0.4
    stop_density: float = 0.2


@dataclass
class Block:
    text: str
    in_links: int
    heading: bool
    #: Number of the enclosing article or main element, 0 if none.
    article: int
    #: In a part that is never the article.
    outside: bool
    #: Number of the nearest enclosing container.
    container: int
    #: Number of the outermost enclosing element that only its name speaks against, 0 if none.
    named: int = 0
    #: In an article element whose name speaks against it.
    named_article: bool = False


def _is_bad(tag: str, attributes: str, in_article: bool) -> str:
    """What speaks against an element: "part" for certain, its "name", or nothing.

    Names are compared whole, word by word. A header within an article is not judged by them.
    """
    if tag in _BAD or tag == "header" and not in_article:
        return "part"
    if not attributes or tag in ("html", "body", "main"):
        return ""
    found = ""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            if tag == "header" and in_article:
                continue
            words = value.split()
            if any(_COMMENT_NAME.fullmatch(word) for word in words):
                return "part"
            if any(_BAD_NAME.fullmatch(word) for word in words):
                found = "name"
        elif name == "role":
            if value.lower() in _BAD_ROLES:
                return "part"
        elif name == "aria-hidden":
            if value.lower() == "true":
                return "part"
        elif name == "style":
            if _HIDDEN.search(value):
                return "part"
        elif name == "hidden":
            if not value or value.lower() == "hidden":
                return "part"
    return found


@dataclass(slots=True)
class _Open:
    """An open element, with what holds inside it, so that no question walks the stack."""

    tag: str
    bad: bool
    outside: bool
    named: int
    article: int
    container: int
    block: str
    named_article: bool


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order. The time is in proportion to the page."""
    found: list[Block] = []
    stack = [_Open("", False, False, 0, 0, 0, "", False)]  # the page itself stays
    is_open: Counter[str] = Counter()
    text: list[str] = []
    in_links = link = 0
    articles = containers = names = 0

    def close_block() -> None:
        nonlocal in_links
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            top = stack[-1]
            heading = top.block in _HEADINGS
            found.append(
                Block(joined, in_links, heading, top.article, top.outside, top.container, top.named, top.named_article)
            )
        text.clear()
        in_links = 0

    def pop() -> None:
        is_open[stack.pop().tag] -= 1

    at, size = 0, len(page)
    while at < size:
        match = _TOKEN.search(page, at)
        piece = page[at : match.start()] if match else page[at:]
        if piece:
            text.append(piece)
            if link:
                in_links += len(piece)
        if not match:
            break
        at = match.end()
        tag = match[2] or match[5]
        if not tag:
            continue
        tag, closing = tag.lower(), match[1] or match[4]
        attributes = match[3] or match[6] or ""
        if tag in _RAW:
            if not closing and not attributes.endswith("/"):
                end = "body" if tag == "head" else tag
                until = re.compile(rf"</{tag}\s*>|<{end}\b" if tag == "head" else rf"</{tag}\s*>", re.IGNORECASE)
                stop = until.search(page, at)
                if stop:
                    at = stop.start() if tag == "head" and not stop[0].startswith("</") else stop.end()
                elif tag != "head":
                    at = size
            text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
        elif tag in _BLOCK:
            close_block()
        if tag in _VOID:
            continue
        if tag == "a":
            link = 0 if closing else 1
        if closing:
            if is_open[tag]:
                while stack[-1].tag != tag:
                    pop()
                pop()
                link = link and int(is_open["a"] > 0)
            continue
        if tag in _BLOCK:
            while stack[-1].tag and stack[-1].tag not in _BLOCK and not stack[-1].bad:
                pop()  # inline elements left open
                link = 0
            last = stack[-1].tag
            if last == "p" or tag in ("li", "dt", "dd", "option", "tr", "td", "th") and last == tag:
                pop()
        top = stack[-1]
        bad = _is_bad(tag, attributes, top.article > 0)
        article, container, named = top.article, top.container, top.named
        named_article = top.named_article
        if tag == "article" and bad == "name":
            bad, named_article = "", True
        if tag in ("article", "main") and not bad:
            articles += 1
            article = articles
        if tag in _CONTAINERS:
            containers += 1
            container = containers
        if bad == "name" and not named:
            names += 1
            named = names
        if not attributes.endswith("/") or tag in _BLOCK or tag == "a":
            outside = top.outside or bad == "part"
            block = tag if tag in _BLOCK else top.block
            stack.append(_Open(tag, bool(bad), outside, named, article, container, block, named_article))
            is_open[tag] += 1
    close_block()
    return _judge_names(found)


def _judge_names(found: list[Block]) -> list[Block]:
    """Elements that only their name speaks against are no part of the article, unless one
    holds more than half of the page's prose. Article elements go by their name only if all
    those together have less text outside links than one long block."""
    prose: Counter[int] = Counter()
    if any(block.named for block in found):
        for block in found:
            if not block.outside and len(block.text) >= BlockRules.long and 2 * block.in_links < len(block.text):
                if stop_density(block.text) >= BlockRules.stop_density:
                    prose[block.named] += len(block.text)
        total = sum(prose.values())
        for block in found:
            block.outside = block.outside or bool(block.named) and 2 * prose[block.named] <= total
    if any(block.named_article for block in found):
        inside = [block for block in found if block.named_article and not block.outside]
        if sum(len(block.text) for block in inside if 2 * block.in_links < len(block.text)) < BlockRules.long:
            for block in inside:
                block.outside = True
    return found


def stop_density(text: str) -> float:
    """Share of stop words, in the language in which it is highest."""
    words = re.findall(r"\w+", text.lower())
    if not words:
        return 0.0
    return max(sum(w in stops for w in words) for stops in _STOP_WORDS) / len(words)


def _ends_as_prose(text: str) -> bool:
    return text.rstrip("\"')»”").endswith((".", "!", "?", "…", ":"))


def first_pass(block: Block, rules: BlockRules) -> str:
    """good, bad, near (prose but not long) or short."""
    if block.outside:
        return "bad"
    size = len(block.text)
    if block.in_links > rules.link_density * size:
        return "links" if block.article else "bad"
    if size < rules.short or block.heading:
        return "short"
    if stop_density(block.text) >= rules.stop_density:
        return "good" if size >= rules.long or block.article or _ends_as_prose(block.text) else "near"
    if block.article or _ends_as_prose(block.text):
        return "short"
    return "bad"


def _sides(labels: list[str], where: list[int]) -> dict[int, list[tuple[int, str] | None]]:
    """For each block of ``where``, distance and label of the decided ones next to it."""
    found: dict[int, list[tuple[int, str] | None]] = {i: [None, None] for i in where}
    for side, order in ((0, where), (1, where[::-1])):
        label, distance = "", 0
        for i in order:
            distance += 1
            if label:
                found[i][side] = (distance, label)
            if labels[i] in ("good", "bad"):
                label, distance = labels[i], 0
    return found


def second_pass(found: list[Block], labels: list[str]) -> list[bool]:
    """Whether each block is kept; open ones follow their nearest decided neighbours.

    Neighbours in the same container (div, section, article, cell) come first, parts that
    are never the article left out; then any. An article with nothing decided is kept, and
    blocks of links in it are dropped, but say nothing about their neighbours.
    Where both sides differ at equal distance, a heading follows the next one, prose is
    kept and a short block is not.
    """
    own: dict[int, list[int]] = {}
    for i, block in enumerate(found):
        if not block.outside:
            own.setdefault(block.container, []).append(i)
    inside: dict[int, list[tuple[int, str] | None]] = {}
    for where in own.values():
        inside |= _sides(labels, where)
    everywhere = _sides(labels, list(range(len(found))))
    kept = []
    for i, (block, label) in enumerate(zip(found, labels)):
        if label in ("good", "bad", "links"):
            kept.append(label == "good")
            continue
        sides = inside[i]
        if not any(sides) and not block.article:
            sides = everywhere[i]
        before, after = sides
        if before is None or after is None:
            side = before or after
            kept.append(side[1] == "good" if side else bool(block.article) or label == "near")
        elif before[1] == after[1]:
            kept.append(before[1] == "good")
        elif block.heading:
            kept.append(after[1] == "good")
        elif before[0] != after[0]:
            kept.append(min(before, after)[1] == "good")
        else:
            kept.append(label == "near")
    return kept


def main_text(page: str | None, rules: BlockRules = BlockRules()) -> str:
    found = blocks(page or "")
    labels = [first_pass(block, rules) for block in found]
    return "\n\n".join(b.text for b, keep in zip(found, second_pass(found, labels)) if keep)


def _extract(batches: Iterator[pa.RecordBatch], rules: BlockRules) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py(), rules) for page in batch.column("html")]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        columns.append(pa.array([len(t) for t in texts], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, rules: BlockRules = BlockRules()) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    Null or empty html, and a page without an article: empty text. Null ids and urls pass
    through. Repeated rows give repeated results; ties do not arise. An empty table gives no
    rows. Other columns are not read. Narrow: each page is judged alone, no shuffle.
    """
    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(lambda it: _extract(it, rules), schema)
