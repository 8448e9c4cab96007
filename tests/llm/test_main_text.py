"""The article of a page against a plain reading of it, and pages that rules misjudge easily."""

import time
from html.parser import HTMLParser

import pytest

from tonescape.llm import queries
from tonescape.llm.main_text import main_text

SF_DIR = "/root/testdata/sf0.001"


class Plain(HTMLParser):
    """The texts of the blocks inside an article element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag == "br":
            self.blocks[-1].append(" ")
        elif tag in ("p", "h1", "li", "div", "article", "ul"):
            self.blocks.append([])

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "li", "div", "article", "ul"):
            self.blocks.append([])
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1].append(data)


def plain(page):
    parser = Plain()
    parser.feed(page or "")
    parser.close()
    blocks = (" ".join("".join(b).split()) for b in parser.blocks)
    return "\n\n".join(b for b in blocks if b)


def test_query_against_a_plain_reading(spark):
    """The given pages hold their main text in one article element and nothing else in it."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = queries.QUERIES["op7_main_text"](spark, SF_DIR).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        text = plain(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, text, len(text))


PROSE = (
    "This is the story of the town and of the people who live in it, and it was written for all of them, so that "
    "they can read it in the evening when the work is done. It has many words, and it is not short at all."
)
KEPT = """article class="post tag-news"|div class="post tag-politics"|div class="ad-free"|div class="header-story"
div id="share-price"|div class="notice-of-death"|section class="social-history"|article class="related"
div class="post-content"|div class="entry-content"|div class="td-post-content tagdiv-type"|div class="story-body"
div id="content"|section class="article-body"|div class="field field--name-body"|div class="c-article__body"
div class="wp-block-group"|main class="site-main"|article class="post-123 type-post category-tags"|div class="prose"
div class="navy-blue"|div class="searchlight"|div class="footprint"|div class="menuhin-biography"|div class="tagore"
div class="commentary"|section class="discussions-with-experts"|div class="alerts-explained"|div class="adversary"
article class="sidebar"|div class="header-image-article"|div class="popular-science"|div class="widgetry"
article id="search"|div class="cookie-recipes"|div class="newsletter-archive-article"|div class="overlaying\"""".replace("|", "\n").split("\n")
LOST = """div class="ad"|div class="sidebar"|div id="comments"|section class="comments-area"|div class="cookie-consent"
div class="related-posts"|div class="newsletter-box"|div class="site-footer"|div class="social-links"|article class="comment"
div class="share-buttons"|div role="navigation"|div hidden|nav|aside|footer|form""".replace("|", "\n").split("\n")


def page(element, inner):
    menu = "<nav><a href=/>Home</a><a href=/n>News</a></nav>"
    return f"<html><body>{menu}<{element}>{inner}</{element.split()[0]}><footer>All rights reserved.</footer></body></html>"


@pytest.mark.parametrize("element", KEPT)
def test_names_that_only_look_like_other_parts(element):
    assert main_text(page(element, f"<h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p>")).count(PROSE) == 2


@pytest.mark.parametrize("element", LOST)
def test_other_parts_go(element):
    other = PROSE.replace("town", "harbour")
    text = main_text(page("article", f"<p>{PROSE}</p><p>{PROSE}</p>") + page(element, f"<p>{other}</p>"))
    assert text.count(PROSE) == 2 and "harbour" not in text


@pytest.mark.parametrize("element", ['div id="cookie-notice"', 'section class="cookies_notice"', 'div class="copyright-notices"'])
def test_notices_go(element):
    notice = "<p>We use cookies and the like of it to be the best that we can for you and your.</p>"
    assert main_text(page(element, notice) + page("article", f"<p>{PROSE}</p>")) == PROSE
    other = element.replace("notice", "noticed")
    assert "cookies" in main_text(page(other, notice) + page("article", f"<p>{PROSE}</p>"))


@pytest.mark.parametrize("element", ['article class="sidebar"', 'article id="related"', 'article class="post tags"'])
def test_articles_go_by_name_only_if_they_are_short(element):
    lines = [f"It was the {n} of the times that they had in it." for n in ("best", "worst", "first", "last", "end")]
    short, long = (f"<p>{'</p><p>'.join(x)}</p>" for x in (lines[:2], lines))
    assert main_text(page(element, short)) == ""
    assert main_text(page("article", f"<p>{PROSE}</p>") + page(element, short)) == PROSE
    assert main_text(page(element, long)) == "\n\n".join(lines)
    assert main_text(page(element, short) * 3) == "\n\n".join(lines[:2] * 3)
    others = page("article", f"<p>{PROSE}</p>" * 5)
    assert main_text(others + page(element, long)).endswith("\n\n".join(lines))
    advert = '<div class="ad-box"><p>Buy the thing of the year, it is the best there is for you and for all of us, now!</p></div>'
    assert main_text(page(element, long + advert)) == "\n\n".join(lines)


def test_an_element_with_most_of_the_prose_stays():
    text = main_text(page('div class="widget content"', f"<p>{PROSE}</p><p>{PROSE}</p>"))
    assert text.count(PROSE) == 2
    text = main_text(page('div class="content"', f"<p>{PROSE}</p>" * 3 + f'<div class="widget"><p>{PROSE[::-1]}</p><p>{PROSE}</p></div>'))
    assert text.count(PROSE) == 3


def test_items_beside_a_link_stay():
    items = "<li>One</li><li><a href=/>A link to something</a></li><li>Two</li>"
    assert main_text(f"<article><p>Short text.</p><ul>{items}</ul></article>") == "Short text.\n\nOne\n\nTwo"


@pytest.mark.parametrize(
    "part", ["<p>ab</p>", "<div><p>x</p>", "</b><p>ab", "<span>x", "</a><i>", "<div>", "<li><a href=/>x</a>", "<td>x"]
)
def test_time_is_in_proportion(part):
    for before in ("", "<article>"):
        start = time.process_time()
        main_text(before + part * 8000)
        assert time.process_time() - start < 2
