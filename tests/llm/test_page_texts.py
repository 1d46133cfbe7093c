"""op7 against a plain HTMLParser on the given pages, and containers whose class says too much."""

from __future__ import annotations

import os
from html.parser import HTMLParser

import numpy as np
import pytest

from tidemark.llm.catalogue import QUERIES
from tidemark.llm.html_text import LABELLED, _spread, block_tree, grow, judge, main_text

FOLDER = "/root/testdata/sf0.01"
ARTICLE = "<article><h1>Title</h1><p>First words.</p><p>Second words.</p></article>"
TEXT = "Title\nFirst words.\nSecond words."


class Plain(HTMLParser):
    """Lines of the article, cut at the given pages' block tags."""

    def __init__(self, page):
        super().__init__()
        self.inside, self.lines = False, [""]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.lines += [""] if tag in ("article", "p", "h1") else []
        self.lines[-1] += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        self.lines += [""] if tag in ("article", "p", "h1") else []

    def handle_data(self, data):
        self.lines[-1] += data if self.inside else ""

    def text(self):
        lines = (" ".join(line.split()) for line in self.lines)
        return "\n".join(line for line in lines if line)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
def test_all_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = {r.page_id: r.text for r in QUERIES["op7_extract_text"](spark, FOLDER).collect()}
    assert found == {i: Plain(html).text() for i, html in pages.items()}


def text_of(page):
    return main_text(page, block_tree())


@pytest.mark.parametrize("name", ["no-sidebar", "site right-sidebar", "layout has-sidebar", "page with-social", "sidebar", "widget-area"])
def test_containers_that_hold_the_article(name):
    for attribute in ("class", "id"):
        assert text_of(f'<nav><a href="/">Home</a></nav><div {attribute}="{name}">{ARTICLE}</div><footer>all</footer>') == TEXT
        assert text_of(f'<main><div {attribute}="{name}">{ARTICLE}</div></main>') == TEXT
    assert text_of(ARTICLE.replace("<article>", '<article class="post comments-open social-media">')) == TEXT
    assert text_of(f'<main class="widget">{ARTICLE}</main>') == TEXT


def test_other_containers_still_go():
    aside = '<div class="right sidebar">Beside it</div><div class="post-comments"><p>A reader</p></div>'
    assert text_of(f"<body>{aside}{ARTICLE}</body>") == TEXT
    assert text_of(ARTICLE.replace("</h1>", "</h1>" + aside)) == TEXT
    comments = '<div class="comments"><article><p>A reader says this.</p></article></div>'
    assert text_of(ARTICLE.replace("</article>", comments + "</article>")) == TEXT


def test_formulas_stay():
    page = "<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>"
    assert text_of(page) == "So x=2 holds."


def test_buttons_and_selects_left_open():
    for open_tag in ("<button>Send", "<select><option>One<option>Two"):
        assert text_of(ARTICLE.replace("First words.", "First words. " + open_tag)) == TEXT
        assert text_of(f"<article><p>First words.<p>{open_tag}<p>Second words.</article>") == "First words.\nSecond words."
        assert text_of(f"<article><div>First words. {open_tag}</div><p>Second words.</p>{open_tag}") == "First words.\nSecond words."
    closed = "<article><p>First <button><div>Send</div></button> words. <select><optgroup><option>One</select></p><p>Second words.</p></article>"
    assert text_of(closed) == "First words.\nSecond words."
    assert text_of("<article><p>First.<button>A<p>Second.<button>B</button><p>Third.</article>") == "First.\nSecond.\nThird."


FIRST, SECOND = "The river rose again " * 6, "and the town looked on " * 7
STORY = f"<article><h1>Title</h1><p>{FIRST}</p><p>{SECOND}</p></article>"
TOLD = f"Title\n{FIRST.strip()}\n{SECOND.strip()}"


@pytest.mark.parametrize("comments", [
    '<section class="comments"><article><p>{}</p></article></section>', '<section id="comments"><h2>Replies</h2><article>{}</article></section>',
    '<div class="comment-list"><article class="comment">{}</article></div>', '<div class="related"><article><h2>Teaser</h2><p>{}</p></article></div>',
    '<aside><article>{}</article></aside>', '<div class="relatedLinks"><article><a href="/x">{}</a></article></div>'])
@pytest.mark.parametrize("words", ["Short.", "A reader has very much to say about this. " * 40])
def test_readers_and_teasers_in_articles_of_their_own(comments, words):
    beside = comments.format(words)
    for page in (STORY + beside, beside + STORY, f"<main>{STORY}{beside}</main>", STORY.replace("</article>", beside + "</article>"),
                 f"<main>{STORY[9:-10]}{beside}</main>"):
        assert text_of(page) == TOLD


def test_an_article_in_two_parts():
    assert text_of(STORY + STORY.replace("Title", "Part two")) == TOLD + "\n" + TOLD.replace("Title", "Part two")


@pytest.mark.parametrize("inside,text", [
    ('<ol class="share-holders"><li>Smith, two fifths</li><li>Jones, three fifths</li></ol>', "Smith, two fifths\nJones, three fifths"),
    ('<div class="notice-board">The board hung in the hall.</div>', "The board hung in the hall."),
    ('<div class="alert">The dam may break soon.</div>', "The dam may break soon."),
    ('<div id="legal">The court ruled on Monday.</div>', "The court ruled on Monday."),
    ("<ul><li>One</li><li><a href=/x>Two</a></li></ul>", "One\nTwo"),
    ('<div class="ad">Buy one, get two of them now and here.</div>', None), ('<div class="share-buttons"><a href=/f>Post</a></div>', None),
    ('<div class="newsletterSignup">Get all the news by mail.</div>', None), ('<p class="cookie-notice">We use cookies here.</p>', None),
    ("<form>Your mail</form>", None), ('<div hidden>Not shown</div>', None), ('<div class="social-media-links">Follow us</div>', None)])
def test_containers_in_an_article(inside, text):
    page = STORY.replace("</p><p>", f"</p>{inside}<p>")
    assert text_of(page) == (TOLD.replace("\nand", f"\n{text}\nand", 1) if text else TOLD)


def test_neighbours_decide_in_an_article():
    """The same doubtful block stays between paragraphs and goes beside links or at the end; without neighbours none of them can be told."""
    block = '<div class="notice">The bridge is closed on Monday.</div>'
    between = STORY.replace("</p><p>", f"</p>{block}<p>")
    at_end = STORY.replace("</article>", block + "</article>")
    by_link = STORY.replace("</p><p>", f'</p>{block}<div class="notice"><a href="/more">More</a></div><p>')
    assert "The bridge" in text_of(between) and text_of(at_end) == text_of(by_link) == TOLD
    blind = LABELLED.copy()
    blind[:, 5:9] = 0
    tree = grow(_spread(blind))
    seen = np.array([[1, 1, 0, 6, 0.0, 0, 0, 0, 0, 0]])
    assert len({"The bridge" in main_text(page, block_tree()) for page in (between, at_end, by_link)}) == 2
    assert len({bool(judge(tree, _spread(seen))[0]) for _ in (between, at_end, by_link)}) == 1


def test_pages_without_an_article():
    assert text_of("<body><p>One short.</p><p>Two is short.</p><p>Three.</p></body>") == "One short.\nTwo is short.\nThree."
    page = f'<nav><a href="/">Home</a></nav><div><a href="/a">A</a></div><h1>Head</h1><p>{FIRST}</p><p>Short one.</p><ul><li>item</li><li>two</li></ul><p>{SECOND}</p>'
    assert text_of(page + "<footer>all</footer>") == f"Head\n{FIRST.strip()}\nShort one.\nitem\ntwo\n{SECOND.strip()}"
    assert text_of("<div><a href=/1>One</a></div><div><a href=/2>Two</a></div><div><a href=/3>Three</a></div>") == ""
