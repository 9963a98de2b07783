import itertools
import random
import re
from html import unescape

import pytest

from hourcast.llm import html, mincut

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header><h1>Site</h1></header><div id="menu"><p>Home</p></div><main><h1>Title</h1><p>Short.<p>One <b>long
paragraph<br>that talks</b> about &lt;something&gt;&nbsp;with some <a href="x">links</a> in it, at length.</p>
<ul><li>item one<li>item two</ul><div class="share-bar">Share this</div><script>var t="</p>";</script><p>End.</p></main>
<!-- <p>old</p> --><aside><p>Read this other story, which is a very long and quite exciting one, my friends.</p></aside>
<section class="comments"><p>I think that this is a great article and I want to say much more about it here.</p></section>
<form><label>Mail</label></form><div class="cookie-notice">We use cookies</div><footer>&copy; Me</footer></body></html><p"""


def test_content_without_boilerplate():
    assert html.main_text(PAGE) == (
        "Title\nShort.\nOne long paragraph that talks about <something> with some links in it, at length.\n"
        "item one\nitem two\nEnd."
    )


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<div", "<nav><p>Home</p></nav>", "<!-- x", "<script>x"])
def test_pages_without_content(page):
    assert html.main_text(page) == ""


ARTICLE = "<p>A first paragraph of the article, with a few words.</p><p>Second one.</p>"
TEXT = "A first paragraph of the article, with a few words.\nSecond one."


@pytest.mark.parametrize(
    "open_tag",
    [
        '<article class="overflow-hidden">', '<article aria-hidden="false">', '<article title="Hidden gems">',
        "<article data-hidden=1 style='content: \"display:none\"'>", '<body class="has-sidebar no-comments"><article>',
        '<body class="with-header no_search"><article>', '<body data-class="nav"><article>',
    ],
)
def test_names_that_only_mention_boilerplate_keep_the_text(open_tag):
    assert html.main_text(open_tag + ARTICLE) == TEXT


@pytest.mark.parametrize(
    "attributes",
    ["hidden", 'hidden=""', "HIDDEN", "aria-hidden=true", 'aria-hidden="true"', 'style="color:red; display : none"', 'class="site-header"'],
)
def test_invisible_and_boilerplate_blocks_go(attributes):
    assert html.main_text(f"<article>{ARTICLE}</article><div {attributes}><p>Not shown.</p></div>") == TEXT


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ('<p>one <svg class="i"/> two</p><p>three</p>', "one two\nthree"),
        ("<p>one <svg/>two</p><p>three</p>", "one two\nthree"),
        ('<p>one <svg aria-label="a > b" /> two</p><p>three</p>', "one two\nthree"),
        ('<p>one <svg class="i"><path d="M0"/><text>no</text></svg> two</p><p>three</p>', "one two\nthree"),
        ("<p>let <math><mi>x</mi></math> be</p><p>three</p>", "let x be\nthree"),
        ("<p>let <math/> be</p><p>three</p>", "let be\nthree"),
        ("<p>so <math><mi>x</mi><annotation>\\x</annotation></math> is</p>", "so x is"),
        ("<title-bar>one</title-bar><p>two</p>", "one\ntwo"),
    ],
)
def test_drawings_go_and_what_stands_after_them_stays(inner, text):
    assert html.main_text(f"<article>{inner}</article>") == text


def test_plain_text_is_content():
    assert html.main_text("A sentence of ten plain words without any markup here.") != ""


def test_pages_of_the_table_equal_their_articles(table):
    def article(page):
        found = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
        blocks = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", found[1]))
        texts = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
        return "\n".join(t for t in texts if t)

    pages = {r["page_id"]: r["html"] for r in table("pages").collect()}
    for r in html.extract(table("pages")).collect():
        assert r["text"] == article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_cut_costs_least_of_all_labellings():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(1, 7)
        gain = [rng.choice((-1, 1)) * rng.random() * 3 for _ in range(n)]
        edges = {p: rng.random() * 2 for p in itertools.combinations(range(n), 2) if rng.random() < 0.6}

        def cost(labels):
            own = sum(abs(g) for g, x in zip(gain, labels, strict=True) if (g > 0) != x)
            return own + sum(w for (a, b), w in edges.items() if labels[a] != labels[b])

        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert cost(mincut.cut(gain, edges)) == pytest.approx(best)


def test_odd_rows(spark):
    rows = [(1, "u", None), (None, None, PAGE), (2, "u", ""), (2, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r["n_chars"] for r in html.extract(df.selectExpr("*", "1 AS text", "2 AS n_chars")).collect())[:3] == [0, 0, 0]
    assert html.extract(df.limit(0)).count() == 0


def test_long_page_is_read_whole():
    page = "<article>" + "<p>A paragraph of some words.</p>" * 20_000 + "</article>"
    assert html.main_text(page).count("\n") == 19_999


LONG = "This is a paragraph of the article with some forty words in it. " * 4


@pytest.mark.parametrize(
    "names",
    ["post comment-open", "form-horizontal search-results", "post-header-share content", "has-sidebar", "search-page", "social-science", "ad-hoc"],
)
def test_class_words_that_only_mention_boilerplate(names):
    page = f'<body><nav><a href="/">Home</a></nav><div class="{names}"><p>{LONG}</p></div></body>'
    assert html.main_text(page) == LONG.strip()


@pytest.mark.parametrize("names", ["sidebar-left", "comment-list", "cookie-banner", "site-footer", "menu_item", "ad-slot", "share-buttons"])
def test_composed_class_words_of_boilerplate(names):
    page = f'<article><p>{LONG}</p></article><div class="{names}"><p>Some other words.</p></div>'
    assert html.main_text(page) == LONG.strip()


def test_header_of_an_article_is_its_own():
    page = f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{LONG}</p></article>"
    assert html.main_text(page) == "Title\n" + LONG.strip()
