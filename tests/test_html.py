from __future__ import annotations

import time

import pytest

from pagevane.functions import extract_text, first_h1, main_text, unescape
from pagevane.operators import extract_pages

from .conftest import table

LONG = "one two three four five six seven eight nine ten eleven."


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>no heading</p>", ""),
        ("<h1>first</h1><h1>second</h1>", "first"),
        ("<h1> a <b>b</b> </h1>", " a b "),
        ('<H1 class="x">A &amp; B &eacute;&#233;&#xE9;</H1>', "A & B ééé"),
        ("<!-- <h1>no</h1> --><h1>yes</h1>", "yes"),
        ("<script>var s = '<h1>no</h1>';</script><h1>yes</h1>", "yes"),
        ("<h10>no</h10>", ""),
        ("<h1>open<h2>next</h2>", "open"),
        ("<h1>never closed", "never closed"),
        ("<h1>two\nlines</h1>", "two\nlines"),
        ('<h1 title="a>b">T</h1>', "T"),
        ("<h1 title = 'a>b' id=x>T<i alt='>'>U</i></h1>", "TU"),
        ('<a title="<h1>no</h1>">x</a><h1>yes</h1>', "yes"),
        ('<a title="<script>">x</a><h1>yes</h1>', "yes"),
        ("<h1 title=it's>a</h1><p title='x'>", "a"),
        ('<p title="never closed><h1>yes</h1>', "yes"),
    ],
)
def test_first_h1(one, html, expected):
    assert one(first_h1, html) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("&amp;lt;&lt;", "&lt;<"),
        ("&amp;amp;&&lt;x;", "&amp;&<x;"),
        ("&#38;gt;", "&gt;"),
        ("&nope; &", "&nope; &"),
        ("&#128512;&#x1F600;", "\U0001f600\U0001f600"),
        ("&#0;&#55296;&#1114112;", "&#0;&#55296;&#1114112;"),
        ("&quot;&apos;&nbsp;&copy;", "\"' ©"),
        ("", ""),
        (None, None),
    ],
)
def test_unescape(one, text, expected):
    assert one(unescape, text) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a</p><p>b</p>", "a b"),
        ('<script>t="</p>";</script>x', "x"),
        ("<style>p{}</style><!-- c --><nav>n</nav><footer>f</footer>x", "x"),
        ("a<script>never closed", "a"),
        ("1 < 2 and <b>3</b>", "1 < 2 and 3"),
        ("a&nbsp;&nbsp;b c", "a b c"),
        ("<title>t</title>", ""),
        ("<header>h</header>", "h"),
        ('<p title="1 > 0">a</p><img alt="x>y">b', "a b"),
        ('<script data-x="</script>a>">gone</script>b', "b"),
        ("a<b c", "a"),
        (None, None),
    ],
)
def test_extract_text(one, html, expected):
    assert one(extract_text, html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        (f"<p>{LONG}</p><div>{LONG}</div>", f"{LONG}\n{LONG}"),
        (f'<div class="ad">{LONG}</div><p>short</p>', "short"),
        (f'<div id="left-sidebar">{LONG}</div><p>short</p>', "short"),
        ('<div class="read-address">' + LONG + "</div>", LONG),
        ("<div>read more</div><p>short</p>", "short"),
        ('<p><a href="/a">one two</a> three</p><p>kept</p>', "kept"),
        (f'<p>{LONG} <a href="/a">link</a></p>', f"{LONG} link"),
        ("<ul><li>item</li></ul>", "item"),
        ('<p><a href="/a">one <a href="/b">two</p><p>kept</p>', "kept"),
        ("<nav>never closed <p>text</p>", ""),
        ("<p>unclosed<p>next", "unclosed\nnext"),
        ('<p title="1 > 0">kept</p><p title="a>b" class="big ad">gone</p>', "kept"),
        ('<p data-class="ad">kept</p><p class="x" id=promo>gone</p>', "kept"),
        ('<div title="<p>no</p>"></div><p>kept</p>', "kept"),
        ("", ""),
    ],
)
def test_main_text(one, html, expected):
    assert one(main_text, html) == expected


@pytest.mark.parametrize(
    "html",
    [
        "<nav><p>un</p>" * 40_000,
        "<h1>" * 100_000,
        '<a href="x">un ' * 50_000,
        "<" * 500_000,
        "&" * 500_000,
        "".join(f"&#{i};" for i in range(1000, 6000)) * 20,
        "<!--" + "x" * 1_000_000,
        '<a x="' * 100_000,
        "<a x='>" * 100_000 + '"',
        "<p " + "class=" * 100_000,
        "<p " + 'class="b" ' * 100_000 + ">",
        "&eacute" * 100_000,
    ],
    ids="nav h1 a lt amp entities comment quote quotes equals classes bare".split(),
)
def test_broken_pages_take_linear_time(spark, html):
    df = spark.createDataFrame([(html,)], "c string")
    started = time.monotonic()
    df.select(extract_text("c"), main_text("c"), first_h1("c")).collect()
    assert time.monotonic() - started < 30


def test_pages_lose_furniture_and_keep_article(spark):
    pages = table(spark, "pages", "sf0.01").select("html", main_text("html").alias("text"))
    for html, text in pages.collect():
        assert text
        assert "track(" not in text and "margin:0" not in text
        assert "</" not in text


def test_extract_pages_filters_in_order(spark):
    french = "le la les des du et est une dans que qui"
    pages = spark.createDataFrame(
        [
            (1, "u1", f"<h1>t</h1><p>{french}</p>"),
            (2, "u2", "<p>the of and to in is that</p>"),
            (3, "u3", "<script>le la les</script>"),
            (4, "u4", None),
            (5, None, f"<p>{french}</p>"),
        ],
        "page_id long, url string, html string",
    )
    found = {r.page_id: r for r in extract_pages(pages).collect()}
    assert set(found) == {1, 5}
    assert found[1].h1 == "t" and found[5].h1 == "" and found[5].url is None
    assert found[5].text == french
    english = extract_pages(pages, lang="en").collect()
    assert [r.page_id for r in english] == [2]
