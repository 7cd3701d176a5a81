"""HTML extraction of malformed declarations and of pages inside forms."""

import pytest

from salesmart.llm import html

LONG = "This is the long text of the page, which goes on for some while and says things."


@pytest.mark.parametrize("bad", ["<![foo bar]>", "<![ x>", "<![>", "<![1]>", "<![foo[ bar ]]>"])
def test_unknown_declarations_are_comments(bad):
    assert html.main_text(f"<p>{LONG}</p>{bad}<p>{LONG}</p>") == f"{LONG} {LONG}"


def test_unclosed_declaration_ends_the_page(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{LONG}</p><![ x"), (2, "u", f"<p>{LONG}</p>")], "page_id bigint, url string, html string")
    assert {r["page_id"]: r["text"] for r in html.extract(pages).collect()} == {1: LONG, 2: LONG}


def test_forms():
    small = "<form><p>Name <input> Send</p></form>"
    assert html.main_text(f"<body><form id=f><div><p>{LONG}</p><p>{LONG}</p></div></form></body>") == f"{LONG} {LONG}"
    assert html.main_text(f"<body><div><p>{LONG}</p>{small}<p>{LONG}</p></div></body>") == f"{LONG} {LONG}"
    assert html.main_text(f"<body><form><article><p>{LONG}</p></article></form><div><p>{LONG * 3}</p></div></body>") == LONG
    assert html.main_text(f"<body><form><div><p>{LONG}</p>{small}</div></form></body>") == LONG
    assert html.main_text(f'<body><form class="search"><p>{LONG}</p></form></body>') == ""


BODY = f"<p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>"
TEXT = " ".join([LONG] * 3)


@pytest.mark.parametrize("page", [
    '<main class="has-sidebar">{}</main>', '<div class="layout-no-sidebar">{}</div>', '<article class="post comments-open">{}</article>', '<div id="page" class="header-fixed">{}</div>',
    "<article><p>Teaser</p></article><div>{}</div>", '<div class="site-header"><a href="/">Home</a></div><div>{}</div><div class="comments"><article class="comment"><p>Nice one</p></article></div>',
    '<div class="promo"><main>{}</main></div>', '<div class="ad">Buy this now, it is the best of all things you can buy today.</div><article>{}</article>',
    '<article>{}<section><a href="1">a</a><a href="2">b</a><a href="3">c</a><a href="4">d</a></section></article>', "<div><div>{}</div><ul class='menu'><li>x</li></ul></div>",
])
def test_everyday_pages(page):
    assert html.main_text(f"<html><body class='home search'><nav><a>x</a></nav>{page.format(BODY)}<footer>f</footer></body></html>") == TEXT


def test_clustering_decides_inside_an_article(monkeypatch):
    import numpy as np

    page = f'<article>{BODY}<section><a href="1">a</a><a href="2">b</a><a href="3">c</a></section></article>'
    assert html.main_text(page) == TEXT
    monkeypatch.setattr(html, "content_lines", lambda lines, sigma: np.ones(len(lines), bool))
    assert html.main_text(page) == f"{TEXT} abc"


def test_null_empty_repeated_and_clashing(spark):
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, BODY, "y"), (3, None, BODY, "y"), (None, "u", f"<p>{'long ' * 100_000}</p>", "z")]
    out = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in out) == [(0, 499_999), (1, 0), (2, 0), (3, len(TEXT)), (3, len(TEXT))]
    assert html.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
