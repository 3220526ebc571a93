"""Main text of pages without article or main elements, with misleading names, and with the method switched off."""

import pytest
from pyspark.sql import functions as F

from sightline.llm import html_text

PARAGRAPHS = [
    "The survey, begun in spring, covered forty valleys; each of them was walked twice, once by day and once at dusk.",
    "Most of the marks that the older maps showed were found again, though some had moved, and a few were gone.",
    "Short one, though.",
    "What the crews brought home was sorted, counted and weighed; the lists, which run to many pages, are in the annex.",
    "It is not clear why the eastern slopes differ. Water may be the reason, or the wind, or both of them together.",
    "A second visit, planned for the autumn, should settle this; until then the figures stand as they are given here.",
]
MENU = "".join(f'<li><a href="/{w}">{w.title()}</a></li>' for w in ("home", "news", "maps", "contact", "about us"))
AD = "Buy the new walking boots today, only this week."
COMMENTS = "".join(f"<p>Reader {k}: I was there last year, and it was lovely, really; thanks for the report, keep it up.</p>" for k in range(4))
FOOT = "Copyright 2020 The Valley Society"


def page(body):
    return f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def pages(paragraphs):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return {
        "article": page(f"<nav><ul>{MENU}</ul></nav><article>{body}</article><footer>{FOOT}</footer>"),
        "main": page(f"<nav><ul>{MENU}</ul></nav><main>{body}</main><footer>{FOOT}</footer>"),
        "plain divs": page(f"<div><ul>{MENU}</ul></div><div>{body}</div><div>{FOOT}</div>"),
        "plain divs, nested": page(f"<div><div><ul>{MENU}</ul></div><div><div>{body}</div></div></div><div>{FOOT}</div>"),
        "flat body": page(f"<ul>{MENU}</ul>{body}<div>{FOOT}</div>"),
        "wrapper has-sidebar": page(f'<div id="menu"><ul>{MENU}</ul></div><div class="content has-sidebar">{body}</div><div class="sidebar">{AD}</div>'),
        "wrapper named sidebar": page(f'<div><ul>{MENU}</ul></div><div class="sidebar-layout">{body}</div><div>{FOOT}</div>'),
        "wrapper widget": page(f'<div class="widget"><ul>{MENU}</ul></div><div class="widget"><div class="widget-text">{body}</div></div><div class="widget">{FOOT}</div>'),
        "form page": page(f'<form id="aspnetForm"><div><ul>{MENU}</ul></div><div>{body}</div><div>{FOOT}</div></form>'),
        "form page with search": page(f'<form id="aspnetForm"><div><input name="q"><button>Search</button></div><div>{body}</div></form><div>{FOOT}</div>'),
        "related id on article": page(f'<div class="nav"><ul>{MENU}</ul></div><article id="related-research">{body}</article>'),
        "related id on div": page(f'<div><ul>{MENU}</ul></div><div id="related-research">{body}</div><div>{FOOT}</div>'),
        "comments beside": page(f'<div class="post">{body}</div><div id="comments">{COMMENTS}</div>'),
        "comments inside article": page(f'<article>{body}<section class="comments">{COMMENTS}</section></article>'),
        "advert between": page(f'<div><ul>{MENU}</ul></div><div>{body.replace("<p>Short", f"<div class=ad>{AD}</div><p>Short")}</div>'),
        "cookie notice": page(f'<div class="cookie-notice"><p>We use cookies, as all do. Accept them?</p><button>Yes</button></div><div>{body}</div>'),
        "newsletter form": page(f'<div>{body}</div><form class="newsletter"><p>Subscribe, it is free of charge, and you can stop at any time.</p><input></form>'),
        "table layout": page(f"<table><tr><td><ul>{MENU}</ul></td><td>{body}</td></tr></table>"),
        "table layout, nested": page(f"<center><table><tr><td>{FOOT}</td></tr><tr><td><table><tr><td>{body}</td></tr></table></td></tr></table></center>"),
        "inline markup": page(f"<div><ul>{MENU}</ul></div><div>{body.replace('valleys', '<a href=x>valleys</a>').replace('Water', '<b>Water</b>')}</div>"),
        "unclosed": f"<ul>{MENU}</ul><div>{body.replace('</p>', '')}</div><div>{FOOT}</div>",
        "aside and header": page(f"<header><p>The valley pages, since 1990, with news.</p></header><div>{body}</div><aside><p>{AD} And again, {AD}</p></aside>"),
        "role navigation": page(f'<div role="navigation"><ul>{MENU}</ul></div><div>{body}</div><div role="contentinfo">{FOOT}</div>'),
        "social and share": page(f'<div>{body}<div class="social-share"><a href="#">Share</a> <a href="#">Tweet</a></div></div>'),
        "breadcrumbs": page(f'<div class="breadcrumbs"><a href="/">Home</a> / <a href="/n">News</a></div><div class="entry">{body}</div>'),
    }


LONG, BRIEF = pages(PARAGRAPHS), pages(PARAGRAPHS[:3])
WANT, WANT_BRIEF = "\n".join(PARAGRAPHS), "\n".join(PARAGRAPHS[:3])
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


MISNAMED = {"wrapper named sidebar", "form page with search", "related id on div"}


@pytest.mark.parametrize("name", LONG)
def test_page(name):
    assert html_text.main_text(LONG[name]) == WANT
    if name not in MISNAMED:  # where names mislead, three paragraphs are too little against a menu without names
        assert html_text.main_text(BRIEF[name]) == WANT_BRIEF


def test_title_and_lists_stay():
    body = f"<h1>On valleys</h1>{BODY}<h2>List</h2><ul><li>One</li><li>Two</li></ul><p>{PARAGRAPHS[1]}</p>"
    want = f"On valleys\n{WANT}\nList\nOne\nTwo\n{PARAGRAPHS[1]}"
    for around in ("<div>{}</div>", "<article>{}</article>", "<main><div>{}</div></main>", "<article><header><h1>On valleys</h1></header><div>{}</div></article>"):
        inner = body if "header" not in around else body.replace("<h1>On valleys</h1>", "")
        assert html_text.main_text(page(f"<div><ul>{MENU}</ul></div>{around.format(inner)}<div>{FOOT}</div>")) == want


def test_pages_without_article_text():
    ad, foot = f'<div class="ad">{AD}</div>', f"<footer>{FOOT}</footer>"
    assert html_text.main_text(page(f"<nav><ul>{MENU}</ul></nav>{ad}<article></article>{foot}")) == ""
    assert html_text.main_text(page(f"<nav><ul>{MENU}</ul></nav>{foot}")) == ""
    assert html_text.main_text(page("<article><p>Tiny.</p></article>" + foot + ad)) == "Tiny."


def test_the_method_decides(monkeypatch):
    monkeypatch.setattr(html_text, "content_paths", lambda nodes, parents: {p for p, _, _ in nodes})
    changed = [n for n, h in BRIEF.items() if html_text.main_text(h) != WANT_BRIEF]
    assert len(changed) >= len(BRIEF) // 2


def test_names_are_a_prior(monkeypatch):
    monkeypatch.setattr(html_text, "BOILERPLATE_WORDS", set())
    right = [n for n, h in LONG.items() if html_text.main_text(h) == WANT]
    assert len(right) >= len(LONG) * 2 // 3


def test_extract(spark):
    rows = [(1, "a", LONG["plain divs"]), (1, "a", LONG["plain divs"]), (2, None, None), (None, "c", ""), (3, "d", "<p>" + "word, and word. " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("x"), "_id": F.lit(1), "_html": F.lit("y")})
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=repr)
    assert got == sorted([(1, "a", WANT), (1, "a", WANT), (2, None, ""), (None, "c", ""), (3, "d", ("word, and word. " * 100_000).strip())], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


PARTS = "<p>First paragraph, with some words, and more of them. It goes on, and on.</p><p>Second one, of the same kind, with commas, and stops. It ends here.</p>"


def test_reader_comments_go():
    from sightline.llm.html_text import main_text

    want = "Title\nFirst paragraph, with some words, and more of them. It goes on, and on.\nSecond one, of the same kind, with commas, and stops. It ends here."
    talk = "<p>Ann</p><p>Great text, thanks, I liked it, really. Well done.</p><p>Bob</p><p>No, I disagree, strongly, with all of it. Sorry.</p>"
    for page in (
        f"<body><article><h1>Title</h1>{PARTS}<section><h2>Comments</h2>{talk}</section></article></body>",
        f"<body><article><h1>Title</h1>{PARTS}<h2>12 Comments</h2>{talk}</article></body>",
        f"<body><article><h1>Title</h1>{PARTS}<div class='responses'>{talk}</div></article></body>",
        f"<body><article><h1>Title</h1>{PARTS}</article><div><h3>Leave a reply</h3>{talk}</div></body>",
        f"<body><article><h1>Title</h1>{PARTS}<div id='kommentare'>{talk}</div></article></body>",
        f"<body><article><h1>Title</h1>{PARTS}</article><div class='fusszeile'><p>Impressum, Datenschutz, und mehr. Alles da.</p></div></body>",
    ):
        assert main_text(page) == want, page
    after = f"<body><article><h1>Title</h1>{PARTS}<section><h2>Kommentare (3)</h2>{talk}</section><h2>Next part</h2>{PARTS}</article></body>"
    assert main_text(after) == want + "\nNext part\n" + want.split("\n", 1)[1]
    about = f"<body><article><h1>Comments</h1>{PARTS}<h2>Comments on the method</h2>{PARTS}</article></body>"
    assert main_text(about) == "Comments\n" + want.split("\n", 1)[1] + "\nComments on the method\n" + want.split("\n", 1)[1]
