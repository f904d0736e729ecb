from __future__ import annotations

import pytest

from tidemark.llm.main_text import extract, main_text

P1 = "The first paragraph is long enough, has commas, and tells something about the matter."
P2 = "The second one &amp; its caf&eacute;   goes\non, with  more white space, until its end."
T2 = "The second one & its café goes on, with more white space, until its end."
SIDE = "This text stands beside the article, is long, has commas, and yet, it is no part of it at all."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href=/>{}</a></li></ul></nav>", "<header><p>{}</p></header>", "<footer><p>{}</p></footer>", "<aside><p>{}</p></aside>",
        '<div class="sidebar"><p>{}</p></div>', '<div id="cookie-notice"><p>{}</p></div>', '<div class="ad"><p>{}</p></div>', '<section class="adBanner"><p>{}</p></section>',
        "<form><p>{}</p></form>", '<div id="comments"><p>{0}</p><p>{0}</p><p>{0}</p></div>', '<ol class="comment-list"><li>{0}</li></ol>', "<script>{}</script>", "<!-- {} -->",
        '<div role="complementary"><p>{}</p></div>', "<div hidden><p>{}</p></div>", '<div style="display: none">{}</div>', "<noscript>{}</noscript>",
    ],
)
@pytest.mark.parametrize("inside", ["<article><h1>Title</h1><p>{}</p><p>{}</p></article>", '<div id="wrap"><div class="post"><h1>Title</h1><p>{}<p>{}</div></div>'])
def test_what_surrounds_an_article_goes(inside, around):
    body = inside.format(P1, P2)
    for html in (page(around.format(SIDE) + body), page(body + around.format(SIDE))):
        assert main_text(html) == f"Title\n{P1}\n{T2}"


@pytest.mark.parametrize("wrap", ['<div id=content class="with-sidebar">{}</div>', '<div class="two-column no-sidebar">{}</div>', '<div class="post comments-open">{}</div>', '<form action=/><input>{}</form>', '<form><div class="entry share-enabled">{}</div></form>'])
@pytest.mark.parametrize("inside", ["<article><h1>Title</h1><p>{0}</p><p>{1}</p><p>{1}</p></article>", "<div><h1>Title</h1><p>{0}</p><p>{1}</p><p>{1}</p></div>"])
def test_what_holds_the_page_is_no_surrounding(wrap, inside):
    body = inside.format(P1, P2) + '<div class="sidebar"><p>beside it all, a short text</p></div>'
    assert main_text(page(wrap.format(body))) == f"Title\n{P1}\n{T2}\n{T2}"


def test_blocks_and_broken_markup():
    html = f"<div><p>{P1}<br>after a break<p><b>{P2}</p><ul><li>point <i>one</i><li>point two</ul>loose text<table><tr><td>a<td>b</table></div"
    assert main_text(html).split("\n") == [f"{P1} after a break", T2, "point one", "point two", "loose text", "a", "b"]


def test_the_better_container_wins_and_siblings_stay():
    links = "".join(f'<p><a href="/{i}">{P1}</a></p>' for i in range(9))
    html = page(f"<div class=x>{links}</div><div class=y><p>{P1}</p><p>{P1}</p></div><div class=z><p>{P1}</p></div>")
    assert main_text(html) == "\n".join([P1] * 3)


def test_odd_pages():
    assert main_text("") == main_text("<html></html>") == main_text("<script>x</script>") == ""
    assert main_text("only text") == "only text"
    assert main_text("<div>" * 3000 + P1) == P1
    assert main_text(page(f"<article><p>{'word, ' * 50000}</p></article>")) == ("word, " * 50000).strip()


def test_frames(spark):
    rows = [(1, None, "u", 7), (2, "", None, 7), (None, page(f"<p>{P1}</p>"), "u", 7), (3, page(f"<p>{P2}</p>"), "v", None), (3, page(f"<p>{P2}</p>"), "v", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, other int").selectExpr("*", "'x' as text", "1 as n_chars")
    got = sorted((tuple(r) for r in extract(pages, keep=["url"]).collect()), key=repr)
    want = [(1, "u", "", 0), (2, None, "", 0), (None, "u", P1, len(P1)), (3, "v", T2, len(T2)), (3, "v", T2, len(T2))]
    assert got == sorted(want, key=repr)
    assert extract(pages.limit(0)).count() == 0
