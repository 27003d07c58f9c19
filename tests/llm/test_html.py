"""Block parsing, the field against brute force, and the text of pages with a known article."""

import html
import itertools
import re
import time

import numpy as np
import pytest

from airledger.llm import html_crf
from airledger.llm.html_blocks import Block, blocks
from airledger.llm.html_pages import labelled_pages


@pytest.fixture(scope="module")
def chain():
    return html_crf.train()


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert texts("<p>a &amp; b<br>c<p>d</p>e <b>f</b>g") == ["a & b c", "d", "e fg"]
    assert texts("<ul><li>x<li>y</ul><table><tr><td>1<td>2</table>") == ["x", "y", "1", "2"]
    assert texts("<script>var t='</p>';</script><style>p{}</style><!-- no <p>x</p> --><p> a \n\t b&nbsp;</p>") == ["a b"]
    assert texts('<div title="a>b">in</div><p>&eacute; &#233; &#x41;&am') == ["in", "é é A&am"]
    assert texts("<p>open <b>bold") == ["open bold"] and texts("") == [] and texts("<") == ["<"]
    assert texts("<script>never closed <p>x</p>") == [] and texts("<!-- never closed <p>x") == []
    nested = blocks('<div id="main"><article class="post"><p>t</p></article></div><p>u')
    assert [b.path for b in nested] == [('div id="main"', 'article class="post"', "p"), ("p",)]
    assert blocks('<p><a href="x">link</a> rest')[0].linked == 4


def test_hostile_markup_stays_linear():
    assert texts("<a href='" * 3_000) is not None
    assert texts("<div>" * 20_000 + "x")[-1] == "x"


@pytest.mark.parametrize("size", [3_000, 5_000, 100_000])
def test_long_attributes_are_read_whole(chain, size):
    value = "a>b 'c' " * (size // 8)
    assert texts(f'<p>x<img src="data:{"A" * size}">y</p>') == ["xy"]
    assert texts(f'<p data-x="{value}">x</p>') == texts(f"<p data-x='{value.replace(chr(39), chr(34))}'>x</p>") == ["x"]
    assert texts(f'<script data-x="{value}">var leak;</script><p>x') == ["x"]
    assert texts(f"<!{'x' * size}><p>a</p {'y ' * size}>b") == ["a", "b"]
    nested = blocks(f'<article data-props="{value}" class="post"><p style="{value}">x')
    assert [b.path[0] for b in nested] == ['article class="post"'] and nested[0].path[1].startswith("p style=")
    page = PAGE.replace("<article>", f'<article data-props="{value}">').replace("<p>Short", f'<p style="{value}">Short')
    assert chain.extract(page) == chain.extract(PAGE)


def test_quotes_open_values_only_after_an_equals_sign():
    assert texts("<p don't>x</p><p>it's y</p>") == ["x", "it's y"]
    assert texts('<p a = "1>2" b=3>x</p>') == ["x"] and texts("<p a=>x") == ["x"]
    assert texts('<p a="1>x</p><p>y</p>') == ["x", "y"]  # never closed: the tag ends at the next ">"


def test_unclosed_elements_and_short_comments():
    for name in ("svg", "math", "object", "canvas", "select", "noscript", "template"):
        assert texts(f"<p>a<{name} id=x><p>b</p>") == ["a", "b"]
        assert texts(f"<p>a<{name}>in</{name}><p>b<{name}><p>c") == ["a", "b", "c"]
    for name in ("script", "style", "title", "textarea", "iframe"):
        assert texts(f"<p>a<{name}><p>b</p>") == ["a"]
    assert texts("<p>a<!-->b<!--->c<!---->d<!-- > -->e<!-- x") == ["abcde"]
    blocks("<svg>" * 100_000)
    assert "sign:©" in html_crf.text_features(Block("word " * 100 + "©", ("p",), 0))


@pytest.mark.parametrize("part", ["<a href='", '<a b=">" c=', "<a<a ", "<a b='>\" ", '<p a="', "<!x ", "<a b=\"'>"])
def test_hostile_attributes_stay_linear(part):
    for end in ("", ">", "x>y", '"', "'>"):
        start = time.perf_counter()
        blocks(part * 40_000 + end)
        assert time.perf_counter() - start < 5


def test_decoding_is_the_best_labelling(chain):
    page = blocks(labelled_pages(1, seed=77)[0][0])[:9]
    scores = chain.emissions(page)

    def total(labels):
        out = chain.first[labels[0]] + chain.last[labels[-1]]
        out += sum(s for s, l in zip(scores, labels) if l)
        return out + sum(chain.step[a, b] for a, b in zip(labels, labels[1:]))

    best = max(itertools.product((0, 1), repeat=len(page)), key=total)
    assert total(chain.decode(page)) == pytest.approx(total(best))


def test_training_raises_the_likelihood_of_the_labels(chain):
    errors = blocks_seen = 0
    for page, marks in labelled_pages(200, seed=5):
        got = chain.decode(blocks(page))
        errors += sum(a != b for a, (_, b) in zip(got, marks))
        blocks_seen += len(marks)
    assert errors / blocks_seen < 0.03


PAGE = """<!doctype html><html><head><title>T</title></head><body>
<header class="site-header"><div class="logo">The Site</div></header>
<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>
<div class="cookie-banner"><p>We use cookies to improve this site.</p><button>Accept all</button></div>
<main><article><h1>A title of the page</h1>
<p>The first paragraph, with <a href="#">a link</a> and some more words.</p>
<div class="ad">Buy now and save!</div>
<h2>A part</h2><p>Second   paragraph &mdash; it goes on.<br>And ends.</p>
<ul><li>First point of the list</li><li>Second point of the list</li></ul>
<p>Short.</p></article>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Another story</a></li></ul></aside>
<section id="comments"><h3>2 comments</h3><div class="comment"><p>I do not agree with this, not at all.</p></div>
<form><label>Your name</label><input><button>Send</button></form></section></main>
<footer><p>© 2024 The Site. All rights reserved.</p></footer></body></html>"""


def test_a_page_with_all_parts(chain):
    assert chain.extract(PAGE) == "\n\n".join([
        "A title of the page", "The first paragraph, with a link and some more words.", "A part",
        "Second paragraph — it goes on. And ends.", "First point of the list", "Second point of the list", "Short.",
    ])


def article_of(page):
    """The template of the given pages, read by pattern."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body).replace("<br>", " "))
    return "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_given_pages(spark, chain):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {(r.page_id, r.url, article_of(r.html)) for r in pages.collect()}
    got = html_crf.main_texts(pages, chain).collect()
    assert {(r.page_id, r.url, r.text) for r in got} == want and len(got) == pages.count()
    assert all(r.n_chars == len(r.text) for r in got)


def test_odd_pages(spark, chain):
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", "", 2), (2, None, "<nav>Home</nav>", 3), (3, "v", "<p>" + "word. " * 50_000, 4)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    got = {(r.page_id, r.n_chars) for r in html_crf.main_texts(frame, chain).collect()}
    assert got == {(None, 0), (1, 0), (2, 0), (3, 6 * 50_000 - 1)}
    assert html_crf.main_texts(frame.limit(0), chain).count() == 0


def test_weights_have_the_expected_signs(chain):
    assert chain.weights.get("mark:comment", 0) < 0 < chain.weights.get("in:article", 0)
    assert np.trace(chain.step) > chain.step[0, 1] + chain.step[1, 0]


def test_nested_and_odd_ends_of_skipped_elements():
    assert texts("<p>a<svg><svg></svg><text>LEAKED</text></svg>b</p>") == ["a b"]
    assert texts("<p>a<svg><svg/><g></g></svg>b") == ["a b"]
    assert texts("<p>a<svg><svg></svg>b<p>c") == ["a b", "c"]
    assert texts("<script>x</script foo>rest") == ["rest"]
    assert texts("<script>x</scripts></script\n>rest") == ["rest"]
    assert texts("<p>a<template><template>in</template>in</template>b") == ["a b"]


@pytest.mark.parametrize(
    "page", [
        "<div>x" * 8000, "<div class=a>x" * 8000, "<div>" * 20_000 + "</zz>" * 20_000, "<x-y>" * 20_000, "<x-y>t" * 20_000,
        "".join(f"<div class=c{i}>x" for i in range(8000)), "<li>x" * 20_000, "<p>x<form>y" * 20_000, "<svg><svg>x</svg>" * 3000,
        "<div>x" * 8000 + "</div>y" * 8000, "<i>" * 50_000, "<ul><li>" * 10_000 + "x</li></ul>" * 10_000,
    ], ids=range(12),
)
def test_deep_pages_stay_quick(chain, page):
    start = time.perf_counter()
    chain.extract(page)
    assert time.perf_counter() - start < 3


def test_running_scores_are_those_of_all_features(chain):
    for html, _ in labelled_pages(30, seed=9):
        page = blocks(html)
        want = [
            sum(chain.weights.get(f, 0.0) for f in (*html_crf.path_features(b.path), *html_crf.text_features(b))) for b in page
        ]
        assert chain.emissions(page) == pytest.approx(want)


P = "This is a sentence of the article, long enough to be read. And here is another one of the same kind."
Q = "A second paragraph follows, with some more words in it, so that the page has a body. It ends here."
STYLES = {
    "reviews": (f'<main><h1>A title here</h1><p>{P}</p><p>{Q}</p></main><div class="user-reviews"><p>Jane: I liked it a lot, thank you.</p></div>', 3),
    "bare divs": (f"<html><body><div>{P}</div><div>{Q}</div><div>{P}</div></body></html>", 3),
    "article": (f"<nav><a href=/>Home</a></nav><article><h1>A title here</h1><p>{P}</p><p>{Q}</p></article><footer>© 2024 Site</footer>", 3),
    "post": (f'<div class="header"><div>My blog</div></div><div class="post"><h2>A title here</h2><p>{P}</p><p>{Q}</p></div><div class="sidebar"><ul><li><a href=/a>Other</a></li></ul></div>', 3),
    "content id": (f'<ul class="menu"><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul><div id="content"><p>{P}</p><p>{Q}</p></div><div id="footer">All rights reserved.</div>', 2),
    "list": (f"<article><p>{P}</p><ul><li>First point of the list</li><li>Second point of the list</li></ul><p>{Q}</p></article>", 4),
    "quote": (f"<article><p>{P}</p><blockquote><p>{Q}</p></blockquote></article><aside><h3>Most read</h3></aside>", 2),
    "cookie": (f'<div class="cookie-banner">We use cookies to improve this site.</div><main><p>{P}</p><p>{Q}</p></main>', 2),
    "form": (f'<main><p>{P}</p><p>{Q}</p></main><form><label>Your e-mail</label><button>Send</button></form>', 2),
    "advert": (f'<article><p>{P}</p><div class="ad">Buy now and save 50%</div><p>{Q}</p></article>', 2),
    "comments": (f'<article><p>{P}</p><p>{Q}</p></article><section id="comments"><h3>2 comments</h3><div class="comment"><p>I do not agree at all.</p></div></section>', 2),
    "table": (f"<article><p>{P}</p><table><tr><td>one cell</td><td>two cells</td></tr></table><p>{Q}</p></article>", 4),
    "sections": (f"<main><section><h2>First part</h2><p>{P}</p></section><section><h2>Second part</h2><p>{Q}</p></section></main>", 4),
    "wrapper": (f'<div class="wrapper"><div class="container"><div class="article-body"><p>{P}</p><p>{Q}</p></div></div></div>', 2),
    "breadcrumb": (f'<div class="breadcrumbs"><a href=/>Home</a> <a href=/x>News</a></div><article><p>{P}</p><p>{Q}</p></article>', 2),
    "share": (f'<article><p>{P}</p><p>{Q}</p><div class="share">Share on social media</div></article>', 2),
    "related": (f'<article><p>{P}</p><p>{Q}</p></article><div class="related"><h3>Related articles</h3><ul><li><a href=/1>Another story</a></li></ul></div>', 2),
    "discussion": (f'<article><p>{P}</p><p>{Q}</p></article><div class="discussion"><div class="reply"><p>So do I, and more than once.</p></div></div>', 2),
    "newsletter": (f'<article><p>{P}</p><p>{Q}</p></article><div class="newsletter"><p>Subscribe to our newsletter</p></div>', 2),
    "plain": (f"<h1>A title here</h1><p>{P}</p><p>{Q}</p><p>{P}</p>", 4),
}


def test_other_page_styles(chain):
    """Twenty hand-written styles; the first ``n`` blocks in page order that hold no part listed around them are the article."""
    right = found = wanted = 0
    for name, (page, count) in STYLES.items():
        around = ("Jane:", "Home", "©", "My blog", "Other", "News", "All rights", "Most read", "cookies", "e-mail", "Send", "Buy now",
                  "comments", "agree", "Share", "Related", "Another", "So do I", "Subscribe")
        want = [b.text for b in blocks(page) if not b.text.startswith(around) and not any(w in b.text[:45] for w in around)]
        assert len(want) == count, name
        got = chain.extract(page).split("\n\n")
        got = [g for g in got if g]
        right += len([g for g in got if g in want])
        found, wanted = found + len(got), wanted + len(want)
    precision, recall = right / found, right / wanted
    assert 2 * precision * recall / (precision + recall) >= 0.95, (precision, recall)
