"""Main text of hand-made pages, one layout a host."""

import time

import pytest

from cindermill.llm import html_template

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
NAV, FOOT = "<nav><a href=/>Home</a><a href=/x>News</a></nav>", "<footer>All rights reserved</footer>"


def para(i, k):
    return f"{WORDS[(7 * i + k) % 10]} {i} para {k} has words of its own, {WORDS[(i + 3 * k) % 10]}"


def side(i):
    return f"<div class=side><p>Read also {WORDS[i % 10]}</p></div>"


def page(inner, around="{}"):
    return f"<html><head><title>t</title></head><body>{around.format(NAV + inner + FOOT)}</body></html>"


LAYOUTS = {
    "inner body": (lambda i: page(f"<article><h1>T {i}</h1><p>Lead {i}</p><div class=body><p>{para(i, 1)}</p><p>{para(i, 2)}</p></div><p>Closing {i}</p></article>{side(i)}"), lambda i: f"T {i}\nLead {i}\n{para(i, 1)}\n{para(i, 2)}\nClosing {i}"),
    "sections with classes of their own": (lambda i: page(f"<article><section class=s{WORDS[i % 10]}><p>{para(i, 1)}</p></section><section class=t{WORDS[i % 7]}><p>{para(i, 2)}</p></section></article>"), lambda i: f"{para(i, 1)}\n{para(i, 2)}"),
    "a state of comments": (lambda i: page(f'<div class="post comments-open"><h1>T {i}</h1><p>{para(i, 1)}</p><p>{para(i, 2)}</p></div>{side(i)}'), lambda i: f"T {i}\n{para(i, 1)}\n{para(i, 2)}"),
    "a form around all": (lambda i: page(f"<div id=content><h1>T {i}</h1><p>{para(i, 1)}</p></div><input name=q><select><option>a</select>", "<form action=x>{}</form>"), lambda i: f"T {i}\n{para(i, 1)}"),
    "a form around an article": (lambda i: page(f"<article><p>{para(i, 1)}</p><form><p>Subscribe</p><input></form></article>", "<form>{}</form>"), lambda i: para(i, 1)),
    "a line in every article": (lambda i: page(f"<article><h1>T {i}</h1><p>By our staff writer</p><p>{para(i, 1)}</p></article>"), lambda i: f"T {i}\nBy our staff writer\n{para(i, 1)}"),
    "a line in every story": (lambda i: page(f"<div class=story><h1>T {i}</h1><p>By our staff writer</p><p>{para(i, 1)}</p></div><div>Our notice is the same on every page</div>"), lambda i: f"T {i}\nBy our staff writer\n{para(i, 1)}"),
    "quotes now and then": (lambda i: page(f"<article><p>{para(i, 1)}</p>" + "<blockquote><p>one</p><p>two</p></blockquote>" * (i % 2) + f"<p>{para(i, 2)}</p></article>"), lambda i: f"{para(i, 1)}\n" + "one\ntwo\n" * (i % 2) + para(i, 2)),
    "cells of a table": (lambda i: f"<html><body><table><tr><td><a href=1>one</a><td><p>{para(i, 1)}<p>{para(i, 2)}<td>Copyright of all</table></body></html>", lambda i: f"{para(i, 1)}\n{para(i, 2)}"),
    "comments as articles": (lambda i: page(f"<main><article><p>{para(i, 1)}</p></article><div class=comments><article class=comment><p>{para(i, 2)}</p></article></div></main>"), lambda i: para(i, 1)),
}


def test_layouts(spark):
    names = list(LAYOUTS)
    rows = [(1000 * n + i, f"http://host{n}.example/{i}", LAYOUTS[name][0](i)) for n, name in enumerate(names) for i in range(20)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, part int")
    got = {r["page_id"]: r["text"] for r in html_template.main_text(frame).collect()}
    assert len(got) == len(rows)
    for n, name in enumerate(names):
        for i in range(20):
            assert got[1000 * n + i] == LAYOUTS[name][1](i), name


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>t</title><meta charset=x><body><article><p>one</p></article>", "one"),
    ("<title>t</title><head><p>one<p>two", "one\ntwo"),
    ("<article><p>a</p><aside>side</aside><p>b</p></article>", "a\nb"),
    ("<article><label>Name <p>one</p></article>", "Name\none"),
    ("<blockquote><p>a</p><p>b</p></blockquote><div>c</div><div>d</div>", "a\nb\nc\nd"),
    ('<p class="a"">Main "quoted" text</p>', 'Main "quoted" text'),
    ("<p>x</p><!--><p>y</p>", "x\ny"),
    ("<p>x</p><!---><p>y</p><!-- c --!><p>z</p><!-- open", "x\ny\nz"),
    ("<p>a < b and c</p>", "a < b and c"),
    ("<p title=\"a>b\" class='x'>t</p><p a=b/>u</p>", "t\nu"),
    ("<button>x<p>y</p>", "y"),
    ("<script>if (a < b) x('</p>')</script ><p>y</p><style>p{}</style", "y"),
    ("x</nosuch>y<1>z &amp; &lt;p&gt; &nbsp; w &copy 2", "xy<1>z & <p> w © 2"),
    ("<div class=cookie>We use some</div><div class=banner>All that there is to read</div>", "All that there is to read"),
    ("<article class=promo><p>one</p></article><article class='promo'><p>two</p></article>", "one\ntwo"),
    ("<div class='side-by-side'><p>one</p></div><div class=side>two</div><div id=foot>three</div>", "one"),
    ("", ""), ("<p", ""), ("<", ""), ("&nbsp;", ""),
])
def test_single_pages(html, text):
    assert html_template.extract(html, None) == text


def test_text_of_copies_stays_and_two_pages_are_no_template():
    assert html_template.deduce([{"token": 1, "tag": True, "pages": 2, "total": 2, "vector": "v", "places": 2.0}] * 2, 2) == html_template.NO_TEMPLATE


@pytest.mark.parametrize("html", ["<div>" * 8000 + "deep" + "</div>" * 8000, "<div>" * 100_000, "<a " + 'x="y" ' * 100_000, "<" * 200_000, "<!" * 100_000, "<a x='" * 50_000, "</p " * 100_000, "<script>" + "</script " * 50_000, "<p>&amp;" * 50_000])
def test_odd_pages_take_time_in_proportion(html):
    began = time.process_time()
    html_template.extract(html, None)
    assert time.process_time() - began < 5
