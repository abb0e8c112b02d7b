import html
import math
import re

import numpy as np
import pytest

from newsloom.llm.boosting import fit
from newsloom.llm.dom import Page
from newsloom.llm.html_extraction import decode, extract_many, extract_pages, labelled, trained, training_page, without_hidden


@pytest.fixture(scope="module")
def trees():
    return trained()


def article(source):
    """The blocks of a page of the test tables, by its known template."""
    inside = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", inside)
    return [t for p in parts if (t := " ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()))]


def test_test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/pages.parquet")
    got = {r["page_id"]: r for r in extract_pages(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        text = "\n\n".join(article(r["html"]))
        assert got[r["page_id"]]["text"] == text and got[r["page_id"]]["n_chars"] == len(text) and got[r["page_id"]]["url"] == r["url"]


def test_unseen_training_pages(trees):
    rows = [r for s in range(9000, 9150) if (r := labelled(training_page(s))) is not None and len(r[1])]
    x, y = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    assert ((trees.logit(x) > 0) == (y > 0)).mean() > 0.97


PAGE = """<!DOCTYPE html><html><body><header><h1>The Site</h1><nav><a href=/>Home</a></nav></header>
<div class="cookie-banner">We use cookies</div><article><h1>A &amp; B</h1><p>First   paragraph
with lines, and more words in it.<p>Second one.</p><div class="ad">Buy this now</div><script>var x = "<p>no</p>";</script>
<p>Third &lt;one&gt;.</p><form><p>Subscribe here</p></form></article>
<section id="comments"><h3>Comments</h3><p>Nice article, I liked it a lot, thank you.</p></section>
<aside><p>Related things to read</p></aside><footer>&copy; us</footer></body></html>"""


def test_parts_that_are_no_article(trees):
    assert extract_many([PAGE], trees)[0] == ["A & B", "First paragraph with lines, and more words in it.", "Second one.", "Third <one>."]


def test_odd_pages(spark, trees):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<p"), (5, "u", "<!-- open"), (6, "u", "<script>x"), (None, "u", PAGE), (1, "u", "<article><p>" + "word " * 50_000), (7, "u", "<div>" * 3000 + "deep"), (8, "u", "<p title='a>b'>x</p> a < b")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    out = extract_pages(df).collect()
    assert len(out) == len(rows) and all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in out)
    assert max(r["n_chars"] for r in out) == 50_000 * 5 - 1
    assert extract_pages(df.limit(0)).count() == 0


def test_dropped_nodes_have_no_kept_descendants():
    page = Page("<div><section><p>a b c</p><p>d</p></section><div><p>e</p></div></div>")
    rng = np.random.default_rng(0)
    for _ in range(200):
        own = [0] * len(page.tags)
        for node, text, _ in page.blocks:
            own[node] = len(text)
        kept = decode(page, rng.normal(0, 2, len(page.tags)), own, cost=1.0)
        for k in range(1, len(page.tags)):
            if kept[k] and own[k]:
                p = page.parents[k]
                assert kept[p] or not own[p]


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    assert ((fit(x, y, 40, 3).logit(x) > 0) == (y > 0)).mean() > 0.95


def test_implied_end_tags():
    page = Page("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table><p>f<div>g</div>h<br>i")
    assert [t for _, t, _ in page.blocks] == ["a", "b", "c", "d", "e", "f", "g", "h i"]


def test_elements_do_not_swallow_the_page():
    def texts(html):
        page = Page(html)
        without_hidden(page)
        return [t for _, t, _ in page.blocks]

    for start in ("<svg viewBox='0 0 1 1'/>", "<svg><path d='M0'/>", "<math/>", "<object data=x>", "<svg><title>t</title><path/></svg>"):
        assert texts(f"<body>{start}<p>one</p><svg></svg><p>two</p>") == ["one", "two"]
    for start in ("<button>", "<select><option>"):
        assert texts(f"<body>{start}<p>one</p><p>two</p>") == ["one", "two"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds, <object>a plot</object>") == ["so x=1 holds, a plot"]
    assert texts("<p>an icon <svg><path/></svg> within") == ["an icon within"]
    for shown in ('class="lead hidden md:block"', "title='a hidden gem'", 'data-style="display: none"'):
        assert texts(f"<div {shown}>seen</div>") == ["seen"]
    for gone in ("hidden", "class=a hidden", 'HIDDEN=""', 'style="color: red; Display : none"'):
        assert texts(f"<div {gone}>unseen</div><p>seen</p>") == ["seen"]


def test_deep_nesting_is_linear():
    import time

    for source in ("<div>" * 200_000 + "deep", "<ul><li>" + "<div>" * 5000 + "<li>x" * 20_000, "<table><td>" + "<div>" * 20_000 + "</p>" * 20_000):
        start = time.time()
        Page(source)
        assert time.time() - start < 2


def test_references_end_at_tags():
    assert [t for _, t, _ in Page("<p>&<b>lt;</b> a &amp; b &#<i>60;</i>").blocks] == ["&lt; a & b &#60;"]


def test_pages_without_telling_names(trees):
    plain = """<html><body><div class="top"><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a></div><div class="c1"><h1>Title of the story</h1>
<p>First long paragraph of the article, with a number of words that make it long enough, and more.</p><ul><li><a href=/a>An important source document</a></li><li><a href=/b>Another document of the court</a></li></ul>
<p>Last long paragraph of the article, which closes the story, as paragraphs do at the end of it.</p></div><div class="bottom">Copyright 2024 Some Site. All rights reserved.</div></body></html>"""
    assert [b[:5] for b in extract_many([plain], trees)[0]] == ["Title", "First", "An im", "Anoth", "Last "]


def test_decoding_is_the_best_of_all_labellings():
    from itertools import product

    rng = np.random.default_rng(6)
    for source in ("<div>a<section><p>b</p>c</section><p>d</p></div>", "<div><p>a</p><p>b</p><div><p>c</p></div></div>", "<ul><li>a<li>b<li>c</ul>d"):
        page = Page(source)
        n = len(page.tags)
        own = [0] * n
        for node, text, _ in page.blocks:
            own[node] += len(text)
        for _ in range(20):
            logit = rng.normal(0, 2, n)
            gain = [float(g) * (0.5 + np.log1p(o)) for g, o in zip(logit, own, strict=True)]

            def value(states):
                for k in range(1, n):
                    up = states[page.parents[k]]
                    if up != "mixed" and states[k] != up:
                        return -math.inf
                return sum(g if s == "keep" else -g if s == "drop" else (abs(g) if o else 0.0) - 1.0 for s, g, o in zip(states, gain, own, strict=True))

            best = max(product(("keep", "drop", "mixed"), repeat=n), key=value)
            kept = decode(page, logit, own, cost=1.0)
            assert [bool(x) for x in kept] == [s == "keep" or s == "mixed" and g > 0 for s, g in zip(best, gain, strict=True)]


def prose(n, k=0):
    return [f"Paragraph {k + i} of the article tells what happened, at some length, and with commas, so that it reads as prose does. It goes on for a while, names who said what, and ends as it should." + " More of it." * (9 + i) for i in range(n)]


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_no_name_costs_an_article(trees, tag):
    """Each role word alone and beside others, and names nobody trained on, on the element of an article."""
    from newsloom.llm.html_extraction import TOKEN_ROLE

    names = [f"{a}={v}" for w in TOKEN_ROLE for a, v in (("class", w), ("id", f'"{w}-kvist"'), ("class", f'"grand-{w}"'))]
    names += ["class=x9", "id=contact", "class=related-work", "class=ad-hoc-story", "class='reader-friendly'", "class=feedback-loops", "class=more", "class=cookie-recipe", "class=about-brand", "class=news-alert", "class=social-policy"]
    text = prose(4)
    for name in ["", *names]:
        page = f"<html><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><{tag} {name}><h1>A headline of the day</h1>{''.join(f'<p>{t}</p>' for t in text)}</{tag}><footer>&copy; Some Site</footer></body></html>"
        assert extract_many([page], trees)[0] == ["A headline of the day", *text], name


def test_trees_against_a_sum_of_leaves(trees):
    x, _ = labelled(training_page(3))
    for row, logit in zip(x[:40], trees.logit(x[:40]), strict=True):
        total = trees.bias
        for f, t, leaves in zip(trees.features, trees.thresholds, trees.leaves, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += leaves[node - len(f)]
        assert abs(total - logit) < 1e-9


def test_parts_beside_and_inside_an_article(trees):
    """Comments that nothing names go, with the page's article element to tell; parts of an article stay whatever they are called."""
    text = prose(4)
    nav, foot = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>", "<footer>&copy; Site</footer>"
    start, end = "<article><h1>Head of it all</h1>" + "".join(f"<p>{t}</p>" for t in text[:2]), "".join(f"<p>{t}</p>" for t in text[2:]) + "</article>"
    whole = ["Head of it all", *text]
    kept = lambda body: extract_many([f"<html><body>{nav}{body}{foot}</body></html>"], trees)[0]
    two = "<p>Nice one, I like it.</p><p>I do not agree at all.</p></{}>"
    for tag, name in (("div", "class=kommentare"), ("section", "class=c7"), ("section", "id=comments")):
        assert kept(f"{start}{end}<{tag} {name}><h3>Comments</h3>{two.format(tag)}") == whole
    for inner in ('<div class="ad">Buy this now</div>', '<div class="related"><h3>Related</h3><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></div>'):
        assert kept(start + inner + end) == whole
    more = [" ".join(prose(2, 9))]  # a short one may be a notice or a teaser
    for inner in ('<div class="more-content"><p>{}</p></div>', '<div class="alert"><p>{}</p></div>', "<fieldset><p>{}</p></fieldset>"):
        assert kept(start + inner.format(more[0]) + end) == [*whole[:3], *more, *whole[3:]]
    links = "<ul><li><a href=/1>Read the whole report of the council</a></li><li><a href=/2>Minutes of the meeting in May</a></li></ul>"
    assert kept(start + links + end) == [*whole[:3], "Read the whole report of the council", "Minutes of the meeting in May", *whole[3:]]
