"""Main text of small pages, and the minimum cut against brute force."""

from __future__ import annotations

import itertools
import random
import time

import pytest
from eventmarts.llm import html_extract as H

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{margin:0}</style>
<script>var t="</p>";track(1);</script></head><body class="sidebar-left">
<header><a href="/">Site name</a></header>
<nav><ul><li><a href="/a">One,</a><li><a href="/b">two</a></ul></nav><!-- ad 1 -->
<div class="ad">Buy this long and well written sentence about a thing that you never wanted.</div>
<div id="cookie-notice">We use cookies to improve your visit. Please accept them all.</div>
<article><h1>A  title &lt;here&gt;</h1><p><b>First   paragraph.<br>Same one<p>Aition.</p>
<p>With a <a href="#">link</a> &amp and a < b.</p><form>Your mail <input> <button>Go</button></form>
<aside>See also: this other story which is long enough to look like prose.</aside>
<blockquote>Quoted, with <i>inline</i> tags.</blockquote></article>
<section id="comments"><p>Reader: I disagree with this article in every way, as I always do.</p></section>
<footer>&copy; site &middot; All of it.</footer></body></html>"""


def test_page_with_every_kind_of_boilerplate():
    assert H.main_text(PAGE).split("\n\n") == [
        "A title <here>", "First paragraph. Same one", "Aition.", "With a link & and a < b.",
        "Quoted, with inline tags."]


def test_without_semantic_tags_the_cut_uses_text_and_neighbours():
    prose = " ".join(["This is a sentence of the story."] * 6)
    page = (f"<div><a href=x>Home</a> <a href=y>News</a></div><div><div>{prose}</div>"
            f"<div>Short line here.</div><div>{prose}</div></div><div><a href=z>More</a></div>")
    assert H.main_text(page) == "\n\n".join([prose, "Short line here.", prose])


def test_broken_and_empty_pages():
    assert [H.main_text(x) for x in (None, "", "   ", "<p", "<!-- open", "<script>x")] == [""] * 6
    text = "Some words that make a real paragraph of text, which ends here."
    for page in (text, f"<p>{text}", f"<article><div><p>{text}</article></div></p>",
                 f"<html><head><title>x</title><p>{text}", f"<p title='a>b'>{text}</p><unclosed",
                 f"<main><p>{text}<ul></p></ul></main></main>"):
        assert H.main_text(page) == text, page
    assert H.main_text("<table><tr><td>" + text + "<td>" + text) == text + "\n\n" + text


def test_minimum_cut_equals_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 6)
        caps = [(a, b, rng.randint(0, 9)) for a in range(n + 2) for b in range(n + 2)
                if a != b and rng.random() < 0.5]
        graph = H.FlowGraph(n + 2)
        for a, b, c in caps:
            graph.edge(a, b, c)
        s, t = n, n + 1
        flow = graph.run(s, t)
        best = min(sum(c for a, b, c in caps if a in left | {s} and b not in left | {s})
                   for k in range(n + 1) for left in map(set, itertools.combinations(range(n), k)))
        lost = graph.reaches(t)
        kept = {i for i in range(n) if not lost[i]} | {s}
        assert flow == best == sum(c for a, b, c in caps if a in kept and b not in kept)


def test_long_pages_stay_linear():
    text = "A paragraph with enough words to be counted as prose by all means."
    page = "<article>" + f"<p>{text}</p>" * 20_000 + "</article>"
    assert H.main_text(page).count(text) == 20_000


def test_rows(spark):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (2, None, None, 5), (None, "v", "", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    out = H.extract(df).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in out) == [
        (0, 0), (1, len(H.main_text(PAGE))), (1, len(H.main_text(PAGE))), (2, 0)]
    assert H.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<div>x", "<span>x", "<p><i>x", "<ul><li>x", "<a><div>x", "<b><div>y</b>", "<div><b>x</section>"])
def test_deep_pages_stay_linear(page):
    t = time.perf_counter()
    H.main_text(page * 100_000)
    assert time.perf_counter() - t < 15  # about 3 s; quadratic work took minutes
