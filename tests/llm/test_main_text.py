"""Main texts of pages of several layouts, the method's windows, and the given pages by their own mark."""

import re
import time
from html import unescape

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerleaf.llm import main_text as M

LONG = "A long paragraph of prose with a number of words, so that it stands out among short lines. " * 2
L = LONG.strip()
MENU = "<ul><li><a href='/'>Home</a><li><a href='/n'>News of the day</a></ul>"


@pytest.mark.parametrize(("html", "want"), [
    (None, ""),
    ("", ""),
    (" \n ", ""),
    ("Hello  world", "Hello world"),
    (f"<nav>{MENU}</nav><article><h1>T</h1><p>x</article><footer>f</footer>", "T x"),
    (f"<nav>{MENU}<article><h1>T</h1><p>x<p>y</article>", "T x y"),  # the nav was left open
    (f"<header><h1>Site</h1><p>{LONG}</header><main><h2>T</h2><p>a<p>b</main>", "T a b"),
    (f"<div role=navigation>{LONG}</div><div role='main'><p>a</div><div role=complementary>{LONG}</div>", "a"),
    (f"<div class=top>{MENU}</div><h1>Title</h1><div>by A</div><p>{LONG}<p>Short.<p>{LONG}<p>End.<div>&copy; 2020 X</div>", f"Title {L} Short. {L} End."),
    (f"<div>Home</div><div>About</div><div>News</div><div>Shop</div><div>{LONG}</div><div>{LONG}</div><div>Terms</div><div>Imprint</div>", f"{L} {L}"),
    (f"<table><tr><td class=nav>Menu<td><p>{LONG}<p>{LONG}</table>", f"{L} {L}"),
    (f"<body class='has-sidebar comments-open'><div id=page class=no-sidebar><h1>T</h1><p>{LONG}</div><div id=sidebar><p>{LONG}</div>", f"T {L}"),
    (f"<div class=cookie-notice>{LONG}</div><article><p>Tiny.</article><section id=comments><article class=comment>{LONG}</article></section>", "Tiny."),
    (f"<h1>T</h1><p>{LONG}<ol class=commentlist><li>{LONG}<li>{LONG * 9}</ol>", f"T {L}"),
    (f"<form id=all><h1>T</h1><p>{LONG}</form>", f"T {L}"),
    (f"<article><h1>T</h1><form>{LONG}</form><div class='ad-box'>buy</div><p>a<button>b</button><select><option>c</select></article>", "T a"),
    ("<article><p>He<b>ll</b>o <a href=x>li<i>nk</a>ed w<!-- </article> -->ord<br>a &lt;p&gt; &amp;amp; &#8212;&nbsp;&hellip;</p><pre> a\n  b</pre></article>", "Hello linked word a <p> &amp; — … a b"),
    ("<article>a<script>var t='</article>';</script>b<style>p{}</style><template>c</template><p hidden>d<p style='display: none'>e</p>f<svg><text>g</svg></article>", "ab f"),
    (f"<article><div class='entry-header'><h2>T</h2><p>by A</div><p class=teaser>lead<p>{LONG}<div class='sideBar'>x</div><div class=ad-free>y</div></article><div class=page-header>z", f"T by A lead {L} y"),
    (f"<div id=side-bar><p>{LONG}</div><div class=post><h1>T</h1><p>{LONG}<p>{LONG}</div><div class=navBar>{LONG}</div>", f"T {L} {L}"),
    ("<p>a<p class='x", "a"),
    ("<article><p>a</p><script>never closed <p>b</p>", "a"),
    ("<article><table><tr><td>1<td>2<tr><th>3</table><dl><dt>x<dd>y</dl></article>", "1 2 3 x y"),
])
def test_pages(html, want):
    assert M.main_text_of(html) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=40), st.integers(0, 100))
def test_stretches_are_the_lines_in_windows_above_the_bound(lengths, above):
    covered = [any(sum(lengths[i : i + M.WINDOW]) > above for i in range(max(0, j - M.WINDOW + 1), j + 1)) for j in range(len(lengths))]
    runs, j = [], 0
    while j < len(lengths):
        if covered[j]:
            e = j
            while e < len(lengths) and covered[e]:
                e += 1
            some = [x for x in range(j, e) if lengths[x]]
            runs.append((some[0], some[-1] + 1))
            j = e
        j += 1
    assert M.stretches(lengths, above) == runs


@pytest.mark.parametrize("html", ["<b>" * 200_000, "<div>" * 50_000 + "</p>" * 50_000, "<" * 300_000, "<!--" * 100_000, "<a b='" * 100_000, "<title>" * 50_000, "<x a=\"" + "a='b " * 50_000, "<ul><li>" * 50_000, "<p class=ad>" * 50_000])
def test_work_grows_with_the_page(html):
    began = time.time()
    M.main_text_of(html)
    assert time.time() - began < 20


def test_long_pages_are_whole():
    paragraphs = [f"paragraph {i}" for i in range(50_000)]
    assert M.main_text_of("<nav>x</nav><article>" + "<p>".join(["", *paragraphs]) + "</article>") == " ".join(paragraphs)


def test_given_pages_and_awkward_tables(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumns({"Text": F.lit(1), "N_CHARS": F.lit(2), "c0": F.lit(3)})
    got = M.main_texts(pages)
    assert got.columns == ["page_id", "url", "c0", "text", "n_chars"]
    given_pages = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in got.collect():
        inner = re.search(r"(?s)<article>(.*)</article>", given_pages[r["page_id"]])[1]
        assert r["text"] == " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", inner))).split()) and r["n_chars"] == len(r["text"])
    rows = spark.createDataFrame([(1, None), (1, None), (None, "<p>é\U0001f600</p>")], "page_id long, html string")
    assert sorted(map(repr, map(tuple, M.main_texts(rows).collect()))) == sorted(map(repr, [(1, "", 0), (1, "", 0), (None, "é\U0001f600", 2)]))
    assert M.main_texts(rows.limit(0)).collect() == []
