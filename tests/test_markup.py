"""Pages and markup against texts written by hand."""

import pytest
from pyspark.sql import Observation

from ledgerleaf.functions import markup as M
from ledgerleaf.operators import index as I, pages as H

PAGE = """<html><body><div class='infoHead first'>Filing <i>Date</i></div> <!-- <div class="info">no</div> -->
<div id=a class="x info">2010-03-01</div><div class="infoHead">Period of Report</div><div class="info">2009-12-<b>31</b></div>
<div class="companyInfo"><span class="companyName">A&amp;B</span><p class="identInfo">IRS No.: 1 | State of Incorp.: <strong>N&amp;Y</strong> | Fiscal Year End: 1231<br>
SIC: <a href='/x?a=1&amp;SIC=7'>73<b>70</b></a></div>
<table summary='Other'><tr><th>x</table>
<table summary="Document Format Files"><tr><th>Seq<th>Description<th>Document<th>Type
<tr><td>1<td>A &quot;report&quot;<td><a href="/ix?doc=/a/1.htm">1.htm</a> iXBRL<td>10-K</td>
<tr><td>2</td><td>Complete submission text file</td><td><a class=y href='/b/1.txt'>t</a></td><td>&nbsp;</td></tr></table></body></html>"""


def test_page_facts():
    got = H._page(PAGE)
    assert (got["filed"], got["period"], got["inc"], got["end"], got["sic"]) == ("2010-03-01", "2009-12-31", "N&Y", "1231", "7370")
    assert [(d["description"].strip(), d["href"], d["type"].strip()) for d in got["documents"]] == [('A "report"', "/ix?doc=/a/1.htm", "10-K"), ("Complete submission text file", "/b/1.txt", "")]
    assert H._page(None) is None and set(H._page("").values()) == {None} and H._page("<div class=info>x<")["filed"] is None


def test_company_facts(spark):
    html = """<div class='companyInfo'><span class='companyName'>A &amp; B <acronym>CIK</acronym></span><p class="identInfo"><a href="/b?a=1;SIC=5">5</a>
State location: <a href='/b?a=1;State=DE'>DE</a> | State of Inc.: <strong>N&amp;Y</strong> | Fiscal Year End: 1231<br></p></div>"""
    rows = spark.createDataFrame([("1", html), ("2", None), ("3", "<p>")], "cik string, html string")
    got = {r["CIK"]: tuple(r)[1:] for r in H.company_facts(rows).collect()}
    assert got == {"1": ("A & B", "5", "DE", "N&Y", "1231"), "2": (None,) * 5, "3": (None,) * 5}


def test_heads_in_pieces_are_read(spark):
    """No look at the raw page may keep it from being read."""
    texts = ["Period of <b>Report</b>", "Period&#32;of Report", "Per<!-- -->iod of Report", "<i>P</i>eriod of Report "]
    pages = spark.createDataFrame([(str(i), PAGE.replace("Period of Report", t)) for i, t in enumerate(texts)], "url string, html string")
    index = spark.createDataFrame([("1", "n", "10-K", "2010-03-01", "x/0-1.txt", str(i)) for i in range(4)], "CIK string, Company string, Type string, Date string, complete_text_file_link string, html_index string")
    kept, rejected = H.enrich_index(index, pages, spark.createDataFrame([], "cik string, html string"), ["10-K"])
    assert kept.count() == 4 and rejected.count() == 0


def test_every_index_row_is_enriched_or_rejected(spark):
    pages = spark.createDataFrame([("a", PAGE), ("b", PAGE + I.THROTTLED), ("c", PAGE.replace("Period of Report", "Other")), ("d", PAGE.replace("Complete", "Part").replace("10-K", "X")), ("f", None)], "url string, html string")
    index = spark.createDataFrame([("1", "n", "10-K", "2010-03-01", "x/0-1.txt", u) for u in "abcdef"], "CIK string, Company string, Type string, Date string, complete_text_file_link string, html_index string")
    kept, rejected = H.enrich_index(index, pages, spark.createDataFrame([], "cik string, html string"), ["10-K"], seen := Observation())
    assert seen.get == {"todo": 6, "done": 1, "no page": 1, "throttled page": 1, "no period of report": 2, "no document link": 1}
    assert [(r["html_index"], r["filename"], r["SIC"]) for r in kept.collect()] == [("a", "1_10K_2009_0-1.htm", "7370")]
    assert sorted(map(tuple, rejected.collect())) == [("b", "throttled page"), ("c", "no period of report"), ("d", "no document link"), ("e", "no page"), ("f", "no period of report")]


@pytest.mark.parametrize(("html", "want"), [
    # implied ends
    ("<table><tr><td><b>x<td>y</table>", "<table><tr><td><b>x</b></td><td>y</td></tr></table>"),
    ("<p>a<p>b", "<p>a</p><p>b</p>"),
    ("<p><b>a<p>b</b>", "<p><b>a</b></p><p>b</p>"),
    ("bare text<div>x</div>more", "<p>bare text</p><div>x</div><p>more</p>"),
    ("<ul><li>a<li>b</ul>", "<ul><li>a</li><li>b</li></ul>"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
    ("<p>a<table><tr><td>x</table>b", "<p>a</p><table><tr><td>x</td></tr></table><p>b</p>"),
    ("<p>a<h2>b</h2>c", "<p>a</p><h2>b</h2><p>c</p>"),
    ("<h1>a<p>b", "<h1>a</h1><p>b</p>"),
    ("<h3>a<table><tr><td>b</table>", "<h3>a</h3><table><tr><td>b</td></tr></table>"),
    ("<h1>a<h2>b</h2></h1>c", "<h1>a<h2>b</h2></h1><p>c</p>"),
    ("<form>a<form>b", "<form>a</form><form>b</form>"),
    ("<h4>a<form>b</form>", "<h4>a</h4><form>b</form>"),
    ("<p>a<fieldset><legend>b<fieldset>c", "<p>a</p><fieldset><legend>b</legend><fieldset>c</fieldset></fieldset>"),
    ("<ul>a<ol>b", "<ul>a</ul><ol>b</ol>"),
    ("<ul><li>a<ol><li>b</ol>c</ul>", "<ul><li>a<ol><li>b</li></ol>c</li></ul>"),
    ("<select><option>a<option>b<optgroup>c</select>", "<select><option>a</option><option>b</option><optgroup>c</optgroup></select>"),
    ("<a>x<a>y", "<a>x</a><a>y</a>"),
    ("<a>x<table><tr><td>y</table>", "<a>x</a><table><tr><td>y</td></tr></table>"),
    ("<font>a<center>b</center>c", "<font>a</font><center>b</center><p>c</p>"),
    ("<pre>a<ul><li>b</ul>", "<pre>a</pre><ul><li>b</li></ul>"),
    ("<tr><td>a<td>b<tr><td>c", "<tr><td>a</td><td>b</td></tr><tr><td>c</td></tr>"),
    ("<table><thead><tr><th>a<tbody><tr><td>b<tfoot><tr><td>c</table>", "<table><thead><tr><th>a</th></tr></thead><tbody><tr><td>b</td></tr></tbody><tfoot><tr><td>c</td></tr></tfoot></table>"),
    ("<table><caption>a<tr><td>b</table>", "<table><caption>a</caption><tr><td>b</td></tr></table>"),
    # end tags by rank
    ("<p><span>Item 1.</p><p>Business</p>", "<p><span>Item 1.</span></p><p>Business</p>"),
    ("<div><span>a</div>b</span>", "<div><span>a</span></div><p>b</p>"),
    ("<span><div>a</span>b</div>c", "<span><div>ab</div>c</span>"),
    ("<b><i>a</b>b</i>c", "<b><i>a</i></b><p>bc</p>"),
    ("<div>a</p>b</div>", "<div>ab</div>"),
    ("<p><div>a</p>b</div>", "<p></p><div>ab</div>"),
    ("<table><tr><td><p>a</div>b</td></tr></table>", "<table><tr><td><p>ab</p></td></tr></table>"),
    ("<div><table><tr><td>a</div>b</table>c</div>", "<div><table><tr><td>ab</td></tr></table>c</div>"),
    ("<table><tr><td><div>a</td><td>b</table>", "<table><tr><td><div>a</div></td><td>b</td></tr></table>"),
    ("<table><tr><td><table><tr><td>a</tr>b</table>c</table>", "<table><tr><td><table><tr><td>a</td></tr>b</table>c</td></tr></table>"),
    ("<ul><li><b>a</li><li>b</ul>c", "<ul><li><b>a</b></li><li>b</li></ul><p>c</p>"),
    ("<ul><li><div>a</ul>b</div>c</ul>d", "<ul><li><div>ab</div>c</li></ul><p>d</p>"),
    ("<h1><font>a</h1>b</font>", "<h1><font>a</font></h1><p>b</p>"),
    ("<tr>a</table></tr>b", "<tr>a</tr><p>b</p>"),
    ("</p></div></td>a", "<p>a</p>"),
    # what comes again, empty elements, marked sections
    ("<html><head><title>t</title><body><p>x</body>y</html>", "<html><head><title>t</title></head><body><p>x</p></body><p>y</p></html>"),
    ("<body>a<body>b</body>c</body>d", "<body>abc</body><p>d</p>"),
    ("<html><p>a<html>b</html>c", "<html><p>abc</p></html>"),
    ("<head><p>a", "<head></head><p>a</p>"),
    ("<p/>x", "<p></p><p>x</p>"),
    ("<div><span/>a<div/>b</div>c", "<div><span></span>a<div></div>b</div><p>c</p>"),
    ("<p><a name=y/>z</a>w", '<p><a name="y/">z</a>w</p>'),
    ("<p>a<![if !x]>b<![endif]>c", "<p>abc</p>"),
])
def test_broken_markup(html, want):
    assert M.tree(html).markup() == want


@pytest.mark.parametrize(("html", "want"), [
    ("<div><p><span>Item 1.</p><p>Business</p><p>text <b>more</p></div><p>Item 2. Properties", [("ITEM 1", 0), ("ITEM 2", 32)]),
    ("<h1>x<p>Item 1. A<form><p>Item 2. B<form>y", [("ITEM 2", 12)]),
    ("<table><tr><td><div>a</td><td>Item 7. b</table><p>Item 8. c</p>", [("ITEM 7", 3), ("ITEM 8", 18)]),
    ("<ul><li><div>x</ul>Item 3. y</div><li>Item 4. z</ul>", [("ITEM 4", 14)]),
])
def test_headers_of_broken_markup(html, want):
    import re

    text = "\n" + M.html_text(html, ["1"], True)
    found = [(m[1].upper(), m.start()) for m in re.finditer(r"\n[ \t]*(item \d)", text, re.IGNORECASE)]
    assert found == want, repr(text)


def test_deep_and_long_markup():
    import time

    for html in ("<div>" * 20_000 + "x", "<b>" * 20_000 + "</i>" * 20_000, "<p>" * 20_000, "<ul><li>" * 20_000 + "</td>" * 20_000):
        began = time.time()
        M.html_text(html, [], False)
        assert time.time() - began < 10


@pytest.mark.parametrize(("style", "colour"), [
    ("background: white !important", False), ("background-color:#CCE ! important", True), ("background: url(data:image/png;base64,AA==)", True),
    ("background: url('a;b'); background: none", False), ("color: red; BACKGROUND-COLOR : White", False), ("background", False), ("", False),
])
def test_styles(style, colour):
    assert M.coloured(M.Node("td", {"style": style})) == colour


def test_throttled_and_empty_pages_are_no_results(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None), (3, "y" + I.THROTTLED)], "k int, html string")
    assert [r["k"] for r in I.drop_throttled_pages(rows).collect()] == [1]


def test_no_shared_folder_is_an_error_on_a_cluster(spark, monkeypatch):
    from ledgerleaf.sources import scratch

    class Cluster:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="checkpoint"):
        scratch.shared_dir(Cluster)
    assert scratch.shared_dir(spark)


def test_rows_that_share_an_address_have_a_page_each(spark):
    dates = {1: "2010-03-01", 2: "2011-04-02"}
    pages = spark.createDataFrame([(k, "a", PAGE.replace("2010-03-01", d)) for k, d in dates.items()], "k int, url string, html string")
    index = spark.createDataFrame([(k, "a", "7", "10-K", "a.txt") for k in dates], "k int, html_index string, CIK string, Type string, complete_text_file_link string")
    got = I.attach_pages(index, H.page_dates(pages), ("k",)).select("k", "Filing Date").collect()
    kept, rejected = H.enrich_index(index, pages.where("k = 2"), spark.createDataFrame([], "cik string, html string"), ["10-K"], row=("k",))
    assert {r["k"]: r["Filing Date"] for r in got} == dates and len(got) == 2
    assert [(r["k"], r["Filing Date"]) for r in kept.collect()] == [(2, dates[2])] and [r["reason"] for r in rejected.collect()] == ["no page"]
    assert [r["k"] for r in I.new_filings(index, index.where("k = 1"), ("k",)).collect()] == [2]


def test_markup_goes_to_python_and_does_not_come_back(spark):
    pages = spark.createDataFrame([("a", PAGE)], "url string, html string")
    assert H.page_dates(pages).columns == ["url", "Filing Date", "Period of Report"]
    assert H.page_facts(pages, "inc").schema["facts"].dataType.names == ["inc"] and H.page_facts(pages, "inc").first()["facts"]["inc"] == "N&Y"


def test_text_of_a_tree_is_that_of_its_markup():
    pages = [
        "a<p>b &amp; c<p>d<br>e<br class=x>f<td>g</td><th>h", "<table><tr><td bgcolor=red>1<td>2</table>3</>", "<P>x</P><DIV>y</DIV><Li>z",
        "<script>a</p>b</script><style>c&lt;d</style>e", "<title>a &lt; b</title><textarea></p></textarea>", "<ix:n name='q'>5</ix:n>", "<a<b>c</a<b>", "<p a'b=1>c</p>", "<span>AT&T", "a < b &nbsp; </ p>", "<p/>x<p></p>",
    ]
    for page in pages:
        root = M.tree(page)
        assert M.text_of(root) == M.strip_tags(root.markup()), page
