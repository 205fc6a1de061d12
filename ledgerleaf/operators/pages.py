"""Facts from index pages and company pages."""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from ..functions.batches import with_helper
from ..sources.scratch import cut
from . import index as I

SITE = "https://www.sec.gov"
DOCUMENTS = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("description", "href", "type")]))
FACTS = T.StructType([*[T.StructField(c, T.StringType()) for c in ("filed", "period", "inc", "end", "sic")], T.StructField("documents", DOCUMENTS)])
COMPANY = T.StructType([T.StructField(c, T.StringType()) for c in ("name", "sic", "location", "inc", "end")])
# Labels and names that the pages use.
FILED, PERIOD, INC, END = "Filing Date", "Period of Report", ("State of Inc.", "State of Incorp.", "State of Incorporation."), "Fiscal Year End"
TABLE, WHOLE = "Document Format Files", "Complete submission text file"

#: Why an index row is rejected.
REASONS = NO_PAGE, THROTTLED_PAGE, NO_PERIOD, NO_LINK = "no page", "throttled page", "no period of report", "no document link"

_TAG = re.compile(r"""<!--.*?-->|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>""", re.DOTALL)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
#: Elements that may hold a fact, and what an open one of them ends if it was left open.
_HOLDERS = frozenset("div p span table tr td th a".split())
_LEFT_OPEN = {"td": ("cell",), "th": ("cell",), "tr": ("cell", "row"), "p": ("ident",)}


def _attrs(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)} if text else {}


class _Held:
    """An element whose text is gathered: its pieces in order, its links, and what it lies in."""

    __slots__ = ("tag", "mark", "href", "at", "inside", "depth", "pieces", "links")

    def __init__(self, tag: str, mark: str, href: str, at: int, inside: tuple[str, ...]) -> None:
        self.tag, self.mark, self.href, self.at, self.inside, self.depth, self.pieces, self.links = tag, mark, href, at, inside, 1, [], []

    def text(self) -> str:
        return "".join(self.pieces)


def _mark(name: str, attrs: dict[str, str], inside: tuple[str, ...]) -> str | None:
    """What an element is held as, if it is."""
    if name == "a":
        return "link"
    if name == "div":
        return next((c for c in attrs.get("class", "").split() if c in ("infoHead", "info", "companyInfo")), None)
    if name == "p":
        return "ident" if "identInfo" in attrs.get("class", "").split() else None
    if name == "span":
        return "name" if "companyName" in attrs.get("class", "").split() else None
    if name == "table":
        return "documents" if attrs.get("summary") == TABLE else None
    return "row" if name == "tr" else "cell"


def _elements(html: str) -> list[_Held]:
    """The held elements of a page in the order of their ends, references resolved. Cells, rows and paragraphs that are left
    open end where the next one starts or what is around them ends."""
    held: list[_Held] = []
    out: list[_Held] = []
    pieces: list[str] = []

    def end(first: int) -> None:
        while len(held) > first:
            one = held.pop()
            one.pieces = pieces[one.at :]
            out.append(one)

    parts = iter(_TAG.split(html))  # text, then a slash, name and attributes and the next text, and so on
    text = next(parts)
    for slash, name, attributes, following in zip(parts, parts, parts, parts, strict=True):
        if held and text:
            pieces.append(unescape(text) if "&" in text else text)
        text = following
        if not name or (name := name.lower()) not in _HOLDERS:
            continue
        if slash:
            for i, h in enumerate(held):
                if h.tag == name:
                    h.depth -= 1
                    if h.depth == 0:
                        end(i)
                        break
            continue
        if held and (ends := _LEFT_OPEN.get(name)):
            for i, h in enumerate(held):
                if h.mark in ends:
                    end(i)
                    break
        inside = (*held[-1].inside, held[-1].mark) if held else ()
        for h in held:
            if h.tag == name:
                h.depth += 1
        plain = name in ("tr", "td", "th")
        if plain and "documents" not in inside or name == "a" and not inside:
            continue
        attrs = {} if plain else _attrs(attributes)
        if mark := _mark(name, attrs, inside):
            held.append(one := _Held(name, mark, attrs.get("href", ""), len(pieces), inside))
            if mark == "link":
                for h in held[:-1]:
                    h.links.append(one)
    if held and text:
        pieces.append(unescape(text))
    end(0)
    return out


def _page(html: str | None) -> dict | None:
    """H1, H2 and H3 of one index page, in one scan."""
    if html is None:
        return None
    out: dict = dict.fromkeys(FACTS.names)
    head, ident, cells, rows = None, None, [], None
    for h in _elements(html):
        if h.mark == "infoHead":
            head = h.text().strip()
        elif h.mark == "info":
            if head == FILED:
                out["filed"] = h.text()
            elif head == PERIOD:
                out["period"] = h.text()
            head = None
        elif h.mark == "ident":
            if out["sic"] is None:
                out["sic"] = next((x.text() for x in h.links if "SIC" in x.href), None)
            if ident is None and "companyInfo" in h.inside:
                ident = h.text()
        elif h.mark == "cell":
            cells.append(h)
        elif h.mark == "row":
            rows = [] if rows is None else rows
            rows.append(cells)
            cells = []
        elif h.mark == "documents" and out["documents"] is None:
            out["documents"] = [{"description": c[1].text(), "href": c[2].links[0].href or None if c[2].links else None, "type": c[3].text()} for c in (rows or [])[1:] if len(c) >= 4]
    for part in (ident or "").split("|"):
        name, _, value = part.partition(":")
        if name.strip() in INC:
            out["inc"] = value.split(":")[0].strip()
    if m := re.search(rf"{END}: *(\d{{4}})", ident or ""):
        out["end"] = m[1]
    return out


def _company(html: str | None) -> dict | None:
    """H4 of one company page."""
    if html is None:
        return None
    out: dict = dict.fromkeys(COMPANY.names)
    for h in _elements(html):
        if h.mark == "name" and out["name"] is None:
            out["name"] = (h.pieces[0].strip() if h.pieces else "") or None
        elif h.mark == "link":
            for key, sign in (("sic", ";SIC="), ("location", ";State=")):
                if out[key] is None and sign in h.href:
                    out[key] = h.text().strip() or None
        elif h.mark == "companyInfo":
            for i, piece in enumerate(h.pieces):
                if "State of Inc" in piece and out["inc"] is None and i + 1 < len(h.pieces):
                    out["inc"] = h.pieces[i + 1].strip() or None
                if END in piece and out["end"] is None:
                    out["end"] = (piece.split(END)[1].split() or [None])[-1]
    return out


def page_facts(pages: DataFrame, *names: str) -> DataFrame:
    """H1, H2 and the part of H3 that reads markup: the struct facts (filed, period, inc, end, sic, documents; or those named)
    in the place of html; null for a page without a body. Entities are resolved; nested elements, other quotes and more
    attributes do not matter. Markup goes to Python and does not come back."""
    kind = T.StructType([FACTS[c] for c in names or FACTS.names])
    return with_helper(pages, "facts", kind, _page, "html", without=("html",))


def page_dates(pages: DataFrame) -> DataFrame:
    """H1: `Filing Date` and `Period of Report`, the text of the div.info after the last head of that name, for html."""
    return page_facts(pages, "filed", "period").withColumns({FILED: F.col("facts.filed"), PERIOD: F.col("facts.period")}).drop("facts")


def page_company_facts(pages: DataFrame) -> DataFrame:
    """H2: State of Inc, Fiscal Year End and SIC for html; the state of location is never on an index page."""
    return page_facts(pages, "inc", "end", "sic").withColumns({"State of Inc": F.col("facts.inc"), END: F.col("facts.end"), "SIC": F.col("facts.sic")}).drop("facts")


def page_documents(pages: DataFrame) -> DataFrame:
    """H3, the part that reads markup: documents, the rows after the header of the table of document files, for html."""
    return page_facts(pages, "documents").withColumn("documents", F.col("facts.documents")).drop("facts")


def choose_links(df: DataFrame, types: list[str]) -> DataFrame:
    """H3 on documents: the first row that has a wanted type and an htm link, or else is the whole submission, ends the
    search. Adds htm_file_link, complete_text_file_link (as it was, if none is found) and document_type."""
    wanted = lambda d: d["type"].isin(types)
    htm = lambda d: wanted(d) & F.substring_index(d["href"], ".", -1).isin("htm", "html")
    whole = lambda d: ~wanted(d) & (d["description"] == WHOLE)
    stop = F.try_element_at(F.filter("documents", lambda d: htm(d) | whole(d)), F.lit(1))
    seen = F.try_element_at(F.filter("documents", wanted), F.lit(-1))["type"]
    link = F.concat(F.lit(SITE), F.col("_stop.href"))
    is_htm = F.coalesce(htm(F.col("_stop")), F.lit(False))
    rows = df.withColumn("_stop", stop)
    held = F.col("complete_text_file_link") if "complete_text_file_link" in df.columns else F.lit(None).cast("string")
    kind = F.when(is_htm, F.col("_stop.type")).when(F.col("_stop").isNotNull(), F.col("Type") if "Type" in df.columns else F.lit(None).cast("string")).otherwise(seen)
    return rows.withColumns({"htm_file_link": F.when(is_htm, link), "complete_text_file_link": F.when(F.col("_stop").isNotNull() & ~is_htm, link).otherwise(held), "document_type": kind}).drop("_stop")


def company_facts(pages: DataFrame) -> DataFrame:
    """H4: (CIK, Company Name, SIC, State location, State of Inc, Fiscal Year End) from company pages (cik, html)."""
    rows = with_helper(pages.select(F.col("cik").alias("CIK"), "html"), "facts", COMPANY, _company, "html")
    return rows.select("CIK", F.col("facts.name").alias("Company Name"), F.col("facts.sic").alias("SIC"), F.col("facts.location").alias("State location"), F.col("facts.inc").alias("State of Inc"), F.col("facts.end").alias(END))


def enrich_index(index: DataFrame, pages: DataFrame, company_pages: DataFrame, types: list[str], seen: Observation | None = None, row: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """H5: index rows with all facts, link and filename; and the rejects: every other index row with its reason (no page,
    throttled page, no period of report, no document link).

    Throttled pages are told by a look for their notice and not parsed; the others are parsed to short columns, all facts in
    one scan, before the join, so no markup is shuffled. The joined rows are written once, for both results; seen, if given,
    observes in that pass how many rows there are, are done, and are rejected for each reason (A1). row: as in attach_pages."""
    throttled = F.coalesce(F.col("html").contains(I.THROTTLED), F.lit(False))
    looked = pages.withColumn("_throttled", throttled).withColumn("html", F.when(~throttled, F.col("html")))
    facts = page_facts(looked).select("url", *row, "_throttled", "facts")
    rows = index.withColumnRenamed("html_index", "url").join(facts, ["url", *row], "left").withColumnRenamed("url", "html_index")
    given = {FILED: "filed", PERIOD: "period", "State of Inc": "inc", END: "end", "SIC": "sic"}
    rows = rows.withColumns({c: F.col(f"facts.{k}") for c, k in given.items()} | {"State location": F.lit(None).cast("string"), "documents": F.col("facts.documents")}).drop("facts")
    rows = choose_links(rows, types)
    linked = F.col("htm_file_link").isNotNull() | F.coalesce(F.exists("documents", lambda d: d["description"] == WHOLE), F.lit(False))
    link = F.coalesce("htm_file_link", "complete_text_file_link").isNotNull()
    reason = F.when(F.col("_throttled").isNull(), NO_PAGE).when(F.col("_throttled"), THROTTLED_PAGE).when(F.col(f"`{PERIOD}`").isNull(), NO_PERIOD).when(~(linked & link), NO_LINK)
    rows = rows.withColumn("_reason", reason).drop("_throttled", "documents")
    if seen is not None:
        rows = rows.observe(seen, F.count("*").alias("todo"), F.count_if(F.col("_reason").isNull()).alias("done"), *[F.count_if(F.coalesce(F.col("_reason") == r, F.lit(False))).alias(r) for r in REASONS])
    rows = cut(rows, "enriched")
    kept = I.resolve_document_link(I.fill_company_info(rows.where("_reason IS NULL"), company_facts(company_pages)))
    name = I.filing_name(F.col("CIK"), F.col("document_type"), F.col(f"`{PERIOD}`"), F.col("complete_text_file_link"), F.col("extension"))
    kept = kept.withColumn("htm_file_link", F.replace("htm_file_link", F.lit("ix?doc=/"), F.lit(""))).withColumn("filename", name)
    return kept.drop("_reason", "link", "extension", "document_type"), rows.where("_reason IS NOT NULL").select("html_index", F.col("_reason").alias("reason"))
