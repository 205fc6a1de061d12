"""Markup helpers that regular expressions cannot replace: stripping tags, coloured tables, spans."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import escape
from html.parser import HTMLParser

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.catalog import header_pattern
from . import rules
from .batches import with_helper
from .text import clean_text, drop_embedded_pdf, drop_text_tables, flatten_text_spans, is_html, main_document

# Fixed values of HTML: elements without content; which open element (first) ends where which other (second) starts; and how
# end tags rank: one never reaches past an open element that ranks above it. All others rank 100.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {
    "a": "a fieldset table td th", "address": "dd dl dt form li ul", "b": "center p td th", "big": "p",
    "caption": "col colgroup tbody tfoot thead tr", "col": "col colgroup tbody tfoot thead tr", "colgroup": "colgroup tbody tfoot thead tr",
    "dd": "dt", "dir": "dd dl dt form ul", "dl": "form li", "dt": "dd dl", "font": "center td th", "form": "form",
    "h1": "fieldset form li p table", "h2": "fieldset form li p table", "h3": "fieldset form li p table", "h4": "fieldset form li p table", "h5": "fieldset form li p table", "h6": "fieldset form li p table",
    "head": "a abbr acronym address b bdo big blockquote body br center cite code dd dfn dir div dl dt fieldset font form frameset h1 h2 h3 h4 h5 h6 hr i iframe img kbd li listing map menu ol p pre q s samp small span strike strong sub sup table tt u ul var xmp",
    "i": "center p td th", "legend": "fieldset", "li": "li", "listing": "dd dl dt fieldset form li table ul", "menu": "dd dl dt form ul", "ol": "form ul", "option": "optgroup option",
    "p": "address blockquote body caption center col colgroup dd dir div dl dt fieldset form frameset h1 h2 h3 h4 h5 h6 head hr li listing menu ol p pre table tbody td tfoot th title tr ul xmp",
    "pre": "dd dl dt fieldset form li table ul", "s": "p", "script": "noscript", "small": "p", "span": "td th", "strike": "p", "style": "body frameset",
    "tbody": "tbody tfoot", "td": "tbody td tfoot th tr", "tfoot": "tbody", "th": "tbody td tfoot th tr", "thead": "tbody tfoot", "title": "body frameset", "tr": "tbody tfoot tr",
    "tt": "p", "u": "p td th", "ul": "address form menu ol pre", "xmp": "dd dl dt fieldset form li table ul",
}
RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220}
ENDED_BY = {tag: frozenset(by.split()) for tag, by in ENDS.items()}
#: Elements that hold no text of their own: text there is a paragraph.
BARE = frozenset(("", "html", "head"))
ONCE = frozenset(("html", "head", "body"))

# Backgrounds that do not count as a colour.
PLAIN = frozenset({"none", "transparent", "#ffffff", "#fff", "white"})

_CLOSERS = (
    (re.compile(r"(<\s*/\s*(?:div|tr|p|li|)\s*>)"), "\\1\n\n"),
    (re.compile(r"(<br\s*/?>)"), "\\1\n\n"),
    (re.compile(r"(<\s*/\s*(?:th|td)\s*>)"), r" \1 "),
)


#: A declaration of a style: semicolons in parentheses and quotes do not end it. What may stand behind its value.
_DECLARATION = re.compile(r"""(?:[^;("']|\([^)]*\)|"[^"]*"|'[^']*'|[("'])+""")
_IMPORTANT = re.compile(r"\s*!\s*important\s*$", re.IGNORECASE)


class _Data(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def strip_tags(html: str | None) -> str | None:
    """T1 for one text: line ends after blocks, blanks around cells, then the text alone. An unfinished tag or character
    reference at the very end is lost, as the parser is never told that the text is over."""
    if html is None:
        return None
    for pattern, by in _CLOSERS:
        html = pattern.sub(by, html)
    parser = _Data()
    parser.feed(html)
    return "".join(parser.parts)


_RULES = [(re.compile(p, re.IGNORECASE), by, re.compile(rules.NEEDED.get(p, ""), re.IGNORECASE)) for p, by in rules.HEADERS + rules.FURNITURE]


def clean(text: str) -> str:
    """T5 for one text, for helpers that need it in mid-way."""
    for c, by in rules.CHARACTERS.items():  # what stands for one is none of them
        text = text.replace(c, by)
    for pattern, by, needed in _RULES:
        if needed.search(text):
            text = pattern.sub(by, text)
    return text


class Node:
    def __init__(self, tag: str, attrs: dict[str, str] | None = None, up: Node | None = None) -> None:
        self.tag, self.attrs, self.up, self.inside = tag, attrs or {}, up, []

    def all(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(x for x in reversed(node.inside) if isinstance(x, Node))

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, Node):
                todo.extend(reversed(x.inside))
            else:
                out.append(x)
        return "".join(out)

    def markup(self) -> str:
        """Every element with its closing tag, also where the source leaves it out."""
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                out.append(x[0])
            elif isinstance(x, str):
                out.append(escape(x, quote=False))
            elif not x.tag:
                todo.extend(reversed(x.inside))
            else:
                out.append(f"<{x.tag}" + "".join(f' {k}="{escape(v)}"' for k, v in x.attrs.items()) + (">" if x.tag not in VOID else "/>"))
                if x.tag not in VOID:
                    todo.append((f"</{x.tag}>",))
                    raw = x.tag in ("script", "style")
                    todo.extend(reversed([(c,) if raw and isinstance(c, str) else c for c in x.inside]))
        return "".join(out)


#: Elements whose content is no plain text, or is none in some versions of the parser.
RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())
#: What strip_tags puts where an element ends.
BEHIND = dict.fromkeys(("div", "tr", "p", "li"), "\n\n") | dict.fromkeys(("td", "th"), "  ")
_NAME = re.compile(r"[a-z][a-z0-9:._-]*")


@lru_cache(maxsize=4096)
def _plain(name: str) -> bool:
    """Whether an element or attribute of this name is read again as it was written."""
    return name not in RAW and _NAME.fullmatch(name) is not None


def text_of(root: Node) -> str:
    """strip_tags of the markup, taken from the tree itself. Where a name or an element's content might be read in another
    way when it is parsed again, the markup is written out and parsed."""
    out: list[str] = []
    todo: list[Node | str] = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x.tag:
            if not (_plain(x.tag) and all(_plain(k) for k in x.attrs)):
                return strip_tags(root.markup()) or ""
            if x.tag == "br" and not x.attrs:
                out.append("\n\n")
            elif x.tag in BEHIND:
                todo.append(BEHIND[x.tag])
        todo.extend(reversed(x.inside))
    return "".join(out)


#: Tags without attributes, as most are.
_START, _END = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*)>"), re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
#: A tag whose last character belongs to a value without quotes, so that it is no empty element.
_VALUE_SLASH = re.compile(r"""=\s*[^\s"'>]*/>$""")


class _Tree(HTMLParser):
    """The tree of a page with its broken markup mended by rule: what an element's start ends (ENDS), and what an end tag may
    end (RANK). An end tag without its element is nothing; one that finds it ends all that was left open inside."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")
        self.open: Counter[str] = Counter()  # how many elements of a name are open
        self.passed = 0  # starts of html, head and body that came again and were passed over, so are as many ends

    def _up(self) -> None:
        self.open[self.at.tag] -= 1
        self.at = self.at.up

    def handle_starttag(self, tag: str, attrs: list) -> None:
        while tag in ENDED_BY.get(self.at.tag, ()):
            self._up()
        if tag in ONCE and (self.open[tag] or tag == "html" and self.at is not self.root or tag == "head" and self.open["body"]):
            self.passed += 1
            return
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.inside.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        """An element written as empty is, whatever its name."""
        self.handle_starttag(tag, attrs)
        if self.at.tag == tag and tag not in VOID | ONCE and not _VALUE_SLASH.search(self.get_starttag_text() or ""):
            self._up()

    def handle_endtag(self, tag: str) -> None:
        if tag in ONCE and self.passed:
            self.passed -= 1
            return
        if not self.open[tag]:
            return
        rank, node = RANK.get(tag, 100), self.at
        while node.tag != tag:
            if RANK.get(node.tag, 100) > rank:
                return
            node = node.up
        while self.at is not node:
            self._up()
        self._up()

    def parse_starttag(self, i: int) -> int:
        m = _START.match(self.rawdata, i)
        if not m or self.cdata_elem is not None or (tag := m[1].lower()) in RAW:
            return super().parse_starttag(i)
        self.lasttag = tag
        self.handle_starttag(tag, [])
        return m.end()

    def parse_endtag(self, i: int) -> int:
        m = _END.match(self.rawdata, i)
        if not m or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(m[1].lower())
        return m.end()

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted: nothing asks where a tag was."""
        return j

    def parse_html_declaration(self, i: int) -> int:
        """A marked section (`<![if x]>`) is no markup of HTML and goes like a comment."""
        return self.parse_bogus_comment(i, 0) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def handle_data(self, data: str) -> None:
        if self.at.tag in BARE and data.strip():
            self.handle_starttag("p", [])
        self.at.inside.append(data)


def tree(html: str) -> Node:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def coloured(cell: Node) -> bool:
    """Whether a row or cell has a background that counts."""
    if "bgcolor" in cell.attrs and cell.attrs["bgcolor"].lower() not in PLAIN:
        return True
    style: dict[str, str] = {}
    for part in _DECLARATION.findall(cell.attrs.get("style", "")):
        name, _, value = part.partition(":")
        style[name.strip().lower()] = _IMPORTANT.sub("", value).strip().lower()
    return any((v := style.get(k)) and v not in PLAIN for k in ("background", "background-color"))


@lru_cache(maxsize=64)
def _any_header(items: tuple[str, ...]) -> re.Pattern | None:
    return re.compile(rf"\n{rules.BLANK}*(?:{'|'.join(header_pattern(i) for i in items)})[.*~\-:\s]", re.IGNORECASE | re.DOTALL) if items else None


def drop_coloured_tables(root: Node, items: list[str]) -> None:
    """A table goes if a row or cell of it has a colour and no item header starts a line of its text."""
    header = _any_header(tuple(items))
    gone: set[int] = set()
    for table in [n for n in root.all() if n.tag == "table"]:
        up = table
        while up is not None and id(up) not in gone:
            up = up.up
        if up is not None or not any(n.tag in ("tr", "td", "th") and n.attrs and coloured(n) for n in table.all()):
            continue
        if not (header and header.search(clean(text_of(table)))):
            gone.add(id(table))
            table.up.inside = [x for x in table.up.inside if x is not table]


def unwrap_spans(root: Node) -> None:
    """T13 for HTML: spans with text give way to their content, empty ones to a blank."""
    for span in [n for n in root.all() if n.tag == "span"]:
        if span.text().strip():
            span.tag = ""
        else:
            span.tag, span.inside = "", [" "]


def html_text(html: str, items: list[str], remove_tables: bool) -> str:
    root = tree(html)
    if remove_tables:
        drop_coloured_tables(root, items)
    unwrap_spans(root)
    return text_of(root)


def strip_html(df: DataFrame, col: str, out: str) -> DataFrame:
    """T1 over a column."""
    return with_helper(df, out, T.StringType(), strip_tags, col)


def drop_numeric_tables(df: DataFrame, col: str, items: str, out: str) -> DataFrame:
    """T12 over a column of HTML; items: the column with each row's item list."""

    def helper(html: str | None, names: list[str] | None) -> str | None:
        if html is None:
            return None
        drop_coloured_tables(root := tree(html), names or [])
        return root.markup()

    return with_helper(df, out, T.StringType(), helper, col, items)


def flatten_spans(df: DataFrame, col: str, out: str) -> DataFrame:
    """T13 over a column of HTML."""

    def helper(html: str | None) -> str | None:
        if html is None:
            return None
        unwrap_spans(root := tree(html))
        return root.markup()

    return with_helper(df, out, T.StringType(), helper, col)


def main_text(df: DataFrame, col: str, remove_tables: bool) -> DataFrame:
    """Adds _doc, the main document (without tables and spans if it is plain text), and _html. All built in."""
    doc = main_document(drop_embedded_pdf(F.col(col)))
    plain = flatten_text_spans(drop_text_tables(F.col("_doc")) if remove_tables else F.col("_doc"))
    return df.withColumn("_doc", doc).withColumn("_html", is_html(F.col("_doc"))).withColumn("_doc", F.when(F.col("_html"), F.col("_doc")).otherwise(plain))


def bare_text(doc: str, html: bool | None, names: list[str] | None, remove_tables: bool) -> str:
    """The text of a main document without markup, not yet cleaned."""
    return html_text(doc, names or [], remove_tables) if html else strip_tags(doc) or ""


def filing_text(df: DataFrame, col: str = "content", items: str = "catalog", out: str = "text", remove_tables: bool = True) -> DataFrame:
    """Main document, tables and spans, markup stripped, cleaned. items: the column with each row's item list."""

    def helper(doc: str | None, html: bool | None, names: list[str] | None) -> str | None:
        return None if doc is None else bare_text(doc, html, names, remove_tables)

    return with_helper(main_text(df, col, remove_tables), out, T.StringType(), helper, "_doc", "_html", items).drop("_doc", "_html").withColumn(out, clean_text(F.col(out)))
