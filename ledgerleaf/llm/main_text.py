"""Operator 12: the main text of web pages by the distribution of text over blocks of lines."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import table, with_results

#: Lines of a window; a window is text from so many characters on, or from this share of the page's largest window.
WINDOW, LEAST, SHARE = 3, 86, 0.2
#: Elements that may be open at once, as in browsers; a deeper one ends the one before it. It bounds the work a tag makes.
DEPTH = 512
#: Lines between a page's title and its text.
TITLE_GAP = 8
#: Of the text that is left, the share that an article's own element must hold to be taken for the article.
MARKED = 0.4

# Fixed values of HTML: elements without content, elements that start and end a line, and what an open element gives way to.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_P = BLOCKS - frozenset("body br caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split()) | {"li", "dd", "dt"}
IMPLIED = {  # a new one ends those of the second set, looked for up to those of the third
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
CELLS = frozenset("td th caption".split())
TABLE_PARTS = frozenset("table tbody thead tfoot tr td th caption".split())
# Elements, roles and words of names that mark what is no part of an article.
RAW = frozenset("script style noscript iframe xmp noembed noframes".split())
NO_TEXT = frozenset("template object svg canvas audio video map select button textarea datalist label dialog head title nav aside footer".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
NO_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored sponsors promo promotion nav navbar navigation menu menus submenu breadcrumb breadcrumbs "
    "sidebar sidebars rail footer foot header masthead topbar toolbar banner cookie cookies consent gdpr notice notices notification alert popup popover modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended recommendations teaser teasers pagination pager paging widget widgets "
    "copyright colophon legal disclaimer skip skiplink tags".split()
)
#: Of these, what names a part of an article where it stands inside one.
OF_ARTICLE = frozenset("head header teaser teasers".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
STATES = frozenset("has no with without hide show is not js".split()), frozenset("open closed enabled disabled on off visible hidden none active free".split())
#: Elements whose lines may stand at the edge of the text though they are short.
PROSE = HEADINGS | {"p", "blockquote", "pre", "dd", "dt", "figcaption"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.DOTALL)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TELLING = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
_NONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RIGHTS = re.compile(r"\s*(?:©|\(c\)|copyright\b)", re.IGNORECASE)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW | {"title", "textarea"}}


class _Open:
    """An open element: what it is called, the mark in force inside it, and how deep in articles and main parts it is."""

    __slots__ = ("inside", "mark", "name")

    def __init__(self, name: str, mark: int, inside: int) -> None:
        self.name, self.mark, self.inside = name, mark, inside


ARTICLE, MAIN = 1, 2
#: Marks: text that is surely none of the article, and from FIRST on elements that are to be judged by the whole page.
PLAIN, GONE, FIRST = 0, 1, 2


def _names(attrs: dict[str, str], inside: int) -> tuple[bool, bool]:
    """Whether class or id have a word for what is no article, and one for comments. Two words may be one: side-bar, navBar."""
    other = comments = False
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and len(words) > 1 and (words[0] in STATES[0] or words[-1] in STATES[1]):
            continue
        words += [a + b for a, b in pairwise(words)]
        other = other or not (NO_TEXT_NAMES - OF_ARTICLE if inside else NO_TEXT_NAMES).isdisjoint(words)
        comments = comments or not COMMENTS.isdisjoint(words)
    return other, comments


class _Page:
    """The lines of a page with what surrounds them: lines of text pieces (text, in a link, mark)."""

    def __init__(self, html: str) -> None:
        self.lines: list[tuple[str, int, list[tuple[str, bool, int]]]] = []  # the block, where it lies, its pieces
        self.open: list[_Open] = []
        self.counts: Counter[str] = Counter()  # of open elements by name
        self.judged: list[list] = [[], []]  # of each mark: mark around it, comments, holds an article, a first heading
        self.titles, self.marked = 0, False
        self._link = False
        self._line: list[tuple[str, bool, int]] = []
        self._block = "body"
        self._read(html)

    def _end_line(self) -> None:
        if self._line:
            self.lines.append((self._block, self.open[-1].inside if self.open else 0, self._line))
            self._line = []

    def _pop(self, at: int) -> None:
        if self._line and any(o.name in BLOCKS for o in self.open[at:]):
            self._end_line()
        self.counts.subtract(o.name for o in self.open[at:])
        del self.open[at:]
        self._block = next((o.name for o in reversed(self.open) if o.name in BLOCKS), "body")

    def _find(self, names: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> int | None:
        if not any(self.counts[n] for n in names):
            return None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].name in names:
                return i
            if self.open[i].name in until:
                return None
        return None

    def _mark(self, name: str, text: str, mark: int, inside: int) -> int:
        if mark == GONE or name in NO_TEXT or name == "header" and not inside:
            return GONE
        attrs = {}
        if text and _TELLING.search(text):
            attrs = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}
            if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or _NONE.search(attrs.get("style", "")):
                return GONE
            if attrs.get("role", "").lower() == "main" or attrs.get("itemprop", "").lower() == "articlebody":
                return mark
        other, comments = _names(attrs, inside)
        if name in ("html", "body", "main") or not (other or comments or name in ("form", "menu") or attrs.get("role", "").lower() in NO_TEXT_ROLES):
            return mark
        if name == "article" and not comments:
            return mark
        self.judged.append([mark, comments, False, False])
        return len(self.judged) - 1

    def _start(self, name: str, text: str) -> None:
        if name in ("br", "hr"):
            self._end_line()
        if name in VOID:
            return
        if name in ("article", "main") and (at := self._find({"nav", "footer", "header"}, {"aside"})) is not None:
            self._pop(at)  # it was left open
        if name in ENDS_P and (at := self._find({"p"}, CELLS | {"table", "button", "object"})) is not None:
            self._pop(at)
        if name in HEADINGS and self.open and self.open[-1].name in HEADINGS:
            self._pop(len(self.open) - 1)
        if name in IMPLIED and (at := self._find(*IMPLIED[name])) is not None:
            self._pop(at)
        if len(self.open) >= DEPTH:
            self._pop(DEPTH - 1)
        if name == "a":
            self._link = True
        up = self.open[-1] if self.open else _Open("", PLAIN, 0)
        mark = self._mark(name, text, up.mark, up.inside)
        inside = up.inside
        if mark != GONE and (name == "article" and mark == up.mark or "articlebody" in text.lower()):
            inside |= ARTICLE
        elif mark != GONE and (name == "main" or name != "a" and "role" in text and re.search(r"role\s*=\s*[\"']?main\b", text, re.IGNORECASE)):
            inside |= MAIN
        self.marked = self.marked or inside != PLAIN
        if inside != up.inside or name == "h1" and mark != GONE:
            at = mark
            while at >= FIRST and not self.judged[at][2 + (name == "h1")]:
                self.judged[at][2 + (name == "h1")] = True
                at = self.judged[at][0]
            self.titles += name == "h1"
        if name in BLOCKS:
            self._end_line()
            self._block = name
        elif mark == up.mark and inside == up.inside:
            return  # inline elements count only where they change something
        self.open.append(_Open(name, mark, inside))
        self.counts[name] += 1

    def _end(self, name: str) -> None:
        if name == "a":
            self._link = False
        if name in ("body", "html"):
            return self._end_line()
        if name not in BLOCKS:
            at = self._find({name}, BLOCKS)
        elif name in TABLE_PARTS:
            at = self._find({name}, {"table"} - {name})
        else:
            at = self._find(HEADINGS if name in HEADINGS else {name}, CELLS | {"table"})
        if at is not None:
            self._pop(at)
        elif name in BLOCKS:
            self._end_line()

    def _read(self, html: str) -> None:
        at, end, unclosed = 0, len(html), set()
        while at < end:
            m = _TOKEN.search(html, at)
            upto = m.start() if m else end
            if upto > at and (mark := self.open[-1].mark if self.open else PLAIN) != GONE:
                self._line.append((unescape(html[at:upto]), self._link, mark))
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if m[1]:
                self._end(name)
                continue
            if name in _RAW_END and name not in unclosed:
                if not (last := _RAW_END[name].search(html, at)):
                    unclosed.add(name)
                if last or name in ("script", "style"):
                    at = last.start() if last else end
                    if name in RAW:
                        continue
            if not m[3].endswith("/") or name in BLOCKS:
                self._start(name, m[3])
        self._end_line()


def _texts(page: _Page) -> list[tuple[str, int, int, str]]:
    """The lines that are left: text, its length without links, where it lies, its block. An element that is to be judged goes
    unless an article or the only first heading is in it or, where no article is marked and comments aside, it holds half of all
    text."""
    held = [0] * len(page.judged)
    for _, _, pieces in page.lines:
        for text, _, mark in pieces:
            held[mark] += len(text.strip())
    for mark in range(len(held) - 1, FIRST - 1, -1):  # marks inside come later
        held[page.judged[mark][0]] += held[mark]
    gone = [False, True]
    for mark, (around, comments, article, title) in enumerate(page.judged[FIRST:], FIRST):
        kept = article or title and page.titles == 1 or not (comments or page.marked) and 2 * held[mark] >= held[PLAIN]
        gone.append(gone[around] or not kept)
    out = []
    for block, inside, pieces in page.lines:
        kept = [(t, link) for t, link, mark in pieces if not gone[mark]]
        if text := " ".join("".join(t for t, _ in kept).split()):
            out.append((text, max(0, len(text) - sum(len(t.strip()) for t, link in kept if link)), inside, block))
    return out


def stretches(lengths: list[int], above: float) -> list[tuple[int, int]]:
    """From each surge to the next dive: lines [a, b) that are in a window of WINDOW lines with more than `above` characters,
    from the first to the last of them that has any."""
    sums = list(accumulate(lengths, initial=0))
    n, out = len(lengths), []
    for i in range(n):
        if sums[min(n, i + WINDOW)] - sums[i] > above:
            if out and i <= out[-1][1]:
                out[-1] = (out[-1][0], min(n, i + WINDOW))
            else:
                out.append((i, min(n, i + WINDOW)))
    trimmed = []
    for a, b in out:
        while not lengths[a]:
            a += 1
        while not lengths[b - 1]:
            b -= 1
        trimmed.append((a, b))
    return trimmed


def main_text_of(html: str | None) -> str:
    """The main text of one page."""
    lines = _texts(_Page(html or ""))
    whole = sum(n for _, n, _, _ in lines)
    for part in (ARTICLE, MAIN):
        own = [len(t) if inside & part else 0 for t, _, inside, _ in lines]
        if sum(own) and sum(n for _, n, inside, _ in lines if inside & part) >= MARKED * whole:
            # the page tells where its article lies: all its lines count, all others have no length
            return " ".join(lines[i][0] for a, b in stretches(own, 0) for i in range(a, b) if own[i])
    lengths = [0 if _RIGHTS.match(t) else n for t, n, _, _ in lines]
    sums = list(accumulate(lengths, initial=0))
    largest = max((sums[min(len(lengths), i + WINDOW)] - sums[i] for i in range(len(lengths))), default=0)
    above = min(LEAST, SHARE * largest)
    out: list[str] = []
    done = 0
    for a, b in stretches(lengths, above):
        # at the edges, short lines stay only if they are prose; a title shortly before the text belongs to it
        long = [i for i in range(a, b) if lengths[i] >= above / WINDOW]
        first, last = (long[0], long[-1]) if long else (a, b - 1)
        title = next((i for i in range(a, max(done, a - TITLE_GAP) - 1, -1) if lines[i][3] == "h1"), a)
        out += [lines[i][0] for i in range(title, b) if lengths[i] and (first <= i <= last or lines[i][3] in PROSE)]
        done = b
    return " ".join(out)


def main_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without its html column, with text, the main text of each page (empty if none), and n_chars, its code points.

    A page is cut into lines at its block elements, markup and references resolved. What elements, roles and names mark as
    navigation, headers, footers, sidebars, notices, adverts, forms, scripts or comments is stripped with the markup. Line
    lengths, without links, are summed over sliding windows; where the sum surges the text begins, where it dives it ends.
    Where the page marks its article, the lines outside have no length and those inside all count. White space in a line
    becomes one blank; lines are joined by one blank. Whole pages, no bound; a page needs memory in proportion to itself.

    Null and empty pages have an empty text; repeated rows have equal results; columns named text or n_chars give way.
    """

    def found(given: pa.Array) -> list[pa.Array]:
        texts = [main_text_of(x.as_py()) for x in given]
        return [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]

    return with_results(pages, html, [c for c in pages.columns if c != html], "text string, n_chars long", found)


def op12_main_text(spark, sf_dir):
    return main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


#: The given pages have one article each, with references to few characters; the text of these in SQL.
SQL = r"""
WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '') AS x FROM pages),
     b AS (SELECT page_id, url, regexp_replace(regexp_replace(x, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS x FROM a),
     c AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(x, '&quot;', '"'), '&#x27;', ''''), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM c
"""
