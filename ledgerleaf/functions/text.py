"""Text functions on Columns, all built in: no row leaves the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from . import rules


def _apply(col: Column, table: list[tuple[str, str]]) -> Column:
    for pattern, by in table:
        col = F.regexp_replace(col, "(?iU)" + pattern, re.sub(r"\\g<(\d+)>", lambda m: "$" + m[1], by))
    return col


def normalize_characters(col: Column) -> Column:
    """Odd spaces, C1 quotes and dashes by plain ones."""
    return F.translate(col, "".join(rules.CHARACTERS), "".join(rules.CHARACTERS.values()))


def repair_headers(col: Column) -> Column:
    """`I T E M 1A` at a line's start loses its inner blanks; `ITEM 1-` gets blanks around the mark."""
    return _apply(col, rules.HEADERS)


def drop_page_furniture(col: Column) -> Column:
    """T4: lines that are only a contents heading or a page number, F-pages, and `Page n` lines go."""
    return _apply(col, rules.FURNITURE)


def clean_text(col: Column) -> Column:
    """T5."""
    return drop_page_furniture(repair_headers(normalize_characters(col)))


def collapse_lines(col: Column) -> Column:
    """Two or more line ends (blanks between them) become one, single ones a blank; trimmed; runs of blanks one."""
    col = F.regexp_replace(col, r"[ ]*\n[ ]*\n[ \n]*", "#NEWLINE")
    col = F.regexp_replace(F.translate(col, "\n", " "), r"(?:#NEWLINE)+", "\n")
    col = F.regexp_replace(col, rf"(?U)^{rules.SPACE}+|{rules.SPACE}+$", "")
    return F.regexp_replace(col, r" {2,}", " ")


# The patterns below state what a filing marks its documents, types, tables and spans with.


def drop_embedded_pdf(col: Column) -> Column:
    """T7."""
    return F.regexp_replace(col, r"(?is)<PDF>.*?</PDF>", "")


def split_documents(col: Column) -> Column:
    """The `<DOCUMENT>` blocks as (type, body); type is null in a block without that line."""
    kind = lambda d: F.regexp_extract(d, r"(?isU)\n[^\S\r\n]*<TYPE>(.*?)\n", 1)
    has = lambda d: d.rlike(r"(?isU)\n[^\S\r\n]*<TYPE>.*?\n")
    blocks = F.regexp_extract_all(col, F.lit(r"(?is)<DOCUMENT>.*?</DOCUMENT>"), F.lit(0))
    return F.transform(blocks, lambda d: F.struct(F.when(has(d), kind(d)).alias("type"), d.alias("body")))


def main_document(col: Column) -> Column:
    """The last block whose type starts with 10 or 8, else the whole text. Blocks without a type are passed over."""
    wanted = F.filter(split_documents(col), lambda d: d["type"].rlike(r"^(10|8)"))
    return F.coalesce(F.try_element_at(wanted, F.lit(-1))["body"], col)


def is_html(col: Column) -> Column:
    """Has a table cell and a table row."""
    return col.rlike(r"(?i)<td[\s>/]") & col.rlike(r"(?i)<tr[\s>/]")


def drop_text_tables(col: Column) -> Column:
    """T11."""
    return F.regexp_replace(col, r"(?is)<TABLE>.*?</TABLE>", "")


def flatten_text_spans(col: Column) -> Column:
    """T13 for plain text: spans with a margin at the side become a blank, with one above or below a line end."""
    span = r'(?i)<span[^>]*style="[^"]*(?:{}):\s*[\d.]+pt[^"]*"[^>]*>.*?</span>'
    return F.regexp_replace(F.regexp_replace(col, span.format("margin-left|margin-right"), " "), span.format("margin-top|margin-bottom"), "\n")


def char_ratios(col: Column) -> Column:
    """A3: (digit_ratio, space_ratio): digits among characters that are no spaces, spaces among all; 0 if there are none."""
    count = lambda p: F.length(col) - F.length(F.regexp_replace(col, p, ""))
    digits, spaces = count(r"(?U)\d"), count(rf"(?U){rules.SPACE}")
    rest = F.length(col) - spaces
    return F.struct(F.when(rest > 0, digits / rest).otherwise(0.0).alias("digit_ratio"), F.when(F.length(col) > 0, spaces / F.length(col)).otherwise(0.0).alias("space_ratio"))
