"""The item catalog: which items a filing of a form has, in order, and how their headers read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

# The items of each form in order; 8-K items up to and including CUT_OFF are those of 8-K-old.
ITEMS = {
    "10-K": "1 1A 1B 1C 2 3 4 5 6 7 7A 8 9 9A 9B 9C 10 11 12 13 14 15 16 SIGNATURE".split(),
    "10-Q": "part_1__1 part_1__2 part_1__3 part_1__4 part_2__1 part_2__1A part_2__2 part_2__3 part_2__4 part_2__5 part_2__6 SIGNATURE".split(),
    "8-K": "1.01 1.02 1.03 1.04 1.05 2.01 2.02 2.03 2.04 2.05 2.06 3.01 3.02 3.03 4.01 4.02 5.01 5.02 5.03 5.04 5.05 5.06 5.07 5.08 6.01 6.02 6.03 6.04 6.05 7.01 8.01 9.01 SIGNATURE".split(),
    "8-K-old": "1 2 3 4 5 6 7 8 9 10 11 12 SIGNATURE".split(),
}
CUT_OFF = "2004-08-23"
#: Why a filing cannot be worked on.
UNKNOWN_TYPE, NO_DATE, NOT_ASKED = "unknown filing type", "no valid date", "no item of this filing was asked for"


def roman(n: int) -> str:
    out = ""
    for value, letters in ((10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        out, n = out + letters * (n // value), n % value
    return out


def header_pattern(item: str) -> str:
    """How the header of an item reads, after the line's start and blanks; a part alone (`part_1`) is one too."""
    if item == "SIGNATURE":
        return r"SIGNATURE(?:s|\(s\))?"
    part, _, name = item.rpartition("__")
    if not part and name.startswith("part_"):
        n = name.removeprefix("part_")
        return rf"PART\s*(?:{roman(int(n))}|{n})"
    number = rf"(?:{roman(int(name))}|{name})" if name.isdigit() and int(name) <= 20 else name.replace(".", r"\.")
    return rf"ITEMS?\s*{number}"


def item_catalog(spark: SparkSession) -> DataFrame:
    """(form, ord, item_index, part, out_key); form 8-K-old is the one up to the cut-off."""
    rows = [(form, i, item, item.split("__")[0] if "__" in item else None) for form, items in ITEMS.items() for i, item in enumerate(items)]
    return spark.createDataFrame(rows, "form string, ord int, item_index string, part string").withColumn("out_key", section_key(F.col("item_index")))


def section_key(item: Column) -> Column:
    """The key under which an item's section, or that of a part, is put out."""
    return F.when(item.isin("SIGNATURE", "part_1", "part_2"), item).when(item.contains("__"), F.regexp_replace(item, "__", "_item_")).otherwise(F.concat(F.lit("item_"), item))


def form_of(kind: Column, date: Column) -> Column:
    """The form whose list holds for a filing: 8-K filings after the cut-off have the new one. Null for other types, and for
    an 8-K whose date is none."""
    day = F.try_to_date(date)
    return F.when(kind.isin("10-K", "10-Q"), kind).when(kind == "8-K", F.when(day > F.to_date(F.lit(CUT_OFF)), "8-K").when(day.isNotNull(), "8-K-old"))


def items_for_filing(df: DataFrame, items: list[str] | None = None) -> DataFrame:
    """P10: adds form, catalog (all items of the filing's list), items (those of them that were asked for; all, if none
    were) and reject (why the filing cannot be worked on, else null). The lists are literals: no join, no shuffle."""
    lists = F.create_map(*[x for f, names in ITEMS.items() for x in (F.lit(f), F.array(*map(F.lit, names)))])
    rows = df.withColumn("form", form_of(F.col("Type"), F.col("Date"))).withColumn("catalog", lists[F.col("form")])
    rows = rows.withColumn("items", F.array_intersect("catalog", F.array(*map(F.lit, items))) if items else F.col("catalog"))
    return rows.withColumn("reject", F.when(F.col("form").isNull() & (F.col("Type") == "8-K"), NO_DATE).when(F.col("form").isNull(), UNKNOWN_TYPE).when(F.size("items") == 0, NOT_ASKED))


def next_items(catalog: DataFrame) -> DataFrame:
    """Each item with its ordered followers."""
    after = W.partitionBy("form").orderBy("ord").rowsBetween(1, W.unboundedFollowing)
    return catalog.withColumn("followers", F.collect_list("item_index").over(after))
