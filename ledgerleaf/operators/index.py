"""Operators on index rows: selection, joins with what is held, links and names, summaries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ARCHIVE = "https://www.sec.gov/Archives/"
THROTTLED = "will be managed until action is taken to declare your traffic."
#: Keys that may be broadcast; beyond that number the join is shuffled.
SMALL = 100_000


def small_side(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def prune_quarters(df: DataFrame, start_year: int, end_year: int, quarters: list[int], today: dt.date) -> DataFrame:
    """Rows (columns year, quarter) of the years and quarters that are not after today's."""
    if bad := [q for q in quarters if q not in (1, 2, 3, 4)]:
        raise ValueError(f"no such quarters: {bad}")
    now = (today.month + 2) // 3
    return df.where(F.col("year").between(start_year, end_year) & F.col("quarter").isin(quarters) & ((F.col("year") < today.year) | ((F.col("year") == today.year) & (F.col("quarter") <= now))))


def filter_filing_types(df: DataFrame, types: list[str], required: bool = False) -> DataFrame:
    """Exact types; an empty list keeps all, or is an error where types are required."""
    if required and not types:
        raise ValueError("no filing types")
    return df.where(F.col("Type").isin(types)) if types else df


def archive_links(df: DataFrame) -> DataFrame:
    """Both links with the archive's prefix; null links stay null."""
    return df.withColumns({c: F.concat(F.lit(ARCHIVE), F.col(c)) for c in ("complete_text_file_link", "html_index")})


def resolve_document_link(df: DataFrame) -> DataFrame:
    """P5: adds link and extension: the htm link (viewer prefix removed), else that of the whole submission; rows with
    neither go."""
    viewer = F.col("htm_file_link").contains("ix?doc=/")
    rows = df.withColumn("link", F.coalesce(F.replace("htm_file_link", F.lit("ix?doc=/"), F.lit("")), "complete_text_file_link")).where("link IS NOT NULL")
    return rows.withColumn("extension", F.when(F.coalesce(viewer, F.lit(False)), "htm").otherwise(F.substring_index("link", ".", -1)))


def filing_name(cik: Column, kind: Column, period: Column, submission: Column, extension: Column) -> Column:
    """<CIK>_<type>_<year of the period>_<accession>.<extension>."""
    base = F.substring_index(submission, "/", -1)
    accession = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    return F.concat(cik, F.lit("_"), F.regexp_replace(kind, r"[-/\\]", ""), F.lit("_"), F.substring(period, 1, 4), F.lit("_"), accession, F.lit("."), extension)


def drop_throttled_pages(pages: DataFrame) -> DataFrame:
    """Pages whose body is not the notice of throttling; a page without a body is no result either."""
    return pages.where(~F.col("html").contains(THROTTLED))


def require_period(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a period of report, and the rejected others."""
    has = F.col("`Period of Report`").isNotNull()
    return df.where(has), df.where(~has)


def resolve_companies(entries: DataFrame, tickers: DataFrame) -> DataFrame:
    """CIKs of entries: numbers stand for themselves, others are tickers; unknown ones go."""
    is_cik = F.col("entry").rlike("^[0-9]+$")
    joined = entries.join(tickers.withColumnRenamed("cik", "_cik"), (~is_cik) & (F.col("entry") == F.col("ticker")), "left")
    return joined.select(F.when(is_cik, F.col("entry")).otherwise(F.col("_cik")).alias("CIK")).where("CIK IS NOT NULL").distinct()


def filter_companies(index: DataFrame, ciks: DataFrame) -> DataFrame:
    """Rows of these companies; an empty set keeps all. One count tells whether it is empty and whether it is small."""
    n = ciks.limit(SMALL + 1).count()
    return index.join(F.broadcast(ciks) if n <= SMALL else ciks, "CIK", "left_semi") if n else index


def new_filings(index: DataFrame, held: DataFrame, row: tuple[str, ...] = ()) -> DataFrame:
    """Index rows that are not held, by html_index and, where rows share an address, the columns that tell them apart."""
    return index.join(held.select("html_index", *row), ["html_index", *row], "left_anti")


def held_filings(metadata: DataFrame, listing: DataFrame) -> DataFrame:
    """Metadata rows whose raw file is there."""
    return metadata.join(listing, ["Type", "filename"], "left_semi")


def fill_company_info(df: DataFrame, companies: DataFrame) -> DataFrame:
    """Company facts where the row has none."""
    facts = ["SIC", "State of Inc", "State location", "Fiscal Year End"]
    known = companies.select("CIK", *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(facts)])
    return df.join(known, "CIK", "left").withColumns({c: F.coalesce(F.col(f"`{c}`"), F.col(f"_{i}")) for i, c in enumerate(facts)}).drop(*[f"_{i}" for i in range(len(facts))])


def attach_content(metadata: DataFrame, raw: DataFrame, limit: int = SMALL) -> DataFrame:
    """The content of each filing. The metadata is the side that is broadcast, if it is small; contents then stay
    where they are. Of a larger collection keep the contents in a bucketed table (sources.tables.write_raw_table): then
    the metadata alone is shuffled."""
    return raw.join(small_side(metadata, limit), ["Type", "filename"])


def missing_content(metadata: DataFrame, listing: DataFrame) -> DataFrame:
    """Metadata rows without a raw file: the rejects of J6."""
    return metadata.join(listing, ["Type", "filename"], "left_anti")


def pending_filings(metadata: DataFrame, extracted: DataFrame, skip_extracted: bool = True) -> DataFrame:
    """Filings that are not extracted yet, by type and the name up to its first dot."""
    if not skip_extracted:
        return metadata
    stem = lambda c: F.split(c, r"\.")[0]
    done = extracted.select(F.col("filing_type").alias("_t"), stem(F.col("filename")).alias("_s")).distinct()
    return metadata.join(done, (F.col("Type") == F.col("_t")) & (stem(F.col("filename")) == F.col("_s")), "left_anti")


def attach_pages(index: DataFrame, pages: DataFrame, row: tuple[str, ...] = ()) -> DataFrame:
    """Index rows with the facts of their page. Parse pages first, so that no markup is shuffled. row: columns that tell,
    beside the address, which index row a page was fetched for; needed where rows share an address, as each has its own page."""
    return index.join(pages.withColumnRenamed("url", "html_index"), ["html_index", *row])


def run_summary(df: DataFrame, failed: Column) -> DataFrame:
    """A1: filings, done and failed, by type."""
    return df.groupBy("Type").agg(F.count("*").alias("filings"), F.count_if(~failed).alias("done"), F.count_if(failed).alias("failed"))


def _compared(sections: DataFrame, expected: DataFrame) -> DataFrame:
    """(filename, out_key, same); a section that is missing on one side is empty there. Only digests of texts are shuffled."""
    side = lambda df, c: df.select("filename", "out_key", F.sha2(F.coalesce("section_text", F.lit("")), 256).alias(c))
    pairs = side(sections, "got").join(side(expected, "want"), ["filename", "out_key"], "full")
    none = F.sha2(F.lit(""), 256)
    return pairs.select("filename", "out_key", (F.coalesce("got", none) == F.coalesce("want", none)).alias("same"))


def extraction_quality(sections: DataFrame, expected: DataFrame) -> DataFrame:
    """A2: by output key: filings, exact matches."""
    return _compared(sections, expected).groupBy("out_key").agg(F.count("*").alias("filings"), F.count_if("same").alias("exact"))


def failed_items(sections: DataFrame, expected: DataFrame) -> DataFrame:
    """A2: by filing, the keys that differ."""
    return _compared(sections, expected).where("NOT same").groupBy("filename").agg(F.array_sort(F.collect_list("out_key")).alias("failed"))


def dedupe_companies(df: DataFrame) -> DataFrame:
    """A4."""
    return df.select("CIK").distinct()


def union_indices(parts: list[DataFrame]) -> DataFrame:
    """All rows of all quarters."""
    return reduce(DataFrame.unionByName, parts)


def merge_metadata(held: DataFrame, new: DataFrame, row: tuple[str, ...] = ()) -> DataFrame:
    """Held rows, and the new ones that are not held."""
    return held.unionByName(new_filings(new, held, row).select(*[F.col(f"`{c}`") for c in held.columns]))


def ordered_sections(sections: DataFrame) -> DataFrame:
    """O2: sections of a filing in catalog order within each partition, parts before their items. The sections of a filing
    come from one row, so they are in one partition already and nothing is shuffled."""
    return sections.sortWithinPartitions("filename", "ord")
