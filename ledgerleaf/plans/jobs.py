"""The three jobs: worklist, enrichment (operators.pages.enrich_index) and extraction."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import index as I
from ..operators.catalog import NO_DATE, NOT_ASKED, UNKNOWN_TYPE, items_for_filing
from ..operators.sections import asked_text, chosen_sections, sections_of_content
from ..sources.commits import committed
from ..sources.scratch import cut as cut_table, discard
from ..sources.tables import METADATA, extracted_keys, output_metadata, put_out_filings, strings, with_contents


def worklist(indices: DataFrame, held: DataFrame, listing: DataFrame, types: list[str], ciks: DataFrame | None = None, row: tuple[str, ...] = ()) -> DataFrame:
    """WL1: filings of the types and companies that are not held with their raw file. Filters come before joins."""
    rows = I.archive_links(I.filter_filing_types(indices, types, required=True))
    rows = I.filter_companies(rows, ciks) if ciks is not None else rows
    return I.new_filings(rows, I.held_filings(held, listing), row)


#: Why a filing that could be worked on has no result: its raw filing is not there, or none of its sections has text (no reject).
MISSING, EMPTY = "no raw filing", "no section has text"


def _extraction(todo: DataFrame, raw: DataFrame, items: list[str] | None, include_signature: bool, remove_tables: bool) -> DataFrame:
    """A row for each row of todo: the output metadata, form, sections (array of ord, out_key, section_text) and reject, why
    there is no section, else null.

    raw: Type and filename with content, or with file and length, whose contents are then read where they are worked on.
    What makes the cutting of a filing fail is that filing's reject. After the contents all is row by row.
    """
    ready = items_for_filing(todo, items)
    fine = ready.where("reject IS NULL")
    if "file" in raw.columns:
        found = with_contents(I.attach_content(fine, raw.select("Type", "filename", "file", "length")))
    else:
        found = I.attach_content(fine, raw).withColumn("unread", F.lit(None).cast("string"))
    cut = sections_of_content(found, remove_tables=remove_tables)
    why = F.coalesce("unread", F.when(F.col("error").isNotNull(), F.concat(F.lit("cannot be cut: "), "error")), F.when(~F.coalesce(asked_text(), F.lit(False)), EMPTY))
    done = output_metadata(chosen_sections(cut.withColumn("reject", why), include_signature), "form", "sections", "reject")
    none = F.lit(None).cast(done.schema["sections"].dataType).alias("sections")
    absent = I.missing_content(fine, raw.select("Type", "filename")).withColumn("reject", F.lit(MISSING))
    rest = [output_metadata(df, "form", none, "reject") for df in (ready.where("reject IS NOT NULL"), absent)]
    return done.union(rest[0]).union(rest[1])


def extract_filings(metadata: DataFrame, raw: DataFrame, items: list[str] | None = None, include_signature: bool = False, remove_tables: bool = True, extracted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(filings, rejects). filings: the output metadata, form and sections (array of ord, out_key, section_text). rejects:
    filename and reason: filings of no known type or valid date, without asked items, without a raw filing, and those that could
    not be read or cut; the last need the work of the filings once more. extract_run writes both in one pass.

    Filings already extracted are left out before contents are read; contents are joined to the metadata, not shuffled
    where it is small, or read by path; everything after is row by row.
    """
    todo = I.pending_filings(metadata, extracted) if extracted is not None else metadata
    rows = _extraction(todo, raw, items, include_signature, remove_tables)
    return rows.where("reject IS NULL").drop("reject"), rows.where(F.col("reject") != EMPTY).select("filename", F.col("reject").alias("reason"))


def extract_run(metadata: DataFrame, raw: DataFrame, path: str, run: str | None = None, skip_extracted: bool = True, **options) -> dict:
    """X8 as a job: extracts what earlier runs at path have not (J7), adds it there as a run (S6) with its rejects, and returns
    the run's entry with its counts (A1), which the one pass over the filings has taken: todo, done, empty, and failed by
    reason. Repeated under the same name, a run does the same again and takes its own place."""
    spark = metadata.sparkSession
    run = run or f"run-{uuid.uuid4().hex}"
    todo = I.pending_filings(metadata, extracted_keys(spark, path, but=run)) if skip_extracted else metadata
    given = {"items": None, "include_signature": False, "remove_tables": True} | options
    seen = Observation()
    reason = F.col("reject")
    counts = {"todo": F.count("*"), "done": F.count_if(reason.isNull()), "empty": F.count_if(reason == EMPTY)}
    kinds = {UNKNOWN_TYPE: reason == UNKNOWN_TYPE, NO_DATE: reason == NO_DATE, NOT_ASKED: reason == NOT_ASKED, MISSING: reason == MISSING, "cannot be read": reason.startswith("cannot be read"), "cannot be cut": reason.startswith("cannot be cut")}
    counted = {**counts, **{k: F.count_if(F.coalesce(c, F.lit(False))) for k, c in kinds.items()}}
    rows = _extraction(todo, raw, **given).observe(seen, *[c.alias(k) for k, c in counted.items()])
    whole = cut_table(rows, "extraction")
    got = seen.get
    facts = {k: got[k] for k in counts} | {"failed": {k: got[k] for k in kinds if got[k]}}
    rejects = f"rejects/{uuid.uuid4().hex}"
    whole.where(reason.isNotNull()).select("filing_type", "filename", reason.alias("reason")).write.json(f"{path}/{rejects}")
    entry = put_out_filings(whole.where(reason.isNull()).drop("reject"), path, given["include_signature"], run, facts | {"rejects": rejects})
    discard(whole)
    return entry


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(filing_type, filename, reason) of all committed runs."""
    paths = [f"{path}/{e['rejects']}" for e in committed(spark, path).values() if "rejects" in e]
    schema = strings(["filing_type", "filename", "reason"])
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)


def with_metadata(df: DataFrame) -> DataFrame:
    """df with all metadata columns; those it lacks are null."""
    return df.withColumns({c: F.lit(None).cast("string") for c in METADATA if c not in df.columns})
