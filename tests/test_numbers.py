"""Queries over documents whose tenths, or lines of them, are a number alone: it is the document's words, no page number."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions import text as X
from ledgerleaf.plans import registry

NUMBERS = ["4566095658496433", "17", "-13-", "8"]
TEXTS = [" ".join((NUMBERS * 2)[:n]) for n in range(1, 8)] + ["a.\n12\nb c", "12\n13 14\n15 16\n17", "x 12\nA b.\n13 c d", "\n".join(NUMBERS), "7 <b>& 8"]


@pytest.fixture(scope="module")
def numbers(tmp_path_factory):
    """Every text under ids of every form, case and ending."""
    d = tmp_path_factory.mktemp("numbers")
    texts = [t for t in TEXTS for _ in range(60)]
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}), d / "documents.parquet")
    return str(d)


@pytest.mark.parametrize("name", ["w2_segment_by_headers", "x2_locate_headers", "x3_extract_section", "x3_sections_to_the_end", "x4_extract_10k", "x5_extract_8k", "x6_repaired_parts", "x6_split_10q_parts", "x7_extract_10q", "x8_extract_filings", "x8_signature_only", "x9_sections_wide", "x9_wide_to_long", "r1_extract_stream", "s6_extracted_files", "s6_runs", "t14_filing_text"])
def test_numbers_stay(spark, numbers, name):
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{numbers}/documents.parquet'")
        want = con.execute(registry.oracle_sql()[name])
        names = [c[0] for c in want.description]
        rows = sorted(map(repr, want.fetchall()))
    assert sorted(repr(tuple(r)) for r in registry.queries()[name](spark, numbers).select(*names).collect()) == rows


def test_unmarked_numbers_go(spark):
    """The rule itself is as it was: a line that is a number alone is a page number."""
    got = spark.createDataFrame([("\nITEM 7. x\n\n4566095658496433\n-12-\n\nand 5 F-1\n",)], "t string").select(X.clean_text(F.col("t"))).first()[0]
    assert got == "\nITEM 7. x\n\n-12-\n\nand 5\n"
