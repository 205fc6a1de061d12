"""Sources, sinks and the file stream, on files made by the tests."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import index as I
from ledgerleaf.plans import jobs, synth as Y
from ledgerleaf.sources import tables as R
from ledgerleaf.sources.commits import committed
from ledgerleaf.streaming.incremental import _drive, extract_new_filings_stream, extract_new_rows_stream, waiting


def test_master_index(spark, tmp_path):
    (tmp_path / "m.idx").write_bytes(("\n".join(["Description: x", "CIK|Company Name|Form Type|Date Filed|Filename", "-----"] + ['320193|APPL\xc9 "INC|10-K|2020-10-30|a/b/0001.txt']) + "\n").encode("latin-1"))
    (row,) = R.read_master_index(spark, str(tmp_path / "m.idx")).collect()
    assert row["Company"] == 'APPL\xc9 "INC' and row["html_index"] == "a/b/0001-index.html"


def test_quarter_indices(spark, tmp_path):
    (tmp_path / "2020_QTR1.tsv").write_text("1|A|10-K|2020-01-01|a.txt|a-index.html\n2|N/A|8-K|2020-01-02|b.txt|b-index.html\n")
    rows = R.read_quarter_indices(spark, str(tmp_path), range(2020, 2022), [1, 2]).collect()
    assert [(r["CIK"], r["Company"], r["filename"]) for r in rows] == [("1", "A", None), ("2", None, None)]
    assert R.read_quarter_indices(spark, str(tmp_path), range(2010, 2011), [1]).count() == 0


def test_metadata_round_trip(spark, tmp_path):
    rows = jobs.with_metadata(spark.createDataFrame([("1", 'A "quoted", name', None), ("2", "NA", "x")], "CIK string, Company string, SIC string"))
    path = str(tmp_path / "meta")
    for _ in range(2):
        R.write_filings_metadata(rows, path)
    got = {r["CIK"]: (r["Company"], r["SIC"]) for r in R.read_filings_metadata(spark, path).collect()}
    assert got == {"1": ('A "quoted", name', None), "2": (None, "x")}


def test_metadata_survives_a_crash_between_the_renames(spark, tmp_path):
    rows = jobs.with_metadata(spark.createDataFrame([("1", "A", None)], "CIK string, Company string, SIC string"))
    path = tmp_path / "meta"
    R.write_filings_metadata(rows, str(path))
    path.rename(tmp_path / "meta.old")
    failing = rows.withColumn("CIK", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        R.write_filings_metadata(failing, str(path))
    assert R.read_filings_metadata(spark, str(path)).count() == 1
    R.write_filings_metadata(rows.union(rows), str(path))
    assert R.read_filings_metadata(spark, str(path)).count() == 2 and not (tmp_path / "meta.old").exists()


def test_names_with_blanks_are_listed_as_they_are_read(spark, tmp_path):
    (tmp_path / "8-K").mkdir()
    (tmp_path / "8-K" / "a b.htm").write_text("x")
    (read,) = R.read_raw_filings(spark, str(tmp_path)).collect()
    assert R.list_raw_filings(spark, str(tmp_path)).collect() == [(read["Type"], read["filename"])] == [("8-K", "a b.htm")]


def test_raw_filings_are_written_by_their_tasks_and_read_in_few(spark, tmp_path):
    """No rename, task or folder of its own for each of many small files."""
    rows = spark.range(400).selectExpr("if(id % 2 = 0, '10-K', '8 K%20') AS Type", "concat('a b%', id, '.htm') AS filename", "concat('x\\r\\n', id) AS content")
    assert R.write_raw_filings(rows, root := str(tmp_path / "raw %41")) == 400
    assert sorted(p.name for p in (tmp_path / "raw %41").iterdir()) == ["10-K", "8 K%20"] and (tmp_path / "raw %41" / "10-K" / "a b%2.htm").read_bytes() == b"x\r\n2"
    (tmp_path / "raw %41" / "10-K" / "._hidden").write_text("x")
    read = R.read_raw_filings(spark, root)
    assert read.rdd.getNumPartitions() <= 4 and read.count() == 400
    assert {tuple(r) for r in read.collect()} == {(("10-K", "8 K%20")[i % 2], f"a b%{i}.htm", f"x\n{i}") for i in range(400)}


def test_raw_filings_are_decoded(spark, tmp_path):
    (tmp_path / "10-K").mkdir()
    (tmp_path / "10-K" / "1_a.txt").write_bytes(b"a\xffb\r\nc\rd")
    (row,) = R.read_raw_filings(spark, str(tmp_path)).collect()
    assert (row["Type"], row["filename"], row["content"]) == ("10-K", "1_a.txt", "a\\xffb\nc\nd")
    assert R.list_raw_filings(spark, str(tmp_path)).collect() == [("10-K", "1_a.txt")]


def test_company_files(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"0": {"cik_str": 1, "ticker": "A", "title": "x"}, "1": {"cik_str": 2, "ticker": "A"}, "2": {"cik_str": 3, "ticker": "B"}}))
    tickers = R.read_company_tickers(spark, str(tmp_path / "t.json"))
    assert sorted(map(tuple, tickers.collect())) == [("A", "2"), ("B", "3")]
    (tmp_path / "l.txt").write_text(" A \n\n77\nzz\n")
    entries = R.read_company_list(spark, str(tmp_path / "l.txt"))
    assert sorted(r[0] for r in I.resolve_companies(entries, tickers).collect()) == ["2", "77"]
    (tmp_path / "c.json").write_text(json.dumps({"1": {"Company Name": "X", "SIC": None, "State location": "NY", "State of Inc": "DE", "Fiscal Year End": "1231"}}))
    held = R.read_company_info(spark, str(tmp_path / "c.json"))
    new = held.withColumn("SIC", F.lit("9")).unionByName(held.withColumn("CIK", F.lit("2")))
    assert sorted((r["CIK"], r["SIC"]) for r in R.upsert_company_info(held, new).collect()) == [("1", None), ("2", None)]


def test_extracted_filings_keep_nulls(spark, sf, tmp_path):
    filings, rejects = jobs.extract_filings(Y.filing_metadata(spark, sf), Y.filings(spark, sf).drop("doc_id", "_form"))
    for _ in range(2):  # a run that is repeated leaves one copy
        R.write_extracted_filings(filings, str(tmp_path / "out"), run="one")
    back = R.read_extracted_filings(spark, str(tmp_path / "out"), "10-K")
    assert back.where("item_1 LIKE 'ITEM 1. Business%'").count() == 50 and rejects.count() == 0
    line = next((tmp_path / "out").glob("one/*/type=10-K/form=10-K/*.json")).read_text().splitlines()[0]
    assert '"sic":null' in line


def test_stream_gives_what_the_batch_gives_and_no_file_twice(spark, sf, tmp_path):
    meta = Y.filing_metadata(spark, sf)
    rows = Y.filings(spark, sf).where("doc_id < 24").select("Type", "filename", "content").collect()
    raw, out, seen = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "seen")
    for half in (rows[:12], rows[12:]):
        for r in half:
            (raw / r["Type"]).mkdir(parents=True, exist_ok=True)
            (raw / r["Type"] / r["filename"]).write_text(r["content"], newline="")
        extract_new_filings_stream(spark, meta, str(raw), out, seen)
    want, _ = jobs.extract_filings(meta, R.read_raw_filings(spark, str(raw)))
    R.write_extracted_filings(want, batch := str(tmp_path / "batch"))
    assert sum(v["done"] for k, v in committed(spark, out).items() if k != "waiting") == 24 and all_filings(spark, out) == all_filings(spark, batch)


def all_filings(spark, path):
    return {f: sorted(repr(tuple(r)) for r in R.read_extracted_filings(spark, path, f).collect()) for f in R.FORMS}


def put(root, rows):
    for r in rows:
        (root / r["Type"]).mkdir(parents=True, exist_ok=True)
        (root / r["Type"] / r["filename"]).write_text(r["content"], newline="")


def test_files_that_come_before_their_metadata_wait(spark, sf, tmp_path):
    meta = Y.filing_metadata(spark, sf).where("Type <> '10-Q'")
    rows = Y.filings(spark, sf).where("doc_id < 24 AND Type <> '10-Q'").select("Type", "filename", "content").collect()
    raw, out, seen = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "seen")
    put(raw, rows)
    early = meta.where("Type = '8-K'")
    extract_new_filings_stream(spark, early, str(raw), out, seen)
    assert waiting(spark, out)[0].count() == 6 and len(all_filings(spark, out)["10-K"]) == 0
    # the same again changes nothing; then the metadata comes, without any new file
    extract_new_filings_stream(spark, early, str(raw), out, seen)
    extract_new_filings_stream(spark, meta, str(raw), out, seen)
    want, _ = jobs.extract_filings(meta, R.read_raw_filings(spark, str(raw)))
    R.write_extracted_filings(want, batch := str(tmp_path / "batch"))
    assert all_filings(spark, out) == all_filings(spark, batch) and waiting(spark, out)[0].count() == 0
    # a batch that is repeated, as after a crash, starts from what waited before it and changes nothing either
    _drive(R.list_raw_files(spark, str(raw)), early, out, "batch-0", 0)
    assert all_filings(spark, out) == all_filings(spark, batch)


def test_rows_that_come_before_their_metadata_wait(spark, sf, tmp_path):
    meta = Y.filing_metadata(spark, sf).where("Type = '8-K'")
    Y.filings(spark, sf).where("doc_id < 24 AND Type = '8-K'").select("Type", "filename", "content").write.parquet(raw := str(tmp_path / "raw"))
    out, seen = str(tmp_path / "out"), str(tmp_path / "seen")
    extract_new_rows_stream(spark, meta.where("filename <> '2_f.htm'"), raw, out, seen)
    assert [r["filename"] for r in waiting(spark, out)[0].collect()] == ["2_f.htm"]
    extract_new_rows_stream(spark, meta, raw, out, seen)
    assert R.extracted_keys(spark, out).count() == 12 == R.extracted_keys(spark, out).distinct().count()


def test_runs_add_to_what_is_there(spark, sf, tmp_path):
    """The second run has filings of another form; it is repeated, and a third run has nothing to do."""
    meta, raw = Y.filing_metadata(spark, sf).where("filename RLIKE '^[0-9]_'"), Y.filings(spark, sf).where("doc_id < 10").drop("doc_id", "_form")
    out = str(tmp_path / "out")
    one = jobs.extract_run(meta.where("Type = '10-K'"), raw, out, "one")
    two = [jobs.extract_run(meta, raw, out, "two") for _ in range(2)]
    three = jobs.extract_run(meta, raw, out, "three")
    assert (one["done"], two[0]["done"], two[1]["done"], three["todo"]) == (3, 7, 7, 0)
    want, _ = jobs.extract_filings(meta, raw)
    R.write_extracted_filings(want, whole := str(tmp_path / "whole"))
    assert all_filings(spark, out) == all_filings(spark, whole)
    with pytest.raises(ValueError):
        jobs.extract_run(meta, raw, out, "../x")


def test_a_run_that_fails_leaves_nothing(spark, sf, tmp_path):
    meta, raw = Y.filing_metadata(spark, sf).where("filename RLIKE '^[0-9]_'"), Y.filings(spark, sf).where("doc_id < 10").drop("doc_id", "_form")
    out = str(tmp_path / "out")
    jobs.extract_run(meta.where("Type = '8-K'"), raw, out, "one")
    before = all_filings(spark, out)
    with pytest.raises(Exception, match="broken"):
        jobs.extract_run(meta, raw.withColumn("content", F.raise_error(F.lit("broken")).cast("string")), out, "one")
    assert all_filings(spark, out) == before


def test_counts_and_rejects_of_a_run(spark, tmp_path):
    kinds = [("10-K", "2020-01-01", "a.htm"), ("4", "2020-01-01", "b.htm"), ("10-K", "2020-01-01", "c.htm"), ("8-K", "2010/13/99", "d.htm"), ("8-K", None, "e.htm"), ("10-K", "2020-01-01", "f.htm"), ("10-K", "2020-01-01", "g.htm"), ("8-K", "2020-01-01", "h.htm")]
    meta = jobs.with_metadata(spark.createDataFrame(kinds, "Type string, Date string, filename string"))
    (tmp_path / "raw" / "10-K").mkdir(parents=True)
    (tmp_path / "raw" / "8-K").mkdir()
    for name, text in (("a", "\nITEM 1. A\nx y\nSIGNATURE\nz"), ("c", "nothing here"), ("g", "\nITEM 1. A\nx <![bad[ y"), ("unasked", "x")):
        (tmp_path / "raw" / "10-K" / f"{name}.htm").write_text(text)
    (tmp_path / "raw" / "8-K" / "h.htm").write_text("\nItem 5.02 x\n")
    files = R.list_raw_files(spark, str(tmp_path / "raw"))
    rows = spark.createDataFrame(R.read_raw_filings(spark, str(tmp_path / "raw")).collect())
    out = str(tmp_path / "out")
    gone = files.withColumn("file", F.when(F.col("filename") == "h.htm", "file:/nowhere/h.htm").otherwise(F.col("file")))
    entry = jobs.extract_run(meta, gone, out, items=["1", "5.02"])
    assert (entry["todo"], entry["done"], entry["empty"]) == (8, 1, 1)
    assert entry["failed"] == {"unknown filing type": 1, "no valid date": 2, "no raw filing": 1, "cannot be read": 1, "cannot be cut": 1}
    got = {r["filename"]: r["reason"] for r in jobs.read_rejects(spark, out).collect()}
    assert got.pop("g.htm").startswith("cannot be cut: AssertionError")
    assert got == {"b.htm": "unknown filing type", "c.htm": "no section has text", "d.htm": "no valid date", "e.htm": "no valid date", "f.htm": "no raw filing", "h.htm": "cannot be read: FileNotFoundError"}
    filings, rejects = jobs.extract_filings(meta, rows, items=["1", "5.02"])
    assert sorted(r["filename"] for r in filings.collect()) == ["a.htm", "h.htm"] and sorted(r["filename"] for r in rejects.collect()) == ["b.htm", "d.htm", "e.htm", "f.htm", "g.htm"]


def test_contents_are_read_by_path_and_only_the_wanted(spark, tmp_path):
    names = ["a b.htm", "c%d.htm", "e#f.htm", "g+h.htm", "ü.htm", "plain.htm"]
    (tmp_path / "10-K").mkdir()
    for n in [*names, "other.htm"]:
        (tmp_path / "10-K" / n).write_bytes(f"{n}\r\n\xff".encode("latin-1"))
    files = R.list_raw_files(spark, str(tmp_path))
    meta = spark.createDataFrame([("10-K", n) for n in names], "Type string, filename string")
    for limit in (10, 0):
        got = R.with_contents(I.attach_content(meta, files, limit))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert all("content#" not in line and "content:" not in line for line in plan.splitlines() if "Exchange" in line or "FileScan" in line)
        texts = {r["filename"]: (r["content"], r["unread"]) for r in got.collect()}
        assert set(texts) == set(names) and texts["a b.htm"] == ("a b.htm\n\\xff", None) and all(e is None for _, e in texts.values())


def test_companies_are_written_where_they_are_read(spark, tmp_path):
    company = lambda k, sic: {"Company Name": f"n{k}", "SIC": sic, "State location": "NY", "State of Inc": None, "Fiscal Year End": "1231"}
    path = str(tmp_path / "companies")
    frame = lambda ks, sic: spark.createDataFrame([(str(k), *company(k, sic).values()) for k in ks], R.strings(["CIK", *R.COMPANY.names]))
    R.write_company_info(frame([1, 2], "a"), path)
    for ks in ([2, 3], [3, 4], [5]):
        R.write_company_info(R.upsert_company_info(R.read_company_info(spark, path), frame(ks, "b")), path)
    with pytest.raises(Exception, match="broken"):
        R.write_company_info(R.read_company_info(spark, path).withColumn("CIK", F.raise_error(F.lit("broken")).cast("string")), path)
    got = sorted((r["CIK"], r["SIC"], r["State of Inc"]) for r in R.read_company_info(spark, path).collect())
    assert got == [("1", "a", None), ("2", "a", None), ("3", "b", None), ("4", "b", None), ("5", "b", None)]
    assert len([p for p in (tmp_path / "companies" / "current").iterdir()]) == 3  # two versions and the failed attempt


def test_an_index_by_quarter_is_read_by_folder(spark, sf, tmp_path):
    rows = Y.index_rows(spark, sf).unionByName(Y.index_rows(spark, sf).limit(1).withColumn("Date", F.lit("2001/99/1")))
    path = str(tmp_path / "index")
    for _ in range(2):
        R.write_index(rows, path)
    one = R.read_index(spark, path, range(2001, 2002), [2])
    assert {p.split("/")[-3] + "/" + p.split("/")[-2] for p in one.inputFiles()} >= {"year=2001/quarter=2"}
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "year" in filters.split("PartitionFilters")[1].split("PushedFilters")[0] and "quarter" in filters
    assert one.count() == rows.where("Date LIKE '2001-04%' OR Date LIKE '2001-05%' OR Date LIKE '2001-06%'").count() > 0
    files = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert all("year=2001/quarter=2" in r["f"] for r in files)
    assert spark.read.parquet(path).count() == rows.count()


def test_rejects_and_skips(spark):
    meta = jobs.with_metadata(spark.createDataFrame([("10-K", "2020-01-01", "a.htm"), ("4", "2020-01-01", "b.htm"), ("10-K", "2020-01-01", "c.htm")], "Type string, Date string, filename string"))
    raw = spark.createDataFrame([("10-K", "a.htm", "\nITEM 1. A\nx y\nSIGNATURE\nz"), ("10-K", "c.htm", "nothing here")], "Type string, filename string, content string")
    filings, rejects = jobs.extract_filings(meta, raw)
    assert [r["filename"] for r in filings.collect()] == ["a.htm"] and [tuple(r) for r in rejects.collect()] == [("b.htm", "unknown filing type")]
    done = spark.createDataFrame([("10-K", "a.json")], "filing_type string, filename string")
    assert jobs.extract_filings(meta, raw, extracted=done)[0].count() == 0


def test_bucketed_contents_are_not_shuffled(spark, sf, tmp_path):
    raw = R.write_raw_table(Y.filings(spark, sf).drop("doc_id", "_form"), "raw_of_the_test", str(tmp_path / "raw"), 4)
    got = I.attach_content(Y.filing_metadata(spark, sf).repartition(3).hint("merge"), raw, 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and got.count() == 200
    spark.sql("DROP TABLE raw_of_the_test")
