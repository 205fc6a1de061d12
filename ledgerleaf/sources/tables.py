"""Sources and sinks: indices, metadata, raw filings, extracted filings, companies."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.batches import with_helper
from ..operators.index import prune_quarters
from ..operators.sections import out_keys, sections_wide
from .commits import commit, committed, new_folder
from .scratch import cut, discard

# The metadata columns in order, and the tokens that a CSV of them uses for null.
METADATA = ["CIK", "Company", "Type", "Date", "complete_text_file_link", "html_index", "Filing Date", "Period of Report", "SIC", "htm_file_link", "State of Inc", "State location", "Fiscal Year End", "filename"]
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# Output key and metadata column of each field of an extracted filing, in order.
OUTPUT = {
    "cik": "CIK", "company": "Company", "filing_type": "Type", "filing_date": "Date", "period_of_report": "Period of Report", "sic": "SIC",
    "state_of_inc": "State of Inc", "state_location": "State location", "fiscal_year_end": "Fiscal Year End", "filing_html_index": "html_index",
    "htm_filing_link": "htm_file_link", "complete_text_filing_link": "complete_text_file_link", "filename": "filename",
}
COMPANY = T.StructType([T.StructField(c, T.StringType()) for c in ("Company Name", "SIC", "State location", "State of Inc", "Fiscal Year End")])


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def null_tokens(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_master_index(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A pipe-delimited Latin-1 index. Its preamble is known by a CIK that is no number, so files stay splittable."""
    rows = spark.read.csv(paths, sep="|", encoding="ISO-8859-1", quote="", schema=strings(["CIK", "Company", "Type", "Date", "complete_text_file_link"]))
    return rows.where(F.col("CIK").rlike("^[0-9]+$")).withColumn("html_index", index_page_link(F.col("complete_text_file_link")))


def index_page_link(link: Column) -> Column:
    """P4."""
    return F.replace(link, F.lit(".txt"), F.lit("-index.html"))


def read_quarter_indices(spark: SparkSession, folder: str, years: range, quarters: list[int], today: dt.date | None = None) -> DataFrame:
    """The files <year>_QTR<q>.tsv that exist, as one table of METADATA columns; short rows end in nulls."""
    wanted = [(y, q) for y in years for q in checked_quarters(quarters) if not_later(y, q, today)]
    there = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [p for y, q in wanted if there.exists(spark._jvm.org.apache.hadoop.fs.Path(p := f"{folder}/{y}_QTR{q}.tsv"))]
    if not paths:
        return spark.createDataFrame([], strings(METADATA))
    return null_tokens(spark.read.csv(paths, sep="|", quote="", schema=strings(METADATA), mode="PERMISSIVE"))


def write_index(df: DataFrame, path: str) -> None:
    """Index rows as a table laid out by year and quarter of their Date; quarters of df replace those that are there, others
    stay. Rows without a valid date are in the folder of null."""
    day = F.try_to_date(F.col("Date"))
    rows = df.withColumns({"year": F.year(day), "quarter": F.quarter(day)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "quarter").parquet(path)


def read_index(spark: SparkSession, path: str, years: range, quarters: list[int], today: dt.date | None = None) -> DataFrame:
    """P1 on the layout of write_index: only the folders of the wanted quarters are read."""
    if not len(years):
        raise ValueError("no years")
    return prune_quarters(spark.read.parquet(path), years[0], years[-1], quarters, today or dt.date.today())


def checked_quarters(quarters: list[int]) -> list[int]:
    if bad := [q for q in quarters if q not in (1, 2, 3, 4)]:
        raise ValueError(f"no such quarters: {bad}")
    return quarters


def not_later(year: int, quarter: int, today: dt.date | None = None) -> bool:
    today = today or dt.date.today()
    return (year, quarter) <= (today.year, (today.month + 2) // 3)


def read_filings_metadata(spark: SparkSession, path: str) -> DataFrame:
    """S3: CSV with a header, all strings, usual tokens for null."""
    return null_tokens(spark.read.csv(path, header=True, schema=strings(METADATA), quote='"', escape='"', multiLine=False))


def write_filings_metadata(df: DataFrame, path: str) -> None:
    """Written under a new name and then swapped, so that a failed job leaves the old table. A run that was cut off
    between the renames left it as path.old, from where it is brought back first; path.old goes only when path is there."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def move(source: str, target: str) -> None:
        if not files.rename(at(source), at(target)):
            raise OSError(f"cannot rename {source} to {target}")

    if files.exists(at(f"{path}.old")):
        if files.exists(at(path)):
            files.delete(at(f"{path}.old"), True)
        else:
            move(f"{path}.old", path)
    df.select(*[F.col(f"`{c}`") for c in METADATA]).write.mode("overwrite").csv(f"{path}.new", header=True, quote='"', escape='"')
    if files.exists(at(path)):
        move(path, f"{path}.old")
    move(f"{path}.new", path)
    files.delete(at(f"{path}.old"), True)


def decode(raw: bytes | None) -> str | None:
    """UTF-8 with bad bytes as \\xNN and all line ends as \\n."""
    return None if raw is None else bytes(raw).decode("utf-8", "backslashreplace").replace("\r\n", "\n").replace("\r", "\n")


def _path_parts() -> list[Column]:
    """Type and filename from the path of a file; the file source writes blanks as %20."""
    parts = F.reverse(F.split(F.replace("path", F.lit("%20"), F.lit(" ")), "/"))
    return [parts[1].alias("Type"), parts[0].alias("filename")]


def read_raw_filings(spark: SparkSession, root: str) -> DataFrame:
    """All files <root>/<Type>/<filename>, content decoded. The files are dealt to tasks by their bytes: the file source
    puts at most 32 small ones into a task. A file that cannot be read is an error."""
    rows = with_contents(list_raw_files(spark, root))
    return rows.select("Type", "filename", F.when(F.col("unread").isNull(), F.col("content")).otherwise(F.raise_error(F.concat("filename", F.lit(" "), "unread"))).alias("content"))


def write_raw_filings(raw: DataFrame, root: str) -> int:
    """Raw filings as files <root>/<Type>/<filename>, put there by the tasks, and how many. A file has its name when it is whole."""
    at = raw.sparkSession._jvm.org.apache.hadoop.fs.Path(root)
    root = at.getFileSystem(raw.sparkSession._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kind, name, content in zip(*(b.column(i) for i in range(3)), strict=True):
                _put(f"{root}/{quote(kind.as_py())}", name.as_py(), content.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    rows = raw.select("Type", "filename", F.encode("content", "UTF-8").alias("content"))
    return rows.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def write_raw_table(raw: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Raw filings as a table at path, bucketed by type and filename, as J6 joins them: written once, its contents are not
    shuffled again whatever the number of filings."""
    raw.write.mode("overwrite").option("path", path).bucketBy(buckets, "Type", "filename").sortBy("Type", "filename").saveAsTable(name)
    return raw.sparkSession.table(name)


def list_raw_filings(spark: SparkSession, root: str) -> DataFrame:
    """(Type, filename) of all raw filings; contents are not read."""
    return list_raw_files(spark, root).select("Type", "filename")


def list_raw_files(spark: SparkSession, root: str) -> DataFrame:
    """(Type, filename, file, length) of all raw filings as they are now, file being its address; contents are not read.

    A task lists a folder right below root with all that is in it and its entries go into a table, so neither the driver nor
    a plan has them all. Names with a dot or an underscore at their head are passed over, as the file source does."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    top = [(s.getPath().toUri().toString(), s.isDirectory(), s.getLen()) for s in files.listStatus(at) if s.getPath().getName()[0] not in "._"]
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in ("Type", "filename", "file")], T.StructField("length", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(found: list[tuple[str, int]]) -> pa.RecordBatch:
            names = [unquote(urlsplit(a).path).split("/")[-2:] for a, _ in found]
            columns = [[n[0] for n in names], [n[1] for n in names], [a for a, _ in found], [size for _, size in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 3 else pa.string()) for i, c in enumerate(columns)], names=schema.names)

        for b in batches:
            for address, folder, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = []
                for entry in _under(address) if folder else [(address, size)]:
                    found.append(entry)
                    if len(found) == 10_000:
                        yield made(found)
                        found = []
                if found:
                    yield made(found)

    # one row a folder: as many as there are types
    tops = spark.createDataFrame(top, "address string, folder boolean, size long").repartition(max(1, len(top)), "address")
    return cut(tops.mapInArrow(run, schema), "listing")


def listed(files: DataFrame) -> DataFrame:
    """The same of rows of the binaryFile source, of a stream too."""
    return files.select(*_path_parts(), F.col("_metadata.file_path").alias("file"), "length")


def _local(address: str) -> str | None:
    """The path of an address in the file system of the machine, else null."""
    parts = urlsplit(address)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def _bytes_of(address: str) -> bytes:
    if path := _local(address):
        with open(path, "rb") as f:
            return f.read()
    files, path = pyarrow.fs.FileSystem.from_uri(address)
    with files.open_input_stream(path) as f:
        return f.read()


def _put(folder: str, name: str, content: bytes) -> None:
    draft = f".{uuid.uuid4().hex}"
    if path := _local(folder):
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{draft}", "wb") as f:
            f.write(content)
        os.replace(f"{path}/{draft}", f"{path}/{name}")
        return
    files, path = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(path)
    with files.open_output_stream(f"{path}/{draft}") as f:
        f.write(content)
    files.move(f"{path}/{draft}", f"{path}/{name}")


def _under(address: str) -> Iterator[tuple[str, int]]:
    """(address, length) of all files below a folder."""
    if not (path := _local(address)):
        files, path = pyarrow.fs.FileSystem.from_uri(address)
        base = address[: len(address) - len(urlsplit(address).path)]
    todo = [path]
    while todo:
        if _local(address):
            with os.scandir(folder := todo.pop()) as entries:
                found = ((f"{folder}/{e.name}", e.name, e.is_dir(), 0 if e.is_dir() else e.stat().st_size) for e in entries)
                for at, name, is_dir, size in found:
                    if name[0] not in "._":
                        if is_dir:
                            todo.append(at)
                        else:
                            yield f"file://{quote(at)}", size
        else:
            for e in files.get_file_info(pyarrow.fs.FileSelector(todo.pop())):
                if e.base_name[0] not in "._":
                    if e.type == pyarrow.fs.FileType.Directory:
                        todo.append(e.path)
                    else:
                        yield f"{base}{quote(e.path)}", e.size


def with_contents(files: DataFrame, task_bytes: int = 64 << 20, step: int = 4 << 20) -> DataFrame:
    """J6 by path: rows with file and length, and instead of these content (decoded) and unread (why it could not be read).

    The tasks open the files that the rows name and no others, so what is joined and dealt out before is addresses alone, of
    any number of filings; contents arise where they are worked on. Files are dealt to tasks of about task_bytes; a task
    hands on some `step` bytes at a time.
    """
    kept = [c for c in files.columns if c not in ("file", "length", "content", "unread")]
    total = files.agg(F.sum(F.col("length").cast("long"))).first()[0] or 0
    schema = T.StructType([*[files.schema[c] for c in kept], T.StructField("content", T.StringType()), T.StructField("unread", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(b: pa.RecordBatch, at: int, texts: list, errors: list) -> pa.RecordBatch:
            rows = b.slice(at - len(texts), len(texts))
            return pa.RecordBatch.from_arrays([*rows.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=schema.names)

        for b in batches:
            texts, errors, held = [], [], 0
            for i, address in enumerate(b.column(len(kept)).to_pylist()):
                try:
                    raw, error = _bytes_of(address), None
                except OSError as e:
                    raw, error = None, f"cannot be read: {type(e).__name__}"
                texts.append(decode(raw))
                errors.append(error)
                if (held := held + len(raw or b"")) >= step:
                    yield made(b, i + 1, texts, errors)
                    texts, errors, held = [], [], 0
            if texts:
                yield made(b, b.num_rows, texts, errors)

    rows = files.select(*[F.col(f"`{c}`") for c in kept], "file")
    return rows.repartition(max(1, -(-total // task_bytes), min(files.sparkSession.sparkContext.defaultParallelism, total // step)), F.xxhash64("file")).mapInArrow(run, schema)


FORMS = ("10-K", "10-Q", "8-K", "8-K-old")


def _form_folder(form: str) -> str:
    return f"type={form.removesuffix('-old')}/form={form}"


def write_extracted_filings(df: DataFrame, path: str, include_signature: bool = False, run: str | None = None, facts: dict | None = None) -> dict:
    """JSON Lines by form, nulls kept, one frame of fixed columns per form, in the folders of a run of its own, which
    readers take up when all of it is there, with a table of its keys. Runs before stay as they are; a run that is repeated under its name takes its own
    place. facts go into the run's entry, which is returned. The extraction runs once: its result is written and then split.
    """
    filings = cut(df, "extracted")
    entry = put_out_filings(filings, path, include_signature, run, facts)
    discard(filings)
    return entry


def put_out_filings(filings: DataFrame, path: str, include_signature: bool = False, run: str | None = None, facts: dict | None = None) -> dict:
    """The same of filings that lie in a table already, as they are read once a form."""
    spark = filings.sparkSession
    name = run or f"run-{uuid.uuid4().hex}"
    folder = new_folder(name)
    forms = {r["form"]: r["count"] for r in filings.groupBy("form").count().collect()}  # at most four
    for form in FORMS:
        if form in forms:
            wide = sections_wide(filings, form, *[F.col(f"`{c}`") for c in OUTPUT], include_signature=include_signature)
            wide.write.option("ignoreNullFields", "false").json(f"{path}/{folder}/{_form_folder(form)}")
    filings.select("filing_type", "filename").write.parquet(f"{path}/{folder}/keys")
    return commit(spark, path, name, {"folder": folder, "forms": forms, "filings": sum(forms.values())} | (facts or {}))


def _run_folders(spark: SparkSession, path: str, but: str | None = None) -> list[dict]:
    return [e for name, e in committed(spark, path).items() if name != but and "forms" in e]


def read_extracted_filings(spark: SparkSession, path: str, form: str, include_signature: bool = False) -> DataFrame:
    """The filings of a form that all committed runs have put out."""
    schema = strings([*OUTPUT, *out_keys(form, include_signature)])
    paths = [f"{path}/{e['folder']}/{_form_folder(form)}" for e in _run_folders(spark, path) if form in e["forms"]]
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)


def extracted_keys(spark: SparkSession, path: str, but: str | None = None) -> DataFrame:
    """(filing_type, filename) of all filings that are put out, for J7, out of tables of keys alone; but: a run that is not
    asked, as one that is repeated must find the same filings to do."""
    schema = strings(["filing_type", "filename"])
    paths = [f"{path}/{e['folder']}/keys" for e in _run_folders(spark, path, but)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def tickers_of(rows: DataFrame) -> DataFrame:
    """(ticker, cik) of rows (ticker, cik, pos): the last of equal tickers."""
    return rows.groupBy("ticker").agg(F.max_by("cik", "pos").alias("cik"))


def read_company_tickers(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of objects with ticker and cik_str."""
    kind = "map<string, struct<cik_str: bigint, ticker: string>>"
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.map_values(F.from_json("value", kind))).alias("pos", "c"))
    return tickers_of(rows.select("c.ticker", F.col("c.cik_str").cast("string").alias("cik"), "pos"))


def read_company_info(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object by CIK, or what write_company_info has put there last."""
    kind, held = T.MapType(T.StringType(), COMPANY), committed(spark, path).get("current")
    lines = spark.read.text(f"{path}/{held['folder']}") if held else spark.read.text(path, wholetext=True)
    return lines.select(F.explode(F.from_json("value", kind)).alias("CIK", "c")).select("CIK", "c.*")


def write_company_info(df: DataFrame, path: str) -> None:
    """Puts df in the place of the companies at path, a JSON object by CIK in each line. df may come from
    read_company_info(path) itself: the version that is read stays until the write after this one, and counts until this one
    is whole."""
    folder = new_folder("current")
    facts = F.struct(*[F.col(f"`{c}`") for c in COMPANY.names])
    df.select(F.to_json(F.create_map(F.col("CIK"), facts), {"ignoreNullFields": "false"}).alias("value")).write.text(f"{path}/{folder}")
    commit(df.sparkSession, path, "current", {"folder": folder})


def upsert_company_info(held: DataFrame, new: DataFrame) -> DataFrame:
    """Held companies as they are, and the new ones that are not held."""
    return held.unionByName(new.join(held.select("CIK"), "CIK", "left_anti"))


def read_company_list(spark: SparkSession, path: str) -> DataFrame:
    """One entry per line, stripped, blank lines left out."""
    return spark.read.text(path).select(F.trim("value").alias("entry")).where("entry <> ''")


def output_metadata(df: DataFrame, *more: str) -> DataFrame:
    """The metadata columns under their output keys, in order."""
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in OUTPUT.items()], *more)


def sorted_tickers(tickers: DataFrame) -> DataFrame:
    """O1."""
    return tickers.orderBy("ticker")

