"""WARC archives: writing, normalising monolithic gzip to one member per record, and reading by offset index."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut, new_dir, table

#: Fixed value: a gzip member without content (its bytes as Latin-1). It closes a normalised archive.
END = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
BREAK = b"\r\n\r\n"
ENTRIES = "archive string, entries array<struct<page_id: long, offset: long, length: long>>"
#: Bytes of records that one archive holds, or one record of more; bytes that are inflated at once.
ARCHIVE_BYTES, STEP = 48 << 20, 1 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record without its closing break. A revisit holds the HTTP header alone; its length and digest are those of
    the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + BREAK
    block = http + payload if refers_to is None else http
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + BREAK + block


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC headers, HTTP header, payload) of one record."""
    head, _, block = raw.partition(BREAK)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
    http, _, payload = block[: int(fields["Content-Length"])].partition(BREAK)
    return fields, http, payload


def number(urn: str | None) -> int | None:
    return int(n) if urn and (n := urn[len("<urn:page:") : -1]) else None


def records(parts: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream of WARC bytes, closing breaks included, however the stream is cut into parts."""
    held, at, seen, need = bytearray(), 0, 0, None
    for part in parts:
        if at > len(held) // 2:  # what has been given is dropped now and then, so each byte moves a few times at most
            del held[:at]
            seen, need, at = seen - at, None if need is None else need - at, 0
        held += part
        while True:
            if need is None:
                end = held.find(BREAK, max(at, seen - len(BREAK)))
                if end < 0:
                    seen = len(held)
                    break
                size = next(int(x.split(b":")[1]) for x in bytes(held[at:end]).split(b"\r\n") if x.lower().startswith(b"content-length:"))
                need = end + len(BREAK) + size + len(BREAK)
            if len(held) < need:
                break
            yield bytes(held[at:need])
            at = seen = need
            need = None


def inflated(gz: bytes, step: int = STEP) -> Iterator[bytes]:
    """A gzip stream of one or more members, inflated once from end to end, at most `step` bytes at a time."""
    unpack, data = zlib.decompressobj(31), memoryview(gz)
    while len(data):
        rest = data[:step]
        data = data[len(rest) :]
        while len(rest):
            if part := unpack.decompress(rest, step):
                yield part
            if unpack.eof:
                rest, unpack = unpack.unused_data, zlib.decompressobj(31)
            else:
                rest = unpack.unconsumed_tail
    while part := unpack.decompress(b"", step) if not unpack.eof else b"":
        yield part


def _packed(raw: bytes, level: int = 6) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def normalise(gz: bytes) -> bytes:
    """A whole-file gzip stream as one member per record."""
    return b"".join(map(_packed, records(inflated(gz))))


def members(archive: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and record of each member that holds one."""
    at, view = 0, memoryview(archive)
    while at < len(archive):
        unpack, raw, end = zlib.decompressobj(31), [], at
        while not unpack.eof and end < len(archive):
            raw.append(unpack.decompress(view[end : end + (1 << 16)]))
            end = min(end + (1 << 16), len(archive))
        end -= len(unpack.unused_data)
        if record := b"".join(raw):
            yield at, end - at, record
        at = end


def offsets(archive: bytes) -> list[dict]:
    """Page, offset and length of each member that holds a record."""
    return [{"page_id": number(parse(r)[0].get("WARC-Record-ID")), "offset": at, "length": n} for at, n, r in members(archive)]


def _write_files(rows: DataFrame, path: str) -> None:
    """One file for each row of a binary column, which must hold gzip members: the text writer puts out a string's bytes as
    they are and END as line end, written as Latin-1, which closes the file with an empty member."""
    rows.select(F.col(rows.columns[0]).cast("string")).write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", END.decode("latin-1")).text(path)


def write_monolithic(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes one record per page into WARC files that are each a single gzip stream of at most ARCHIVE_BYTES of records
    (or one record of more), with an empty member at the end.

    Payload: the html in UTF-8, null as empty. Of pages with equal payloads (by SHA-256), that with the smallest key is a
    response and the others are revisits of it. Rows that repeat the smallest key are responses too. Null keys come last:
    they refer to the smallest key; if a payload has no other, all are responses. Only hashes are grouped; each payload
    moves once, with its own key, so a page that a third of all rows repeat makes no large task. An empty table gives no
    records; other columns are not read.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    given = pages.select(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("url"), payload.alias("html"), F.sha2(payload, 256).alias("sha"))
    # written, so that both sides of the join are exchanged and Spark can split the keys of one payload over tasks
    first = cut(given.groupBy("sha").agg(F.min("k").alias("first")), "first")
    kinds = given.select("k", "sha").distinct().join(first, "sha").withColumn("refers", F.when(~F.col("k").eqNullSafe(F.col("first")), F.col("first"))).select(F.col("k").alias("_k"), F.col("sha").alias("_sha"), "refers")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            html = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([zlib.compress(x, 1) for x in html], pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in html], pa.string())], ["k", "url", "packed", "sha"])

    # payloads are shuffled at every size, as what tells responses from revisits grows with them; packed, they are half as large
    packed = given.select("k", "url", "html").mapInArrow(pack, "k long, url string, packed binary, sha string")
    rows = packed.join(kinds.hint("shuffle_merge"), F.col("k").eqNullSafe(F.col("_k")) & (F.col("sha") == F.col("_sha"))).select("k", "url", "packed", "refers")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, n, stream = [], 0, zlib.compressobj(1, zlib.DEFLATED, 31)

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join([*made, stream.flush()])], pa.binary())], ["archive"])

        for b in batches:
            for k, u, x, r in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                raw = record(k, u, zlib.decompress(x), r) + BREAK
                if n and n + len(raw) > ARCHIVE_BYTES:
                    yield archive()
                    made, n, stream = [], 0, zlib.compressobj(1, zlib.DEFLATED, 31)
                made.append(stream.compress(raw))
                n += len(raw)
        if n:
            yield archive()

    _write_files(rows.mapInArrow(build, "archive binary"), path)


def normalise_archives(spark: SparkSession, source: str, path: str) -> None:
    """Rewrites each gzip WARC file under source: inflated once, every record its own member. Writes path/archives (a gzip
    file for each) and then the sidecar path/index (archive: the file's name; entries: page_id, offset and length), made
    from the archives as they were written. A file is handled whole by one task, so the size of archives bounds its memory."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(source).select("content")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for gz in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array([normalise(gz.as_py())], pa.binary())], ["members"])

    _write_files(files.mapInArrow(rewrite, "members binary"), f"{path}/archives")

    def list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct({"page_id": pa.int64(), "offset": pa.int64(), "length": pa.int64()}))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([offsets(x.as_py()) for x in b.column(1)], kind)], ["archive", "entries"])

    _archives(spark, path).mapInArrow(list_members, ENTRIES).write.parquet(f"{path}/index")


def _archives(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """(archive, content) of normalised archives, of those named alone if names are given; none if nothing was written."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    found = files.load(f"{path}/archives" if names is None else [f"{path}/archives/{n}" for n in names])
    return found.select(F.regexp_extract("path", "[^/]+$", 0).alias("archive"), "content")


_RECORD = pa.schema({"archive": pa.string(), "offset": pa.int64(), "length": pa.int64(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string(), "payload": pa.binary()})
RECORD = "archive string, offset long, length long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _fields(raw: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url and payload of a record. A response whose
    payload does not have its digest is an error."""
    fields, http, payload = parse(raw)
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    sha, full = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "response"
    if full and (len(payload) != size or digest(payload) != sha):
        raise ValueError(f"the payload of record {fields['WARC-Record-ID']} is damaged")
    return number(fields["WARC-Record-ID"]), size, sha, fields["WARC-Type"], number(fields.get("WARC-Refers-To")), fields["WARC-Target-URI"], payload if full else None


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_RECORD)], schema=_RECORD)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of the sidecar index: page_id, payload_bytes, payload_digest, record_type, refers_to, url and
    payload (null for revisits). Archives are read member by member where they lie; only what the index says of a record
    (archive, offset, length) is joined to it, so no content moves for the index, whatever its size. Without reading the
    payload column, payloads do not move either. A record that the index does not name is an error."""
    entries = spark.read.schema(ENTRIES).parquet(f"{path}/index").select(F.col("archive").alias("_archive"), F.explode("entries").alias("e"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, n = [], 0
                for at, length, raw in members(content.as_py()):
                    rows.append((name, at, length, *_fields(raw)))
                    if (n := n + len(raw)) > STEP:
                        yield _rows(rows)
                        rows, n = [], 0
                yield _rows(rows)

    there = (F.col("archive") == F.col("_archive")) & (F.col("offset") == F.col("e.offset")) & (F.col("length") == F.col("e.length"))
    told = _archives(spark, path).mapInArrow(read, RECORD).join(entries, there, "left")
    lost = F.raise_error(F.concat(F.lit("no index entry for a record of "), F.col("archive"))).cast("long")
    first, *others = _RECORD.names[3:]
    return told.select(F.when(F.col("_archive").isNull(), lost).otherwise(F.col(first)).alias(first), *others)


def read_pages(spark: SparkSession, path: str, pages: DataFrame, key: str = "page_id", most: int = 10_000) -> DataFrame:
    """The records of some pages (at most `most` entries of the index), each cut out of its archive at its offset; only
    archives that hold one are read. More entries are an error: read_archives is the way to read all."""
    index = spark.read.schema(ENTRIES).parquet(f"{path}/index").select("archive", F.explode("entries").alias("e"))
    wanted = index.join(pages.select(F.col(key).alias("_key")).distinct(), F.col("e.page_id") == F.col("_key"), "left_semi").limit(most + 1).collect()
    if len(wanted) > most:
        raise ValueError(f"more than {most} entries")
    at: dict[str, list] = {}
    for r in wanted:
        at.setdefault(r["archive"], []).append((r["e"]["offset"], r["e"]["length"]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                gz = content.as_py()
                yield _rows([(name, o, n, *_fields(zlib.decompress(gz[o : o + n], 31))) for o, n in at[name]])

    if not at:
        return spark.createDataFrame([], RECORD).select(*_RECORD.names[3:])
    return _archives(spark, path, sorted(at)).mapInArrow(read, RECORD).select(*_RECORD.names[3:])


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages as monolithic archives, normalises them and reads them back."""
    spark = pages.sparkSession
    write_monolithic(pages, raw := new_dir(spark, "warc"))
    normalise_archives(spark, raw, path := new_dir(spark, "normalised"))
    return read_archives(spark, path)


def op4_warc(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS f FROM pages),
     h AS (SELECT *, sha1(x) AS d FROM p)
SELECT page_id, CAST(strlen(x) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(d, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM f THEN NULL ELSE f END AS refers_to FROM h
"""
