"""Extraction as an incremental stream of files or rows, with those that wait for their metadata."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.jobs import extract_run
from ..sources.commits import commit, new_folder, versions
from ..sources.tables import listed

KEYS = ["Type", "filename"]


def waiting(spark: SparkSession, out: str, before: int | None = None) -> tuple[DataFrame | None, int]:
    """What has arrived without metadata, as it was before a batch (or now), and the last batch it knows of."""
    kept = [v for v in versions(spark, out, "waiting") if before is None or v["batch"] < before]
    if not kept:
        return None, -1
    return spark.read.parquet(f"{out}/{kept[-1]['folder']}"), kept[-1]["batch"]


def _drive(arrived: DataFrame, metadata: DataFrame, out: str, run: str, batch: int, **options) -> None:
    """Extracts what of arrived has metadata, as a run, and keeps the rest waiting. The run is committed first: if the job
    ends between the two, what is done is found among the extracted filings the next time."""
    spark = arrived.sparkSession
    if "file" in arrived.columns:  # a file that is written again while it waits has arrived twice
        arrived = arrived.dropDuplicates(KEYS)
    folder = new_folder("waiting")
    arrived.join(metadata.select(*KEYS).distinct(), KEYS, "left_anti").write.parquet(f"{out}/{folder}")
    ready = metadata.join(arrived.select(*KEYS).distinct(), KEYS, "left_semi").select(*metadata.columns)
    extract_run(ready, arrived, out, run, **options)
    commit(spark, out, "waiting", {"folder": folder, "batch": batch})


def _extract(source: DataFrame, arrived_of, metadata: DataFrame, out: str, checkpoint: str, **options) -> None:
    spark = source.sparkSession

    def write(batch: DataFrame, n: int) -> None:
        held, _ = waiting(spark, out, before=n)
        arrived = arrived_of(batch)
        _drive(arrived.unionByName(held) if held is not None else arrived, metadata, out, f"batch-{n}", n, **options)

    source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    # a run without new files has no batch, but may have metadata that something waits for
    held, last = waiting(spark, out)
    if held is not None and held.join(metadata.select(*KEYS), KEYS, "left_semi").take(1):
        _drive(held, metadata, out, f"late-{uuid.uuid4().hex}", last, **options)


def extract_new_filings_stream(spark: SparkSession, metadata: DataFrame, raw_dir: str, out: str, checkpoint: str, **options) -> None:
    """Extracts each raw file under raw_dir/<Type>/ once over all runs and returns when what is there is done.

    The checkpoint remembers the files that have arrived. Of a batch the files with metadata are extracted as a run at out,
    with its rejects and counts (plans.jobs.extract_run); the others wait in a table of addresses there, which every
    run of the stream drives again, so it does not matter which comes first, the file or its metadata. Contents are read by
    path where they are cut. A batch that runs again starts from what waited before it and takes its own place.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").load(raw_dir)
    _extract(listed(files), lambda batch: batch, metadata, out, checkpoint, **options)


def extract_new_rows_stream(spark: SparkSession, metadata: DataFrame, raw_dir: str, out: str, checkpoint: str, **options) -> None:
    """The same for raw filings that are kept as Parquet rows (Type, filename, content)."""
    rows = spark.readStream.schema("Type string, filename string, content string").parquet(raw_dir)
    _extract(rows, lambda batch: batch.select(*KEYS, F.col("content")), metadata, out, checkpoint, **options)
