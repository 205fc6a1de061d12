"""Running a vectorised helper over one or more text columns of a DataFrame, beside all its other columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

#: What a helper works on at a time: rows with inputs of about so many bytes.
STEP_BYTES = 1 << 20


def steps(batches: Iterator[pa.RecordBatch], inputs: list[int]) -> Iterator[pa.RecordBatch]:
    """Batches in slices whose inputs have about STEP_BYTES, a row at least, so that Python objects of no more are held at once,
    however many rows Spark puts into a batch."""
    for b in batches:
        size = sum(b.column(i).nbytes for i in inputs)
        n = max(1, b.num_rows * STEP_BYTES // max(size, STEP_BYTES))
        for at in range(0, b.num_rows, n):
            yield b.slice(at, n)


def caught(kind: T.DataType, helper: Callable[..., object]) -> tuple[T.StructType, Callable[..., object]]:
    """The helper with an error channel: (value, error), of which one is null. A value that makes it raise ends no job."""

    def run(*row: object) -> dict:
        try:
            return {"value": helper(*row), "error": None}
        except Exception as e:  # whatever a value does to the helper is that value's result
            return {"value": None, "error": f"{type(e).__name__}: {e}"[:300]}

    return T.StructType([T.StructField("value", kind), T.StructField("error", T.StringType())]), run


def with_helper(df: DataFrame, name: str, kind: T.DataType, helper: Callable[..., object], *inputs: str, without: tuple[str, ...] = ()) -> DataFrame:
    """df with the column name = helper(*inputs), value by value over Arrow batches; one Python boundary, no shuffle. Columns of
    `without` are inputs alone and not handed back."""
    kept = [c for c in df.columns if c != name and c not in without]
    more = [c for c in inputs if c not in kept]
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in kept], T.StructField(name, kind)])
    places = [kept.index(c) if c in kept else len(kept) + more.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, places):
            made = pa.array([helper(*row) for row in zip(*(b.column(i).to_pylist() for i in places), strict=True)], to_arrow_type(kind))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], made], names=schema.names)

    # an input that is kept goes to the task once
    given = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(more)])
    return given.mapInArrow(run, schema)
