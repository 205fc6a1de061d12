"""The helper's steps over Arrow batches."""

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from ledgerleaf.functions import batches as B


def test_a_batch_is_worked_on_in_steps_of_bytes():
    rows = [("x" * 40_000) + str(i) for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows), pa.array(range(500))], names=["t", "i"])
    found = list(B.steps(iter([batch, batch.slice(0, 0), batch.slice(0, 3)]), [0]))
    assert max(b.column(0).nbytes for b in found) <= 2 * B.STEP_BYTES and len(found) > 15
    assert [x for b in found for x in b.column(0).to_pylist()] == rows + rows[:3]
    assert len(list(B.steps(iter([batch]), [1]))) == 1


def test_texts_beyond_a_step_and_nulls_stay_whole(spark):
    rows = spark.range(40, numPartitions=1).select("id", F.when(F.col("id") % 7 > 0, F.repeat(F.lit("ab"), (F.col("id") * 40_000).cast("int"))).alias("t"))
    got = B.with_helper(rows, "n", T.LongType(), lambda t: None if t is None else len(t), "t").select("id", "n").collect()
    assert {r["id"]: r["n"] for r in got} == {i: i * 80_000 if i % 7 else None for i in range(40)}
