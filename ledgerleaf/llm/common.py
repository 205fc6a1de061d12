"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.scratch import cut, discard, new_dir

#: Whitespace that separates words wherever a contract says `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that may be broadcast; every caller counts first and has a shuffled path beyond it.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Joins with right broadcast if it has few rows (it is counted, so it should be cut before), else shuffled."""
    return left.join(F.broadcast(right) if right.limit(rows + 1).count() <= rows else right, on, how)


def crc_mod(col: Column, n: int) -> Column:
    """crc32(col as text) mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def with_results(docs: DataFrame, text: str, keep: list[str] | None, added: str, found: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """The columns `keep` of docs (all, if None) and those that found makes of each batch of texts; added: their schema.

    A column of docs with the name of an added one, in any case, gives way to it. Names of docs never meet those used here. The text
    goes to the tasks once, also where it is kept. No row moves.
    """
    new = T._parse_datatype_string(added)
    given_way = {c.lower() for c in new.names}
    names = [c for c in docs.columns if (keep is None or c in keep) and c.lower() not in given_way]
    at = names.index(text) if text in names else len(names)
    schema = T.StructType([*[T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(names)], *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *found(b.column(at))], names=schema.names)

    given = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], *[F.col(text).alias("_text")] * (at == len(names)))
    return given.mapInArrow(run, schema).toDF(*names, *new.names)


def rows_where(docs: DataFrame, text: str, added: str, found: Callable[[pa.Array], list[pa.Array]], keep: Column) -> DataFrame:
    """The rows of docs, with its columns alone, for which `keep` holds on the columns that found makes."""
    plain = docs.toDF(*[f"in{i}" for i in range(len(docs.columns))])
    rows = with_results(plain, f"in{docs.columns.index(text)}", None, added, found).where(keep)
    return rows.select(plain.columns).toDF(*docs.columns)


def prefix_sums(counts: DataFrame, key: str, n: str, out: str, block: int = 4096) -> DataFrame:
    """Adds out, the sum of n over all smaller keys. Blocks of keys are summed first, so no window has more than
    `block` rows but the one over the blocks."""
    from pyspark.sql import Window as W

    rows = counts.withColumn("_b", F.floor(F.col(key) / block))
    inside = F.sum(n).over(W.partitionBy("_b").orderBy(key).rowsBetween(W.unboundedPreceding, -1))
    before = F.sum("_s").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    blocks = rows.groupBy("_b").agg(F.sum(n).alias("_s")).select("_b", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.withColumn("_in", F.coalesce(inside, F.lit(0))).join(blocks, "_b").withColumn(out, F.col("_in") + F.col("_before")).drop("_b", "_in", "_before")
