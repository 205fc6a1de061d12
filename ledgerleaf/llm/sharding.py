"""Shards by a two-pass external shuffle: scatter into memory-sized buckets, then Fisher-Yates in each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .common import cut, join_small, new_dir, prefix_sums, table

ATOMIC = (T.StringType, T.BinaryType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)


def _fisher_yates(n: int, seed: int) -> np.ndarray:
    order = np.arange(n)
    np.random.Generator(np.random.PCG64(seed)).shuffle(order)
    return order


def _spread(flat: DataFrame, hot: DataFrame, names: list[str], n_buckets: int, block: int = 1024) -> DataFrame:
    """flat with the wholly equal rows of the hashes in hot counted, and dealt to the buckets by hash and copy number."""
    hot_rows = join_small(flat, hot, ["_hash"], "left_semi").groupBy(*names, "_hash").agg(F.count("*").alias("_n"))
    blocks = hot_rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / block)))).repartition(F.col("_hash"), F.col("_block"))
    first = F.col("_block") * block
    copies = blocks.withColumn("_copy", F.explode(F.sequence(first, F.least(first + block, "_n") - 1)))
    bucket = F.pmod(F.xxhash64("_hash", "_copy"), F.lit(n_buckets)).alias("_bucket")
    return join_small(flat, hot, ["_hash"], "left_anti").select(flat.columns).union(copies.select(*names, "_hash", bucket))


def shuffle_shards(docs: DataFrame, n_shards: int = 24, text: str = "text", seed: int = 7, bucket_bytes: int = 16 << 20) -> DataFrame:
    """All rows and columns of docs with _shard and _slot; row counts of the shards are at most one apart.

    Pass 1 scatters the rows by a seeded hash of all plain columns into as many buckets as their bytes need, pass 2
    shuffles each bucket by Fisher-Yates. The buckets one after the other are a random order of all rows; shard k is its
    k-th even part, and the slots of a shard count from 0. The result depends on rows, shard count, seed and bucket
    bytes alone, so a task that runs again gives the same rows. Rows that agree in all plain columns share a bucket, unless they fill a
    quarter of one: these are counted, and each copy is dealt by its number (not with map or variant columns, which
    Spark cannot group by). Null texts count as empty; an empty table gives no rows. Columns of docs with the names
    _shard and _slot give way to the added ones; all others keep their names and values.
    """
    docs = docs.drop("_shard", "_slot")
    plain = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, ATOMIC)]
    hashed = F.xxhash64(F.lit(seed), *plain)
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8
    total = docs.agg(F.sum(size.cast("long"))).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(hashed), F.lit(n_buckets)).alias("_bucket")
    names = docs.columns
    flat = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], hashed.alias("_hash"), bucket)
    if n_buckets > 1 and not any(x in docs.schema.simpleString() for x in ("map<", ":variant", "<variant")):
        sizes = docs.select(hashed.alias("_hash"), size.cast("long").alias("_size")).groupBy("_hash").agg(F.sum("_size").alias("_size"), F.count("*").alias("_n"))
        hot = cut(sizes.where((F.col("_n") > 1) & (F.col("_size") > bucket_bytes // 4)).select("_hash"), "hot")
        if hot.take(1):
            flat = _spread(flat, hot, [f"c{i}" for i in range(len(names))], n_buckets)
    counts = cut(prefix_sums(flat.groupBy("_bucket").agg(F.count("*").alias("_n")), "_bucket", "_n", "_first"), "buckets")
    n = counts.agg(F.sum("_n")).first()[0] or 0
    q, r = divmod(n, n_shards)

    def shuffled(t: pa.Table) -> pa.Table:
        first, at = t["_first"][0].as_py(), t["_bucket"][0].as_py()
        plain_names = [f"c{i}" for i, f in enumerate(t.schema.names[: len(names)]) if not pa.types.is_nested(t.schema.field(i).type)]
        t = t.take(pc.sort_indices(t.select([*plain_names, "_hash"]), sort_keys=[("_hash", "ascending"), *((c, "ascending") for c in plain_names if c != text_at)]))
        t = t.take(pa.array(_fisher_yates(len(t), (seed << 32) ^ at)))
        g = first + np.arange(len(t))
        long, part = r * (q + 1), np.empty(len(t), np.int64)
        head = g < long
        part[head] = g[head] // (q + 1)
        part[~head] = r + (g[~head] - long) // max(q, 1)
        start = np.where(part < r, part * (q + 1), long + (part - r) * q)
        kept = t.select([f"c{i}" for i in range(len(names))])
        return kept.append_column("_shard", pa.array(part.astype(np.int32))).append_column("_slot", pa.array(g - start))

    text_at = f"c{names.index(text)}"
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)]
    schema = T.StructType([*fields, T.StructField("_shard", T.IntegerType()), T.StructField("_slot", T.LongType())])
    # the join and the grouping share one exchange by bucket: each text moves once
    placed = flat.join(counts.select("_bucket", "_first").hint("shuffle_merge"), "_bucket").select(*flat.columns, "_first")
    return placed.groupBy("_bucket").applyInArrow(shuffled, schema).toDF(*names, "_shard", "_slot")


def write_shards(docs: DataFrame, path: str, **kw) -> DataFrame:
    """Writes the shards as Parquet folders _shard=k and reads them again. Each task writes the buckets it has shuffled, a file
    for each shard that they reach, in slot order: no row moves again, and no task holds a shard."""
    rows = shuffle_shards(docs, **kw)
    rows.sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def op2_sharding(spark, sf_dir):
    rows = write_shards(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), new_dir(spark, "shards"))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return rows.select("doc_id", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.lit("rows").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
