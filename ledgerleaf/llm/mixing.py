"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import WORD, cut, join_small, table
from .sharding import ATOMIC

#: A document's place in its source is a hash of 60 bits, refined by these numbers of bits a level.
BITS = 60
LEVELS = (12, 16, 16, 16)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], limit: int) -> DataFrame:
    """From one row per source (source, source_size): adds target. Sources by code point, null last, take the weights
    in turn and share the sum of all sizes; none gets more than limit times its size, the excess is shared anew.

    Sources in order of size / weight: those whose limit is below their share of what the smaller ones leave are at
    their limit, the others share the rest. All sums are whole numbers. The windows run over sources, not documents.
    """
    least = 1
    for w in weights:
        least *= w
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    big = lambda c: c.cast("decimal(38,0)")
    order = W.orderBy(F.col("source_size") * (F.lit(least) / F.col("w")).cast("long"), F.col("source").asc_nulls_last())
    rows = sizes.withColumn("w", F.array(*map(F.lit, weights))[turn].cast("long")).withColumn("cap", F.col("source_size") * limit)
    rows = rows.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("rest", F.sum("w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))).withColumn("all", F.sum("source_size").over(W.partitionBy()))
    rows = rows.withColumn("full", big(F.col("cap")) * big(F.col("rest")) < big(F.col("all") - F.col("before")) * big(F.col("w")))
    over = W.partitionBy()
    left = F.col("all") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(over), F.lit(0))
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(over)
    return rows.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise((F.col("w") * left).cast("double") / open_w.cast("double"))).select("source", "source_size", "target")


def mix_sources(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = (5, 2, 1), limit: int = 3, seed: str = "mix") -> DataFrame:
    """Every input row (struct _in, so no name can clash) with _size, _source_size, _target, _taken and _copies (whole repeats of the row that the mix takes).

    A document's size is its number of words. Every document of a source is taken floor(target / source size) times;
    one more copy goes to those whose hash lies below the source's threshold. Words are summed by source and hash
    bucket; the bucket in which the remaining budget ends is split anew by more bits of the hash, the others are done.
    The document at the threshold is taken if that comes nearer to the target. The hash is of key and text; of rows that
    agree in both as many are taken as come nearest, so null keys and repeated ones are dealt like any other. Null and
    empty texts have no words; a null source is a source; an empty table gives no rows. Nothing is sorted but the sources
    and the (at most 65536) buckets of one source.
    """
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    hashed = F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    marked = docs.select(F.struct("*").alias("_in"), size.alias("_size"), hashed.alias("_hash"), F.struct(F.col(source).isNull().alias("n"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("s")).alias("_source"))
    rows = cut(marked.select(F.col("_source").alias("g"), F.col("_hash").alias("h"), F.col("_size").alias("n")).groupBy("g", "h").agg(F.sum("n").alias("n"), F.count("*").alias("c")), "sizes")
    sizes = rows.groupBy("g").agg(F.sum("n").alias("source_size")).select(F.when(~F.col("g.n"), F.col("g.s")).alias("source"), "source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = source_targets(sizes, weights, limit).withColumn("base", whole).withColumn("left", F.col("target") - F.col("base") * F.col("source_size"))
    budget = cut(budget.select(F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s")).alias("g"), "source_size", "target", "base", "left"), "budget")

    done, rest, low, shift = budget.select("g", "left", F.lit(0).cast("long").alias("low")), rows, None, BITS
    for level, bits in enumerate(LEVELS):
        shift -= bits
        bucket = F.shiftrightunsigned(F.col("h"), shift)
        if level:
            rest = cut(join_small(rest, done.select("g", "low"), ["g"]).where(F.shiftrightunsigned("h", shift + bits) == F.shiftrightunsigned("low", shift + bits)).drop("low"), "boundary")
        sums = rest.groupBy("g", bucket.alias("b")).agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
        upto = F.sum("n").over(W.partitionBy("g").orderBy("b"))
        sums = join_small(sums.withColumn("upto", upto), done.select("g", "left"), ["g"]).where(F.col("upto") > F.col("left"))
        edge = sums.groupBy("g").agg(F.min(F.struct("b", "upto", "n", "c")).alias("e"))
        done = cut(
            done.join(edge, "g", "left").select(
                "g",
                F.when(F.col("e").isNotNull(), F.col("left") - (F.col("e.upto") - F.col("e.n"))).otherwise(F.col("left")).alias("left"),
                F.when(F.col("e").isNotNull(), F.shiftleft(F.col("e.b"), shift)).otherwise(F.lit(1 << BITS)).alias("low"),
                F.coalesce(F.col("e.n") / F.col("e.c"), F.lit(1.0)).alias("edge"),
                F.coalesce("e.c", F.lit(0)).alias("c"),
            ),
            "threshold",
        )
    # all 60 bits are used, so the last bucket is one hash: c rows of one size
    some = F.floor(F.col("left") / F.col("edge"))
    some = some + (F.col("edge") - (F.col("left") - some * F.col("edge")) < F.col("left") - some * F.col("edge")).cast("long")
    done = done.select("g", "low", "c", F.when(F.col("c") > 0, F.least(some, "c")).otherwise(0).cast("long").alias("some"))
    all_, none = (F.col("some") == F.col("c")) & (F.col("c") > 0), F.col("some") == 0
    done = done.select("g", (F.col("low") + all_.cast("long")).alias("below"), F.when(~all_ & ~none, F.col("low")).alias("split"), "some")
    cuts = cut(budget.drop("left").join(done, "g").withColumnRenamed("g", "_source"), "cuts")
    facts = cuts.select("_source", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("base").alias("_base"), F.col("below").alias("_below"), F.col("split").alias("_split"), F.col("some").alias("_some"))
    out = join_small(marked, facts, ["_source"]).withColumn("_copies", F.col("_base") + (F.col("_hash") < F.col("_below")).cast("long"))
    if cuts.where("split is not null").take(1):
        out = _split(out)
    out = out.withColumn("_taken", F.col("_size") * F.col("_copies"))
    return out.select("_in", "_size", "_source_size", "_target", "_taken", "_copies")


def _split(out: DataFrame) -> DataFrame:
    """out, with one more copy for the first _some of the rows whose hash is _split. These are written and numbered in an
    order of what they hold, wholly equal ones as they come, so reruns agree: the counts of 4096 parts of a hash of all plain
    columns, in these of its values and of the tasks that hold them, and in a task the rows. No task numbers all of them."""
    plain = [F.col("_in")[f.name] for f in out.schema["_in"].dataType if isinstance(f.dataType, ATOMIC)]
    at_edge = F.coalesce(F.col("_hash") == F.col("_split"), F.lit(False))
    told = out.where(at_edge).withColumn("_p", F.xxhash64(F.lit("edge"), *plain)).withColumn("_part", F.spark_partition_id())
    edge = cut(told.withColumn("_b", F.shiftrightunsigned("_p", 52)).withColumn("_row", F.monotonically_increasing_id()), "edge")
    held = ["_source", "_b", "_p", "_part"]
    parts = cut(edge.groupBy(*held).agg(F.count("*").alias("_n")), "parts")
    before = lambda order: F.coalesce(F.sum("_n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = parts.groupBy("_source", "_b").agg(F.sum("_n").alias("_n")).withColumn("_upto", before(W.partitionBy("_source").orderBy("_b"))).drop("_n")
    parts = parts.withColumn("_inside", before(W.partitionBy("_source", "_b").orderBy("_p", "_part"))).join(cut(blocks, "blocks"), ["_source", "_b"])
    parts = cut(parts.select(*held, (F.col("_inside") + F.col("_upto")).alias("_before")), "places")
    place = F.row_number().over(W.partitionBy(*held).orderBy("_row"))
    placed = join_small(edge.select(*held, "_row", "_some").withColumn("_place", place), parts, held)
    more = cut(placed.where(F.col("_before") + F.col("_place") <= F.col("_some")).select("_row"), "more")
    numbered = edge.join(more.withColumn("_one", F.lit(1)), "_row", "left").withColumn("_copies", F.col("_copies") + F.coalesce("_one", F.lit(0)))
    return out.where(~at_edge).union(numbered.select(out.columns))


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: the columns of docs, each row as often as the mix takes it (see mix_sources for nulls, repeated rows
    and empty tables). Columns of any name stay as they are."""
    rows = mix_sources(docs, **kw).where("_copies > 0")
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_in.*")


def op5_mixing(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents")).select("_in.doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
     s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
     w AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS HUGEINT) AS w FROM s),
     c AS (SELECT *, 3 * CAST(source_size AS HUGEINT) AS cap, coalesce(sum(3 * CAST(source_size AS HUGEINT)) OVER o, 0) - 3 * CAST(source_size AS HUGEINT) AS before,
                  sum(w) OVER () - sum(w) OVER o + w AS rest, sum(CAST(source_size AS HUGEINT)) OVER () AS total
           FROM w WINDOW o AS (ORDER BY source_size * (10 // w), source NULLS LAST ROWS UNBOUNDED PRECEDING)),
     f AS (SELECT *, cap * rest < (total - before) * w AS is_full FROM c),
     t AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE CAST(w * (total - coalesce(sum(cap) FILTER (WHERE is_full) OVER (), 0)) AS DOUBLE) / CAST(sum(w) FILTER (WHERE NOT is_full) OVER () AS DOUBLE) END AS target FROM f),
     b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM t),
     u AS (SELECT d.*, b.source_size, b.target, b.base, b.target - b.base * b.source_size AS lft,
                  sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS UNBOUNDED PRECEDING) AS upto, size AS same
           FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (base + CASE WHEN upto <= lft OR (upto - same <= lft AND upto - lft < lft - (upto - same)) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM u
"""
