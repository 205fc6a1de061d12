"""Exact dedup by content-defined chunk recipes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import cut, table

SPACE = " \t\n\x0b\x0c\r"


def _class(mod: int, rest: int) -> str:
    """ASCII letters and digits with a code of this remainder."""
    return "[" + "".join(c for c in map(chr, range(0x30, 0x7B)) if c.isalnum() and ord(c) % mod == rest) + "]"


#: A chunk ends after three characters of these classes, from 256 characters on; without such an end after 4096.
CHUNK = rf"(?s).{{253,4093}}?{_class(4, 1)}{_class(4, 0)}{_class(8, 3)}|.{{1,4096}}"


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in SPACE:
        out = F.replace(out, F.lit(c))
    return out


def chunked(docs: DataFrame, text: str, bits: int) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Each document with its normalised text and chunks, and how a chunk is hashed."""
    rows = docs.withColumn("_norm", normalised(F.col(text))).withColumn("_chunks", F.regexp_extract_all("_norm", F.lit(CHUNK), F.lit(0)))
    name = lambda c: F.xxhash64(c).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))
    return rows, name


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", hash_bits: int = 64) -> DataFrame:
    """One row per document: key, keep (key of the row that stays), group_size, kept, text_sha256.

    Texts are equal if they agree without spaces, tabs and line ends. Of equal ones the row with most code points
    stays, then the smallest key; null keys come last, and of wholly equal rows just one stays. Null text is empty;
    all empty texts are one group. Other columns are not looked at, so their names may clash with nothing here.

    Every text is cut into chunks whose ends depend on the characters there. Distinct chunks move once, by hash and
    text; a hash with two texts gives each a name of its own, so equal names mean equal chunks. Documents are then
    compared by the ordered list of chunk names, and no text moves again. hash_bits is lowered only in tests.
    """
    rows, name = chunked(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", hash_bits)
    facts = [F.monotonically_increasing_id().alias("_row"), "_key", F.length(F.coalesce("_text", F.lit(""))).alias("_points"), F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha")]
    recipes = cut(rows.select(*facts, F.transform("_chunks", name).alias("_recipe")), "recipes")
    # the outer form: else Spark infers a filter that cuts every text once more
    chunks = rows.select(F.explode_outer("_chunks").alias("_c")).where("_c IS NOT NULL").select(name(F.col("_c")).alias("_h"), "_c").distinct()
    clash = cut(chunks.groupBy("_h").count().where("count > 1").select("_h"), "clash")
    if clash.take(1):
        ranks = chunks.join(clash, "_h", "left_semi").withColumn("_k", F.row_number().over(W.partitionBy("_h").orderBy("_c")))
        parts = rows.select(*facts, "_chunks").select("_row", "_key", "_points", "_sha", F.posexplode_outer("_chunks").alias("_pos", "_c")).withColumn("_h", name(F.col("_c"))).join(ranks, ["_h", "_c"], "left")
        recipes = cut(
            parts.groupBy("_row", "_key", "_points", "_sha")
            .agg(F.array_sort(F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_h", F.coalesce("_k", F.lit(0)).alias("_k"))))).alias("_recipe")),
            "recipes",
        )
    best = F.min(F.struct((-F.col("_points")).alias("p"), F.col("_key").isNull().alias("n"), F.col("_key").alias("key"), F.col("_row").alias("row")))
    # written, so that the join has an exchange of its own on either side and Spark can split the recipe of a large group
    groups = cut(recipes.groupBy("_recipe").agg(best.alias("_best"), F.count("*").alias("_size")), "groups")
    return recipes.join(groups, "_recipe").select(
        F.col("_key").alias(key), F.col("_best.key").alias("keep"), F.col("_size").alias("group_size"), (F.col("_row") == F.col("_best.row")).alias("kept"), F.col("_sha").alias("text_sha256")
    )


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("keep", "keep_id")


SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS x FROM documents),
     g AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY n DESC, doc_id) AS r, count(*) OVER (PARTITION BY x) AS c FROM t)
SELECT g.doc_id, b.doc_id AS keep_id, g.c AS group_size, g.r = 1 AS kept, sha256(g.x) AS text_sha256
FROM g JOIN (SELECT x, doc_id FROM g WHERE r = 1) b ON g.x = b.x
"""
