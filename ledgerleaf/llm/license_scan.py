"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them."""

from __future__ import annotations

import math

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import BROADCAST_ROWS, cut, table
from .license_texts import TEXTS

SHINGLE, CONTAINED, BANDS = 5, 0.8, 24
#: Shingles of templates that a pass over the documents broadcasts.
PASS_SHINGLES = 2_000_000


def words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles(w: Column) -> Column:
    """Hashes of all runs of SHINGLE words, in order; none for shorter texts."""
    at = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])
    return F.when(F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), at)).otherwise(F.array().cast("array<bigint>"))


def masks() -> list[int]:
    """One random order of all hashes for each band: by their xor with a mask."""
    return [int.from_bytes((0x9E3779B97F4A7C15 * (2 * j + 1) % (1 << 64)).to_bytes(8, "little"), "big", signed=True) for j in range(BANDS)]


def signature(hashes: Column) -> Column:
    """The MinHash of a set of hashes in each band, as the hash that comes first in the band's order."""
    first = lambda m: F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(m)))).bitwiseXOR(F.lit(m))
    return F.array(*map(first, masks()))


def collision(n: int) -> float:
    """Least probability that a window holding a template of n shingles to the degree CONTAINED meets it in a band.

    Windows have n + step - 1 shingles and start at every step-th, step = ceil(n / 4), so one of them holds the place
    whole. Then their similarity is at least 0.8 n / (window + 0.2 n), and each band alone meets with that probability.
    """
    window = n + math.ceil(n / 4) - 1
    return 1 - (1 - CONTAINED * n / (window + (1 - CONTAINED) * n)) ** BANDS


def scan(docs: DataFrame, templates: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, license, containment, windows) of each document and license found in it.

    A template is found where a window of the text holds at least 80 % of its 5-word shingles; containment is the highest
    share, windows the number of windows over all templates of that license. Null and short texts hold nothing; templates
    of fewer than five words are passed over; a document counts once per row, so repeated rows give repeated findings.
    Texts of any length are read whole. Other columns are not read.

    The bands of all templates are a table by their MinHash. As the MinHash of a window is one of its shingles, the
    documents' shingles are joined with that table; of the windows around a hit, those whose MinHash in that band it is
    have met the template and are held against its shingles. All of this is row by row: bands and templates are
    broadcast in passes of bounded size, and only findings are shuffled.
    """
    known = templates.select("license", words(F.col("text")).alias("w")).select("license", F.array_distinct(shingles(F.col("w"))).alias("s")).where(F.size("s") > 0).distinct()
    known = cut(known.select("license", "s", F.size("s").alias("n"), signature(F.col("s")).alias("b"), F.monotonically_increasing_id().alias("t")), "templates")
    count, total = known.agg(F.count("*"), F.sum("n")).first()
    passes = max(1, -(-count * BANDS // BROADCAST_ROWS), -(-(total or 0) // PASS_SHINGLES))
    # the row number also keeps Spark from cutting the words anew for each shingle
    rows = docs.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_row"), words(F.col(text)).alias("_words")).select("_key", "_row", shingles(F.col("_words")).alias("_s"))
    # the outer form: else Spark infers a filter that makes all shingles once more
    exploded = rows.select("_key", "_row", "_s", F.posexplode_outer("_s").alias("_pos", "_h"))
    step = F.ceil(F.col("n") / 4).cast("int")
    masked = lambda h: h.bitwiseXOR(F.array(*map(F.lit, masks()))[F.col("j")])

    def found(k: int) -> DataFrame:
        part = known.where(F.pmod(F.xxhash64("t"), F.lit(passes)) == k)
        bands = part.select("t", "n", F.posexplode("b").alias("j", "h"))
        hits = exploded.join(F.broadcast(bands), F.col("_h") == F.col("h")).withColumn("step", step).withColumn("wide", F.col("n") + F.col("step") - 1)
        first = F.ceil(F.greatest(F.lit(0), F.col("_pos") - F.col("wide") + 1) / F.col("step")).cast("int") * F.col("step")
        hits = hits.where(first <= F.col("_pos")).withColumn("_at", F.explode(F.sequence(first, F.col("_pos"), F.col("step"))))
        hits = hits.select("_key", "_row", "_at", "t", "n", "j", "h", F.slice("_s", F.col("_at") + 1, F.col("wide")).alias("_w"))
        met = hits.where(F.array_min(F.transform("_w", masked)) == masked(F.col("h")))
        held = met.join(F.broadcast(part.select("t", "license", "s")), "t").select("_key", "_row", "license", "t", "_at", (F.size(F.array_intersect("_w", "s")) / F.col("n")).alias("share"))
        return held.where(F.col("share") >= CONTAINED).groupBy("_row", "_key", "license", "t", "_at").agg(F.max("share").alias("share"))

    windows = reduce(DataFrame.union, map(found, range(passes)))
    return windows.groupBy("_row", "_key", "license").agg(F.max("share").alias("containment"), F.count("*").alias("windows")).select(F.col("_key").alias(key), "license", "containment", "windows")


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEXTS, "license string, text string")


def templates_of(spark: SparkSession, folder: str) -> DataFrame:
    """(license, text) of a folder of license texts, a file each, called by their names: full texts of any length."""
    return spark.read.text(folder, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("license"), F.col("value").alias("text"))


def op9_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), notices(spark))


def _sql() -> str:
    """The same by joining all shingles of the windows: the bands' probability of missing a window is under 1e-5."""
    rows = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in TEXTS)
    return rf"""
WITH t AS (SELECT row_number() OVER () AS t, l, regexp_extract_all(lower(x), '[\p{{L}}\p{{N}}]+') AS w FROM (VALUES {rows}) v(l, x)),
     ts AS (SELECT DISTINCT t, l, array_to_string(w[p : p + 4], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 3)) AS p FROM t WHERE len(w) >= 5)),
     n AS (SELECT t, count(*) AS n, CAST(ceil(count(*) / 4.0) AS BIGINT) AS step FROM ts GROUP BY t),
     d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
     ds AS (SELECT r, doc_id, p - 1 AS p, array_to_string(w[p : p + 4], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
     h AS (SELECT ds.r, ds.doc_id, ds.p, ds.s, ts.t, ts.l, n.n, n.step FROM ds JOIN ts USING (s) JOIN n USING (t)),
     w AS (SELECT *, unnest(range(step * greatest(0, CAST(ceil((p - (n + step - 1) + 1) / CAST(step AS DOUBLE)) AS BIGINT)), p + 1, step)) AS a FROM h),
     c AS (SELECT r, doc_id, t, l, a, count(DISTINCT s) / CAST(any_value(n) AS DOUBLE) AS share FROM w GROUP BY ALL)
SELECT doc_id, l AS license, max(share) AS containment, count(*) AS windows FROM c WHERE share >= 0.8 GROUP BY r, doc_id, l
"""


SQL = _sql()
