"""A small table with all that is awkward."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 4001}" for i in range(40_000))
ROWS = [
    (1, "The cat sat on the mat and the dog lay on the rug near the old red door.", "en", "a"),
    (2, "The cat sat on the mat and the dog lay on the rug near the old red door.", "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\n", "en", None),
    (6, "12345 !!! 678", "en", "a"),
    (7, LONG, "en", "a"),
    (8, LONG + " end", "en", "c"),
    (9, "Der Hund und die Katze schlafen unter dem alten Baum im Garten.", "de", "b"),
    (10, "Ünïcödé “quoted” text — mit ß und 漢字 und \U0001f600 emoji", None, "b"),
    (11, "x", "en", "a"),
    (11, "x", "en", "a"),
    (None, "The cat sat on the mat and the dog lay on the rug near the old red door.", "en", "a"),
    (None, None, None, None),
]
CLASHES = ["key", "fp", "_row", "_key", "block", "bucket", "n_words", "score", "_in", "_size", "_hash", "_bucket", "c0", "h", "g", "count", "_text", "_shard", "_slot", "_kept", "_in", "_source", "known", "hits", "many", "_k", "_t"]
SCHEMA = "doc_id long, text string, lang string, source string"


def awkward(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.withColumns({c: F.lit(7) for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
