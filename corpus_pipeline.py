"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

Every stage takes null ids, texts, languages and sources, empty and very long texts, repeated ids and rows, empty tables and
further columns of any name; all but the last return the columns they were given. Rows are told apart by what they hold,
never by their id alone, so no text goes because its id is null or repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.llm.common import new_dir, table
from ledgerleaf.llm.decontamination import decontaminated
from ledgerleaf.llm.language_id import known_language
from ledgerleaf.llm.mixing import mixed
from ledgerleaf.llm.sharding import shuffle_shards
from ledgerleaf.llm.simhash import near_dedup


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents in a language that the classifier has learned from the labels. Null texts, texts without letters
    and texts whose n-grams the landmarks do not know go; without labels, all texts with letters stay. Equal texts are
    judged alike."""
    return known_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of near copies (5-word shingles, similarity 0.8 or more, also by chains) the document with the
    smallest doc_id, null last, then by its content; of wholly equal rows one. Texts without words are copies of each other."""
    return near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents in which no window of a benchmark item occurs. Null and empty texts stay, repeated rows are judged
    alike; items without words are never found."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: each document as often as the mix of sources takes it. A null source is a source; texts without words are
    taken as their hash falls, since they count nothing; of rows that agree in id and text as many are taken as come nearest."""
    return mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: all rows in random order over 24 even shards; adds _shard and _slot (columns of these names give way). Row
    counts differ by one at most, also for few and repeated rows."""
    return shuffle_shards(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix), ("shards", shards)]

#: SQL cannot express kernel regression, SimHash or the shuffle; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(path := new_dir(spark, name))
        docs = spark.read.parquet(path)
    return docs
