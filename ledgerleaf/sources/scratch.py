"""Folders for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. Where none is set, a folder of this machine
    will do in local mode, as in tests; on a cluster it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one; Spark's file system deletes it when the application ends."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lost executors cost no recomputation before it."""
    spark = df.sparkSession
    df.write.parquet(path := new_dir(spark, name))
    _FOLDERS[out := spark.read.schema(df.schema).parquet(path)] = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes a table that cut has made and that nothing will read again."""
    if path := _FOLDERS.pop(table, None):
        there = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(there, True)
