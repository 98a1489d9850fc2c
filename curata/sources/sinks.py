"""Sinks and materialisation.

Result tables are written as Parquet.  ``checkpoint_table`` cuts lineage in
the shared folder named by ``spark.checkpoint.dir`` (reliable checkpoint,
survives the loss of an executor); ``persist`` keeps a table for reuse and
falls back to recomputation from lineage when a block is lost.  What is
persisted stays as objects: a serialised block is read back whole by each task
that reads it, beside what Spark's memory manager counts.
"""

from __future__ import annotations

import math
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from curata.session import checkpoint_dir


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def persist(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK_DESER)


def checkpoint_table(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def in_parts(df: DataFrame, rows_per_part: int) -> DataFrame:
    """``df`` in as many partitions at least as its rows need at ``rows_per_part`` each.

    Partitions of files follow from bytes and cores: a compact table has few, however many rows it holds.  If it has too few,
    rows are dealt out by the hash of all columns, so that a recomputed partition has the same rows; they should differ.
    """
    parts = math.ceil(df.count() / rows_per_part)
    return df if parts <= df.rdd.getNumPartitions() else df.repartition(parts, *df.columns)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new Parquet folder in the checkpoint folder and read back: columns can be
    picked, nothing stays in the executors, and a lost executor costs nothing."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class BucketedTable:
    """Rows written in buckets of a key (S3): joins and groupings by the key need no shuffle.

    The table lies in the checkpoint folder under a catalogue name of its own and outlives the
    executors; ``release`` drops its name and its files.  Tables that are joined must have the same
    number of buckets.
    """

    def __init__(self, df: DataFrame, key: str | list[str], buckets: int, name: str = "bucketed"):
        self.spark: SparkSession = df.sparkSession
        self.table = f"{name}_{uuid.uuid4().hex}"
        self.path = f"{checkpoint_dir(self.spark).rstrip('/')}/{self.table}"
        keys = [key] if isinstance(key, str) else list(key)
        # one task holds whole buckets, so a bucket is few files
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", self.path).format("parquet").saveAsTable(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def release(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
