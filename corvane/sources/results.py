"""A folder of named result tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """`df` kept by the executors while the block runs, and given up after it.

    For a table that several results of one block read and store. What a lost
    executor held is computed anew; a table that costs more than storing it
    belongs in a `ResultStore`.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


class ResultStore:
    """Named Parquet tables below one root; writing a name again replaces it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Store `df` and return the stored table, which no longer depends on `df`'s inputs."""
        writer = df.write.mode("overwrite")
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(name))
        return self.spark.read.schema(_with_partition_last(df, partition_by)).parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def _with_partition_last(df: DataFrame, partition_by: str | None):
    if partition_by is None:
        return df.schema
    order = [c for c in df.columns if c != partition_by] + [partition_by]
    return df.select(*order).schema
