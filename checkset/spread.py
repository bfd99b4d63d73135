"""Using all cores on an input that comes in few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out anew if the scan has fewer partitions than there are cores.

    For a small file ahead of costly per-row work. A large input has far more
    partitions than the cluster has cores and is returned untouched, so this
    never shuffles one.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
