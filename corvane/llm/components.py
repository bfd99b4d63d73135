"""Connected components by minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.session import shared_folder


def smallest_label(edges: DataFrame, node: str = "node") -> DataFrame:
    """node, label: for every node of `edges` (columns a, b), the smallest node within reach.

    Each round links every node's neighbours, and itself, to the smallest of
    them (a star operation), alternating between larger and smaller neighbours,
    until nothing changes; the number of rounds grows with the logarithm of the
    longest path. Rounds are written to the shared folder, so a lost executor
    costs no earlier round.
    """
    spark = edges.sparkSession
    folder = shared_folder(spark, "components")

    def kept(df: DataFrame, step: int) -> DataFrame:
        df.write.parquet(f"{folder}/{step}")
        return spark.read.parquet(f"{folder}/{step}")

    def fingerprint(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    # Edges point from the larger node a to the smaller node b.
    links = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), 0)
    step, before = 0, None
    while before != (now := fingerprint(links)):
        before = now
        step += 1
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        links = kept(small.where("a <> b").distinct(), step)
    return links.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias(node), "label").unionByName(
        links.select(F.col("b").alias(node), F.col("b").alias("label")).distinct()
    )
