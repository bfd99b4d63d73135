"""Dealing documents out to shards: longest processing time first.

Documents of equal text form a group and stay together. Sorted by size, each
group goes to the least-loaded shard, found through a heap. A corpus has far
more groups than a driver can hold, so only *items* are scheduled there: every
group above 1/64 of a shard is an item of its own (there can be at most 64 per
shard of those), and all smaller groups are first gathered by the hash of their
text into a fixed number of bundles, 256 per shard. The schedule thus has a
fixed bound (320 items a shard) whatever the input, and as the last item placed
is a small one, loads end up within about one bundle of each other unless one
group alone exceeds a shard.

Slots number a shard's documents from 0 without gaps. They are counted within
fine buckets of each shard, whose offsets come from the buckets' counts, so no
task holds a shard.

Defined results: a null text counts as empty, for its size (`overhead` bytes)
as for its group; rows with a null or repeated id are documents like any other;
equal sizes are scheduled in the order of their keys, so the shards do not
depend on the order of the rows. Documents of equal id within a bucket get
their slots in the order of their text's checksum.
"""

from __future__ import annotations

from heapq import heapify, heapreplace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corvane.llm.tables import narrow

HEAVY_PER_SHARD = 64
BUNDLES_PER_SHARD = 256
SLOT_BUCKETS = 512

_ASSIGNMENT = T.StructType([T.StructField("item", T.StringType()), T.StructField("shard", T.IntegerType())])


def longest_first(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Items (name, size) to shards: by falling size, each to the least-loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    heapify(heap)
    placed = {}
    for name, size in sorted(items, key=lambda item: (-item[1], item[0])):
        load, shard = heap[0]
        placed[name] = shard
        heapreplace(heap, (load + size, shard))
    return placed


def sized_documents(docs: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    """doc_id, size, crc, group key (null and empty texts share one) and bundle number's source."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return narrow(docs, doc_id=id_col, text=text_col).select(
        "doc_id",
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text.cast("binary"), 256).alias("group_key"),
    )


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document."""
    spark = docs.sparkSession
    sized = sized_documents(docs, id_col, text_col, overhead).withColumn(
        "bundle", F.concat(F.lit("bundle-"), F.pmod(F.xxhash64("group_key"), F.lit(shards * BUNDLES_PER_SHARD)).cast("string"))
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    heavy_size = total // (shards * HEAVY_PER_SHARD) + 1
    groups = sized.groupBy("group_key", "bundle").agg(F.sum("size").alias("size"))
    items = (
        groups.withColumn("item", F.when(F.col("size") >= heavy_size, F.col("group_key")).otherwise(F.col("bundle")))
        .groupBy("item")
        .agg(F.sum("size").alias("size"))
    )
    # At most HEAVY_PER_SHARD + BUNDLES_PER_SHARD rows for each shard.
    placed = longest_first([(row.item, row.size) for row in items.collect()], shards)
    assignment = spark.createDataFrame(list(placed.items()), _ASSIGNMENT)
    heavy = assignment.where(~F.col("item").startswith("bundle-")).select(
        F.col("item").alias("group_key"), F.col("shard").alias("own_shard")
    )
    bundles = assignment.where(F.col("item").startswith("bundle-")).select(F.col("item").alias("bundle"), F.col("shard").alias("bundle_shard"))
    placed_docs = (
        sized.join(F.broadcast(heavy), "group_key", "left")
        .join(F.broadcast(bundles), "bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own_shard", "bundle_shard").alias("shard"))
    )
    return with_slots(placed_docs)


def with_slots(placed: DataFrame) -> DataFrame:
    """Adds `slot`, gapless from 0 within each shard."""
    bucketed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(SLOT_BUCKETS)))
    counts = bucketed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    # At most SLOT_BUCKETS offsets for each shard.
    return (
        bucketed.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot"))
    )
