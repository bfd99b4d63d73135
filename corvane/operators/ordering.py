"""Order as a result: each row's place in the whole."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.sources.fetch import fetch
from corvane.sources.results import ResultStore

# The row number that Spark gives within a partition takes the low 33 bits, the partition's number the rest.
_ROW_BITS = 33


def with_position(df: DataFrame, order: list[str | Column], store: ResultStore, name: str) -> DataFrame:
    """`df` with `position`, from 1: where the row stands when all are sorted by `order`.

    Rows are dealt out by ranges of the order and sorted within them, in parallel. They are
    stored once with their range and place, the ranges are counted, and a place's
    position is what the ranges before it hold plus its place. No task
    sees more than its range. The order should be total, as rows that tie in it
    get positions in no certain order.
    """
    place = F.monotonically_increasing_id()
    stored = store.write(name, df.orderBy(*order).select(F.struct(*df.columns).alias("row"), place.alias("place")))
    part = F.shiftright("place", _ROW_BITS).cast("int").alias("part")
    # One row a range; there are no more of them than shuffle partitions.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = sorted(fetch(stored.groupBy(part).agg(F.count("*").alias("n")), partitions), key=lambda r: r["part"])
    before = [0, *accumulate(r["n"] for r in counts)]
    offsets = df.sparkSession.createDataFrame([(r["part"], n) for r, n in zip(counts, before)], "part int, before bigint")
    placed = stored.select("row", part, F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("at"))
    return placed.join(F.broadcast(offsets), "part").select("row.*", (F.col("before") + F.col("at") + 1).alias("position"))
