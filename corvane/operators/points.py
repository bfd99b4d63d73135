"""Points, pairs of points, and the lines through three or more of them.

All pairs must be looked at: that is the nature of the problem. What can be
chosen is where, and in what form.

* Where pairs are what is asked for, points are spread over a square grid of
  blocks: every point goes to one row of blocks as A and to one column as B, so
  each is copied as often as the grid is wide, and any pair meets in one block.
* To find lines, no pair becomes a row. Points travel in packed chunks; anchors
  are dealt out to blocks, and every block sees all chunks go by. It keeps the
  reduced direction of each step, so the counts per anchor and direction are
  complete where they are made, and what leaves is one row per anchor and line.
  The directions held at once are bounded (`RAYS_HELD`): the more points there
  are, the fewer anchors share a block, and then the directions are dealt out
  to several classes, each of which sees the chunks go by on its own.

A line is told by its direction in lowest terms and its offset, both exact, at
any range of coordinates. An anchor knows how many points of its line come before
it, which gives positions, first points and distinct lines without a sort or a
comparison of sets. The work is the same for every task however the points
lie, a line that holds a third of all points included, and no row of the lines
grows with their length. Where an anchor's groups are asked for as sets, a
row holds all members of one: they are listed where they are counted, so no
pair becomes a row there either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import geometry
from corvane.functions.rays import ray_class, rays, shared_rays
from corvane.sources.fetch import fetch_one

# Pairs of one block of the grid.
PAIRS_PER_BLOCK = 500_000
# Directions that one block holds, 24 bytes each, and blocks to aim at.
RAYS_HELD = 1 << 20
LEAST_BLOCKS = 32
ROWS_PER_BATCH = 50_000
TOKEN = "[^ \\t-\\r\\x1C-\\x1F\\x85\\p{Z}]+"

RAYS = "x bigint, y bigint, dx bigint, dy bigint, n_others bigint, n_before bigint, low bigint, high bigint"
STEPS = "steps array<bigint>"


def parse_points(lines: DataFrame) -> DataFrame:
    """`"x y"` lines as integer points; a line without two integers fails the job."""
    parts = F.regexp_extract_all("value", F.lit(TOKEN), F.lit(0))
    return lines.select(
        F.element_at(parts, 1).cast("bigint").alias("x"),
        F.element_at(parts, 2).cast("bigint").alias("y"),
    )


def unique_points(points: DataFrame) -> DataFrame:
    """Each point once; coordinates from 2**62 on are refused, as their differences may overflow."""
    far = F.greatest(F.abs("x"), F.abs("y")) >= geometry.COORDINATE_BOUND
    error = F.raise_error(F.concat(F.lit("coordinates must stay below 2**62 in magnitude, found "), "x", F.lit(" "), "y"))
    return points.select(F.when(far, error.cast("bigint")).otherwise(F.col("x")).alias("x"), "y").distinct()


def count_points(points: DataFrame) -> int:
    return fetch_one(points.agg(F.count("*").alias("n")))["n"]


def ordered_pairs(points: DataFrame) -> DataFrame:
    """Every (A, B) with A and B distinct points: `ax, ay, bx, by`."""
    points = unique_points(points)
    n = count_points(points)
    width = max(3, math.ceil(n / math.sqrt(PAIRS_PER_BLOCK)))
    line = F.pmod(F.xxhash64("x", "y"), F.lit(width)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(width - 1)))
    anchors = points.select(line.alias("row"), F.col("x").alias("ax"), F.col("y").alias("ay")).select("*", every.alias("column"))
    others = points.select(line.alias("column"), F.col("x").alias("bx"), F.col("y").alias("by")).select("*", every.alias("row"))
    same = (F.col("ax") == F.col("bx")) & (F.col("ay") == F.col("by"))
    return others.join(anchors.hint("shuffle_hash"), ["row", "column"]).filter(~same).select("ax", "ay", "bx", "by")


def with_slope(pairs: DataFrame) -> DataFrame:
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    return pairs.withColumn("slope", geometry.slope(dx, dy))


def _packed(points: DataFrame) -> DataFrame:
    """`chunk binary`: the coordinates of some thousand points a row, as they come."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xy = np.stack([batch.column(c).to_numpy() for c in ("x", "y")])
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([xy.astype("<i8").tobytes()], pa.binary())})

    return points.mapInArrow(pack, "chunk binary")


def point_rays(points: DataFrame, least: int = 1, members: bool = True) -> DataFrame:
    """One row for each point and each direction in which it sees `least` or more others.

    `x, y, dx, dy, n_others, n_before, low, high`: (dx, dy) is the reduced direction,
    n_before counts the others that come before the point in (x, y) order, and
    the outermost others lie `low` and `high` steps of (dx, dy) away. With
    `members`, `steps` says so of every other, in (x, y) order.
    """
    points = unique_points(points)
    n = max(1, count_points(points))
    anchors_in_block = max(1, min(RAYS_HELD // n, math.ceil(n / LEAST_BLOCKS)))
    blocks, classes = math.ceil(n / anchors_in_block), math.ceil(n / RAYS_HELD)
    class_numbers = F.explode(F.sequence(F.lit(0), F.lit(classes - 1))).alias("class")
    block_numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    block = F.pmod(F.xxhash64("x", "y"), F.lit(blocks)).cast("int").alias("block")
    nothing = F.lit(None)
    anchors = points.select("x", "y", block).select("block", class_numbers, "x", "y", nothing.cast("binary").alias("chunk"))
    chunks = _packed(points).select(block_numbers, "chunk").select(
        "block", class_numbers, nothing.cast("bigint").alias("x"), nothing.cast("bigint").alias("y"), "chunk"
    )
    # Within a block and class, its anchors come before the chunks.
    dealt = anchors.unionByName(chunks).repartition(blocks * classes, "block", "class").sortWithinPartitions("block", "class", F.col("chunk").isNotNull())

    schema = f"{RAYS}, {STEPS}" if members else RAYS
    names = [field.split()[0] for field in schema.split(", ")]

    def counted(anchor: tuple[int, int], seen: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
        *found, steps = shared_rays(*(np.concatenate(part) for part in zip(*seen)), least)
        return [np.full(len(found[0]), v, "i8") for v in anchor] + found + [steps] * members

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors, rows, size = None, {}, [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for anchor, seen in anchors.items():
                if seen:
                    rows.append(counted(anchor, seen))
                    seen.clear()
                    size += max(len(rows[-1][0]), len(rows[-1][-1]))
                # A batch of its own for each anchor would cost more than finding its lines.
                if size >= ROWS_PER_BATCH:
                    yield taken()
            anchors.clear()

        def taken() -> pa.RecordBatch:
            nonlocal size
            columns = [pa.array(np.concatenate(column).astype("i8")) for column in zip(*rows)]
            if members:
                lengths = columns[names.index("n_others")].to_numpy()
                columns[-1] = pa.ListArray.from_arrays(np.append([0], np.cumsum(lengths)).astype("i4"), columns[-1])
            rows.clear()
            size = 0
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if key != (key := (row["block"], row["class"])):
                    yield from finished()
                if row["chunk"] is None:
                    anchors[row["x"], row["y"]] = []
                    continue
                px, py = np.frombuffer(row["chunk"], "<i8").reshape(2, -1)
                for (x, y), seen in anchors.items():
                    dx, dy = px - x, py - y
                    other = (dx != 0) | (dy != 0)
                    ray = rays(dx[other], dy[other])
                    if classes > 1:
                        mine = ray_class(ray[0], ray[1], classes) == key[1]
                        ray = tuple(part[mine] for part in ray)
                    if len(ray[0]):
                        seen.append(ray)
        yield from finished()
        if rows:
            yield taken()

    return dealt.mapInArrow(search, schema)


def _moved(steps: Column | str) -> tuple[Column, Column]:
    """The point that many steps of (dx, dy) from (x, y)."""
    t = F.col(steps) if isinstance(steps, str) else steps
    return F.col("x") + t * F.col("dx"), F.col("y") + t * F.col("dy")


def anchor_groups(rays_seen: DataFrame) -> DataFrame:
    """The points seen from each anchor at one slope, a row a group: `ax, ay, dx, dy, slope, n_others, others, first, last`.

    The members of a group, `others`, are the points of its line but the anchor, in (x, y) order; `first` and `last` are its outermost.
    """
    others = F.transform("steps", lambda t: F.struct(*(c.alias(n) for c, n in zip(_moved(t), ("x", "y")))))
    ends = [F.struct(*(c.alias(n) for c, n in zip(_moved(end), ("x", "y")))).alias(name) for end, name in (("low", "first"), ("high", "last"))]
    return rays_seen.select(
        F.col("x").alias("ax"), F.col("y").alias("ay"), "dx", "dy", geometry.slope(F.col("dx"), F.col("dy")).alias("slope"), "n_others", others.alias("others"), *ends
    )


def anchor_sets(groups: DataFrame) -> DataFrame:
    """Groups with their anchor put in behind the others, where that makes three points or more: `n_points, points` for `n_others, others`."""
    anchor = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))
    return groups.filter("n_others >= 2").select(
        "ax", "ay", "dx", "dy", "slope", (F.col("n_others") + 1).alias("n_points"), F.array_append("others", anchor).alias("points"),
        F.least("first", anchor).alias("first"), F.greatest("last", anchor).alias("last"),
    )


def sort_points(sets: DataFrame) -> DataFrame:
    """Sets with their points in (x, y) order."""
    return sets.withColumn("points", F.array_sort("points"))


def distinct_sets(sorted_sets: DataFrame) -> DataFrame:
    """`slope, n_points, points`: each set once, of all its points' own copies that of the first point."""
    anchor = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))
    return sorted_sets.filter(F.get("points", F.lit(0)) == anchor).select("slope", "n_points", "points")


def line_points(rays_seen: DataFrame) -> DataFrame:
    """Every line of three points or more, one row for each of its points in order.

    `line` (exact: dx, dy, offset), `slope, intercept, n_points, position, x, y`; position counts from 1.
    """
    x, y = F.col("x"), F.col("y")
    unit = F.struct("dx", "dy")
    offset = geometry.exact_offset(x, y, unit)
    meets = offset.cast("double") / F.nullif(F.col("dx"), F.lit(0)) + F.lit(0.0)
    return rays_seen.filter("n_others >= 2").select(
        F.struct("dx", "dy", offset.alias("offset")).alias("line"),
        geometry.slope(F.col("dx"), F.col("dy")).alias("slope"),
        F.when(F.col("dx") == 0, x.cast("double")).otherwise(meets).alias("intercept"),
        (F.col("n_others") + 1).alias("n_points"),
        (F.col("n_before") + 1).alias("position"),
        "x",
        "y",
    )


def lines_through_points(points: DataFrame) -> DataFrame:
    """`line_points` of a table of points."""
    return line_points(point_rays(points, least=2, members=False))


def distinct_lines(members: DataFrame) -> DataFrame:
    """Each line once, with its smallest point: the row of position 1."""
    return members.filter("position = 1").drop("position")


def set_digests(members: DataFrame) -> DataFrame:
    """`line, n_points, digest`: a number for each set of points that does not depend on their order."""
    sums = [F.sum(F.xxhash64(F.lit(seed), "x", "y").cast("decimal(38,0)")) for seed in (1, 2)]
    return members.groupBy("line").agg(F.count("*").alias("n_points"), *(s.alias(f"sum_{i}") for i, s in enumerate(sums))).select(
        "line", "n_points", F.concat_ws(":", "n_points", "sum_0", "sum_1").alias("digest")
    )


def set_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """`side, line, n_points` of the sets that only one of two tables of line points holds."""
    a, b = set_digests(a), set_digests(b)
    only = lambda left, right, side: left.join(right, "digest", "left_anti").select(F.lit(side).alias("side"), "line", "n_points")
    return only(a, b, "a").unionByName(only(b, a, "b"))


def same_sets(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables of line points hold the same sets.

    One row a side is compared: the sum of all sets' digests. The sets
    themselves are not joined.
    """

    def whole(members: DataFrame) -> tuple:
        number = F.xxhash64("digest").cast("decimal(38,0)")
        return tuple(fetch_one(set_digests(members).agg(F.count("*").alias("n"), F.sum(number).alias("digests"))))

    return whole(a) == whole(b)
