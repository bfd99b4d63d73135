"""Exact top-k search by inner product, with a pivot table.

For vectors, 2<q, x> = |q|^2 + |x|^2 - d(q, x)^2, and by the triangle
inequality d(q, x) >= |d(q, p) - d(x, p)| for every pivot p. With the distances
of all vectors to some pivots at hand, the largest of these differences bounds
what x can score at most. A query takes up candidates in the order of their
bounds and stops where the next bound is below its k-th best score so far, as
no later one can enter. The bounds decide about the work, never the result.

1. Vectors become integers, floor(scale * x). Of equal vectors only the k + 1
   with the smallest ids can be among anyone's first k (one may be the query
   itself), so a vector that a third of all rows share leaves k + 1 rows.
2. Pivots are chosen far apart among a bounded sample (`SAMPLE_ROWS`). Each
   vector belongs to the *cell* of its nearest pivot; cells are dealt out in
   blocks of about `BLOCK_ROWS` rows, queries in chunks of `QUERY_ROWS`, so that a
   task holds one block and one chunk, whatever the size of a cell.
3. Queries first meet the blocks of their own cell. With the k-th score found
   there, the range of each cell's distances to the pivots (a table of cells by
   pivots, all that is broadcast) tells which other cells can still hold a better
   one; only blocks of those are met.

Defined results: a row without id takes no part, nor does one whose vector is
null or holds a null or non-finite component; repeated rows (id and vector)
count once; an id with several vectors is a candidate with each, and asks with
the least of them in byte order; a query's candidates are the rows of other ids
with vectors of equal length; equal scores are ordered by id. A component
beyond 32 bits, or a score beyond 64, fails the job. Empty tables give no rows;
other columns are not looked at.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.tables import narrow
from corvane.session import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 4096
PIVOTS = 32
BLOCK_ROWS = 8192
QUERY_ROWS = 8192
# Candidates scored at once by one query.
STEP = 256

Pivots = dict[int, np.ndarray]


def as_rows(vectors: pa.Array, dim: int) -> np.ndarray:
    """Packed vectors of one length as a matrix of doubles."""
    return np.frombuffer(b"".join(vectors.to_pylist()), "<i4").reshape(len(vectors), dim).astype("f8")


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (rows * rows).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def far_apart(rows: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the rows, each as far as possible from those before it."""
    chosen = [0]
    nearest = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


def most(q_norm, x_norm, apart):
    """The score that squared norms and a least distance allow at most, with room for rounding."""
    bound = (q_norm + x_norm - apart * apart) / 2
    return bound + 1e-7 * (q_norm + x_norm) + 1


def exact_scores(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products: as doubles while those hold every partial sum exactly, else as Python's integers."""
    if np.abs(rows).max(initial=0) * np.abs(q).sum() < 2**53:
        return (rows @ q).astype("i8")
    scores = rows.astype("i8").astype(object) @ q.astype("i8").astype(object)
    if any(abs(s) >= 2**63 for s in scores):
        raise OverflowError("a score does not fit 64 bits")
    return scores.astype("i8")


def best_of_block(q: np.ndarray, own: int, floor: float, rows: np.ndarray, ids: np.ndarray, norms: np.ndarray, apart: np.ndarray, k: int) -> tuple[list, int]:
    """Up to k (-score, id) of a block for one query, and how many candidates were scored.

    `apart` is the least distance of each candidate that the pivots allow. A
    candidate below `floor` need not be found.
    """
    bounds = most((q * q).sum(), norms, apart)
    order = np.argsort(-bounds)
    found: list[tuple[int, int]] = []
    done = 0
    while done < len(order) and bounds[order[done]] >= floor:
        some = order[done : done + STEP]
        done += len(some)
        scores = exact_scores(q, rows[some])
        good = (scores >= floor) & (ids[some] != own)
        found = sorted(found + list(zip((-scores[good]).tolist(), ids[some][good].tolist(), strict=True)))[:k]
        if len(found) == k:
            floor = max(floor, -found[-1][0])
    return found, done


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """vec_id, dim, vector (packed 32-bit integers): every different row that takes part."""
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = narrow(vectors, vec_id=id_col, x=vector_col).select("vec_id", F.col("x").cast("array<double>").alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("x")
            values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
            if (np.abs(values) >= 2**31).any():
                raise OverflowError("a component does not fit 32 bits")
            data, ends = values.astype("<i4").tobytes(), np.cumsum(lengths := pc.list_value_length(column).to_numpy())
            packed = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(lengths, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "dim", "vector"])

    kept = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)
    return kept.mapInArrow(pack, "vec_id bigint, dim int, vector binary").distinct()


def _groups(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, pa.RecordBatch | pa.Table]]:
    """The rows of each vector length."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, batch.take(pa.array(np.flatnonzero(dims == dim)))


def choose_pivots(rows: DataFrame, n: int) -> Pivots:
    """Pivots by vector length, from at most SAMPLE_ROWS rows; a length that the sample misses has none."""
    sample = rows.orderBy(F.xxhash64("vector", "vec_id")).limit(SAMPLE_ROWS).select("dim", "vector").toArrow()
    return {dim: far_apart(as_rows(found.column("vector"), dim), n) for dim, found in _groups(sample)}


def with_cells(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """Adds `cell`, the number of the nearest pivot."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, found in _groups(batch):
                cells = np.zeros(len(found), "i4")
                if dim in shared.value:
                    cells = distances(as_rows(found.column("vector"), dim), shared.value[dim]).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*found.columns, pa.array(cells, pa.int32())], names=[*found.schema.names, "cell"])

    return rows.mapInArrow(place, "vec_id bigint, dim int, vector binary, cell int")


def cell_ranges(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """dim, cell, pivot, low, high, norm: a cell's distances to a pivot, and its largest squared norm. Pivot -1 has the norm alone."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for dim, found in _groups(batch):
                x, cells = as_rows(found.column("vector"), dim), found.column("cell").to_numpy()
                away, norms = distances(x, shared.value.get(dim, np.zeros((0, dim)))), (x * x).sum(axis=1)
                for cell in np.unique(cells).tolist():
                    mine = away[cells == cell]
                    norm = norms[cells == cell].max()
                    out.append((dim, cell, -1, 0.0, 0.0, norm))
                    out += [(dim, cell, p, low, high, norm) for p, (low, high) in enumerate(zip(mine.min(axis=0), mine.max(axis=0), strict=True))]
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int32()] * 3 + [pa.float64()] * 3, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["dim", "cell", "pivot", "low", "high", "norm"])

    each = rows.mapInArrow(ranges, "dim int, cell int, pivot int, low double, high double, norm double")
    return each.groupBy("dim", "cell", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("norm").alias("norm"))


def cells_worth_a_look(asking: DataFrame, ranges: DataFrame, pivots: Pivots) -> DataFrame:
    """The queries (with `floor`), once for each other cell whose bound reaches the floor; `cell` names it."""
    table: dict[int, dict[int, dict[int, tuple]]] = {}
    # One row for each cell and pivot: at most PIVOTS * (PIVOTS + 1) for each vector length.
    for r in ranges.collect():
        table.setdefault(r.dim, {}).setdefault(r.cell, {})[r.pivot] = (r.low, r.high, r.norm)
    shared = asking.sparkSession.sparkContext.broadcast((table, pivots))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, pivots = shared.value
        for batch in batches:
            for dim, found in _groups(batch):
                q, own = as_rows(found.column("vector"), dim), found.column("cell").to_numpy()
                away, floor = distances(q, pivots.get(dim, np.zeros((0, dim)))), found.column("floor").to_numpy()
                for cell, by_pivot in table.get(dim, {}).items():
                    apart = np.zeros(len(q))
                    for p, (low, high, _) in by_pivot.items():
                        if p >= 0:
                            apart = np.maximum(apart, np.maximum(low - away[:, p], away[:, p] - high))
                    good = np.flatnonzero((own != cell) & (most((q * q).sum(axis=1), by_pivot[-1][2], apart) >= floor))
                    if len(good):
                        chosen = found.take(pa.array(good))
                        yield chosen.set_column(chosen.schema.get_field_index("cell"), "cell", pa.array(np.full(len(good), cell), pa.int32()))

    return asking.mapInArrow(look, asking.schema)


def _meet(asking: DataFrame, rows: DataFrame, pivots: Pivots, k: int, chunks: int) -> DataFrame:
    """query_id, vec_id, score: up to k rows of every block that a query's cell has, floor and up."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    sizes = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    blocks = rows.join(sizes, ["dim", "cell"]).select(
        "dim", "cell", F.pmod(F.xxhash64("vec_id", "vector"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "vec_id", "vector"
    )
    seekers = asking.join(sizes, ["dim", "cell"]).select(
        "dim", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"), "vec_id", "vector", "floor"
    )

    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(block) and len(queries):
            dim = block.column("dim")[0].as_py()
            x, ids = as_rows(block.column("vector").combine_chunks(), dim), block.column("vec_id").to_numpy()
            near = shared.value.get(dim, np.zeros((0, dim)))
            q = as_rows(queries.column("vector").combine_chunks(), dim)
            table, asked, norms = distances(x, near), distances(q, near), (x * x).sum(axis=1)
            for i, (own, floor) in enumerate(zip(queries.column("vec_id").to_pylist(), queries.column("floor").to_pylist(), strict=True)):
                apart = np.abs(table - asked[i]).max(axis=1, initial=0)
                found, _ = best_of_block(q[i], own, floor, x, ids, norms, apart, k)
                out += [(own, other, -score) for score, other in found]
        columns = zip(*out, strict=True) if out else [[], [], []]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    key = ["dim", "cell", "block", "chunk"]
    return blocks.groupBy(key).cogroup(seekers.groupBy(key)).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")


def first_k(found: DataFrame, k: int) -> DataFrame:
    """The best k rows of each query, with their `rank` from 1; cut in every task before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_vectors(vectors: DataFrame, asks: str, k: int = 5, scale: float = 256, pivots: int = PIVOTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row for which the SQL condition `asks` on vec_id holds."""
    spark = vectors.sparkSession
    folder = shared_folder(spark, "top-vectors")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    everyone = kept(quantised(vectors, id_col, vector_col, scale), "vectors")
    near = choose_pivots(everyone, pivots)
    alike = Window.partitionBy("vector").orderBy("vec_id")
    few = everyone.withColumn("copy", F.row_number().over(alike)).where(F.col("copy") <= k + 1).drop("copy")
    rows = kept(with_cells(few, near), "rows")

    queries = everyone.where(asks).groupBy("vec_id").agg(F.min(F.struct("vector", "dim")).alias("v")).select("vec_id", "v.dim", "v.vector")
    asking = kept(with_cells(queries, near), "queries")
    chunks = max(1, -(-asking.count() // QUERY_ROWS))
    lowest = F.lit(float("-inf"))
    first = kept(first_k(_meet(asking.withColumn("floor", lowest), rows, near, k, chunks), k), "own-cells")

    # With fewer than k rows so far, any score can still enter.
    floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("reached"))
    informed = asking.join(floors, "vec_id", "left").select("vec_id", "dim", "vector", "cell", F.coalesce("reached", lowest).alias("floor"))
    further = cells_worth_a_look(informed, cell_ranges(rows, near), near)
    rest = _meet(further, rows, near, k, chunks)
    return first_k(first.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
