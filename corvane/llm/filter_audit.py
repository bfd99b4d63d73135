"""What each filter of a chain does, in every order of the chain.

A document's failures are one bit mask, so all that the orders can differ in
is decided by the number of documents with each mask: a part of the corpus is
at most 2^k *cells* (k filters), counted by Spark in one combined aggregation.
From there on no order is run. A Gray-code walk visits all 2^k sets of active
filters and toggles one filter a step; every cell carries a counter of the
active filters it fails, and whenever a counter leaves or reaches zero the
cell leaves or rejoins the running number of survivors. The 2^k states so
stored hold all answers: what a filter removes after a set S of others is the
difference between the states of S and of S with the filter.

`audit` takes flagged documents (`flag_documents` makes them for the five
filters of `FILTERS`): part, mask, and any number of marks (long, 0 or 1) whose
sums are followed too.

Defined results: a null text is empty, a null part the empty string; a
document fails `E` if its text equals that of any smaller doc_id, so repeated
rows with one doc_id don't fail each other, and a row without doc_id neither
fails nor is matched by labels; of several labels for one doc_id each
mark is the largest; texts of any length are read whole; an empty table has no
parts, hence no rows. Other columns are not looked at.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import narrow
from corvane.session import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The filters by letter, and white space.
FILTERS = "ABCDE"
WHITE = " \t\n\x0b\x0c\r"


def text_failures(text: Column) -> Column:
    """Bits 1, 2, 4 and 8 for the failures A to D of a text that is not null, in generated code.

    The split text is one common subexpression there.
    """
    trimmed = F.btrim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    conditions = (n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * F.length(text), text.rlike("[#$%&*|]"))
    bits = [F.when(condition, 1 << i).otherwise(0) for i, condition in enumerate(conditions)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def flag_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, mask, good, toxic: one row a document, its failures of A to E as the bits 1 to 16.

    Texts are read once; what is kept of one is a row of some 60 bytes with its
    digest, stored in the shared folder as two steps need it. The first
    document of every text is found by a combined aggregation over digests, and
    is joined back by document, so a text that holds a third of all rows
    is no join key.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = narrow(docs, doc_id=id_col, text=text_col, part=part_col).select(
        "doc_id",
        F.coalesce("part", F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        text_failures(text).cast("byte").alias("mask"),
    )
    folder = shared_folder(spark, "audit")
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)

    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "digest", F.lit(True).alias("first"))
    marks = narrow(labels, doc_id="doc_id", quality="quality", toxic="toxic").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return (
        rows.join(marks, "doc_id", "left")
        .join(first, ["doc_id", "digest"], "left")
        .select(
            "part",
            (F.col("mask") + F.when(copy, 16).otherwise(0)).cast("int").alias("mask"),
            *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("good", "toxic")),
        )
    )


def walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every set of active filters, from cells indexed by the filters they fail.

    Both arrays are of shape (2^k, figures). One filter is toggled a step.
    """
    masks = np.arange(len(cells))
    failing = np.zeros(len(cells), "i8")
    survivors = cells.sum(axis=0)
    states = np.empty_like(cells)
    states[0] = survivors
    active = 0
    for step in range(1, len(cells)):
        toggled = step & -step
        active ^= toggled
        touched = (masks & toggled) != 0
        if active & toggled:
            survivors = survivors - cells[touched & (failing == 0)].sum(axis=0)
            failing[touched] += 1
        else:
            failing[touched] -= 1
            survivors = survivors + cells[touched & (failing == 0)].sum(axis=0)
        states[active] = survivors
    return states


def order_rows(states: np.ndarray, filters: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, shapley, removed of every further figure) from the states.

    `shapley` is what the step's filter removes, summed over all orders.
    """
    k, everything = len(filters), len(states) - 1
    counts = states[:, 0]
    fails = [counts[0] - counts[1 << i] for i in range(k)]
    unique = [counts[everything ^ (1 << i)] - counts[everything] for i in range(k)]
    shares = [0] * k
    for i in range(k):
        for before in range(everything + 1):
            if not before & (1 << i):
                used = before.bit_count()
                shares[i] += factorial(used) * factorial(k - 1 - used) * int(counts[before] - counts[before | (1 << i)])
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | (1 << i)
            lost = states[before] - states[after]
            name = "".join(filters[j] for j in order)
            yield (name, step, counts[after], lost[0], fails[i] - lost[0], unique[i], shares[i], *lost[1:])
            before = after


def audit(flagged: DataFrame, filters: str = FILTERS, marks: Sequence[str] = ("good", "toxic")) -> DataFrame:
    """Every part, order and step: part, filter_order, step, kept, removed, redundant, unique_fails, shapley, <mark>_lost.

    A part reaches a task as its cells, 2^k rows at most whatever it holds.
    """
    marks = list(marks)
    size, figures = 1 << len(filters), ["n", *marks]
    cells = flagged.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.sum(F.col(c).cast("long")).alias(c) for c in marks))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *figures)).alias("cells"))
    names = ["kept", "removed", "redundant", "unique_fails", "shapley", *(f"{c}_lost" for c in marks)]

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                table = np.zeros((size, len(figures)), "i8")
                for cell in found:
                    table[cell["mask"]] = [cell[c] for c in figures]
                orders, numbers, *columns = zip(*order_rows(walk(table), filters), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(orders), pa.string()), pa.array(orders, pa.string()), pa.array(numbers, pa.int32())]
                    + [pa.array([int(v) for v in column], pa.int64()) for column in columns],
                    names=["part", "filter_order", "step", *names],
                )

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in names)
    return parts.mapInArrow(steps, schema)
