"""Text lines as a DataFrame, from files or from rows at hand."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane import schemas


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row a line of the text file(s) below `path`."""
    return spark.read.text(path)


def rows_to_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A DataFrame from a small list of rows, with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def lines_from(spark: SparkSession, lines: Iterable[str | None]) -> DataFrame:
    return rows_to_frame(spark, ((line,) for line in lines), schemas.LINES)


def count_lines(lines: DataFrame) -> DataFrame:
    """One row, `n`: all lines, unreadable ones included."""
    return lines.agg(F.count("*").alias("n"))
