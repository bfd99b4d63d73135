"""From a text file of points to its collinear sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.operators import points
from corvane.sources.lines import read_lines


def collinear_job(lines: DataFrame) -> DataFrame:
    """Every set of three or more collinear points, one row for each point of a line, with its position."""
    return points.lines_through_points(points.parse_points(lines))


def collinear_file(spark: SparkSession, path: str) -> DataFrame:
    return collinear_job(read_lines(spark, path))
