"""Fetching rows to the driver, under a bound that the caller states."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row


def fetch(df: DataFrame, at_most: int) -> list[Row]:
    """All rows, of which the schema or a parameter allows `at_most`; more of them fail the job.

    One row beyond the bound is asked for, and no more, so a wrong bound cannot fill the driver.
    """
    rows = df.limit(at_most + 1).collect()
    if len(rows) > at_most:
        raise ValueError(f"more than the {at_most} rows that were stated")
    return rows


def fetch_one(df: DataFrame) -> Row:
    """The one row of an aggregate."""
    rows = fetch(df, 1)
    if not rows:
        raise ValueError("no row where one was stated")
    return rows[0]
