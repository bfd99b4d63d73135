"""Lines through integer points: slope, intercept and exact direction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Differences of coordinates below this magnitude cannot overflow a bigint.
COORDINATE_BOUND = 1 << 62


def slope(dx: Column, dy: Column) -> Column:
    """dy/dx as a double, +Infinity for a vertical line; never -0.0."""
    return F.when(dx == 0, F.lit(float("inf"))).otherwise(dy / dx + F.lit(0.0))


def exact_offset(x: Column, y: Column, unit: Column) -> Column:
    """dx*y - dy*x for a reduced direction: equal for all points of one line, exact at any size."""

    def wide(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    return wide(unit["dx"]) * wide(y) - wide(unit["dy"]) * wide(x)
