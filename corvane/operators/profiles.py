"""Yearly profiles of station groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.vectors import Basis
from corvane.operators.decomposition import decompose
from corvane.operators.stations import CENTRES, with_nearest_group


def grouped_rows(measurements: DataFrame, grouped_stations: DataFrame) -> DataFrame:
    """`Station, Year, values, group`: each measurement with its station's group.

    The station table is the small side; Spark broadcasts it while it is known
    to be small, and otherwise splits the partition of a station that holds
    much of the data at run time.
    """
    groups = grouped_stations.select("Station", "group")
    return measurements.select("Station", "Year", "values").join(groups, "Station")


def profile(rows: DataFrame) -> DataFrame:
    """`group_id, day, value`: the average of each group's measurements by day; missing days are skipped.

    Days are averaged within each task first: the shuffle carries a row per
    group and day, not per measurement.
    """
    return (
        rows.select(F.col("group").alias("group_id"), F.posexplode_outer("values").alias("pos", "value"))
        .filter(F.col("value").isNotNull())
        .groupBy("group_id", (F.col("pos") + 1).alias("day"))
        .agg(F.avg("value").alias("value"))
    )


def profile_vectors(profiles: DataFrame, days: int) -> DataFrame:
    """One vector per group, `group_id, values`; a day without a value is null.

    A group has at most `days` rows here, so gathering them is bounded.
    """
    by_day = F.map_from_entries(F.collect_list(F.struct("day", "value")))
    return (
        profiles.groupBy("group_id")
        .agg(by_day.alias("by_day"))
        .select(
            "group_id",
            F.transform(F.sequence(F.lit(1), F.lit(days)), lambda d: F.try_element_at("by_day", d)).alias("values"),
        )
    )


def match_profiles(
    profiles: DataFrame, basis: Basis, centres: Sequence[tuple[float, float]] = CENTRES
) -> DataFrame:
    """`group_id, coeff_1, coeff_2, matched`: the centre nearest to each profile's own coefficients."""
    split = decompose(profile_vectors(profiles, basis.days), "values", basis)
    return with_nearest_group(split, centres, name="matched").select("group_id", "coeff_1", "coeff_2", "matched")
