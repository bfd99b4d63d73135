"""Stations: averages, nearest cluster centre, map layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import schemas

# Cluster centres (coeff_1, coeff_2) by group number, and group colours.
CENTRES = ((0, 0), (-250, -250), (500, 0), (500, 400), (-100, 600), (-1500, 500), (-200, 100))
COLOURS = ("red", "orange", "yellow", "green", "black", "blue", "purple")

RADIUS_SCALE = 4800


def station_means(decomposed: DataFrame) -> DataFrame:
    """Averages per station, named as Spark names them."""
    return decomposed.groupBy("Station").avg("coeff_1", "coeff_2", "Longitude", "Latitude")


def station_counts(decomposed: DataFrame) -> DataFrame:
    """`Station, count`: measurements per station."""
    return decomposed.groupBy("Station").count()


def stations(decomposed: DataFrame) -> DataFrame:
    """`Station, coeff_1, coeff_2, Longitude, Latitude, count`; `ordering.with_position` puts them in station order.

    Averages and count come from one aggregation, which a join of the two
    tables above would do twice.
    """
    averages = [F.avg(c).alias(c) for c in ("coeff_1", "coeff_2", "Longitude", "Latitude")]
    return decomposed.groupBy("Station").agg(*averages, F.count("*").alias("count"))


def centre_table(spark: SparkSession, centres: Sequence[tuple[float, float]] = CENTRES) -> DataFrame:
    """The centres as a table, written as constants: no Python worker is needed to make it."""
    rows = [
        F.struct(F.lit(i).alias("group_id"), F.lit(float(a)).alias("c1"), F.lit(float(b)).alias("c2"))
        for i, (a, b) in enumerate(centres)
    ]
    return spark.range(1).select(F.inline(F.array(*rows))).to(schemas.CENTRES)


def nearest_centre(c1: Column, c2: Column, centres: Sequence[tuple[float, float]] = CENTRES) -> Column:
    """The number of the closest centre, the lower one on a tie.

    The centres are a handful of constants, so this is an expression of the
    row itself and needs no join.
    """
    candidates = [
        F.struct(
            (F.pow(c1 - F.lit(float(a)), 2) + F.pow(c2 - F.lit(float(b)), 2)).alias("distance"),
            F.lit(i).alias("group_id"),
        )
        for i, (a, b) in enumerate(centres)
    ]
    known = c1.isNotNull() & c2.isNotNull()
    return F.when(known, F.array_min(F.array(*candidates))["group_id"])


def with_nearest_group(
    rows: DataFrame, centres: Sequence[tuple[float, float]] = CENTRES, name: str = "group"
) -> DataFrame:
    return rows.withColumn(name, nearest_centre(F.col("coeff_1"), F.col("coeff_2"), centres))


def centre_sizes(grouped: DataFrame, centres: Sequence[tuple[float, float]] = CENTRES) -> DataFrame:
    """The centre table with the number of stations nearest to each, zero included."""
    sizes = grouped.groupBy(F.col("group").alias("group_id")).agg(F.count("*").alias("n_stations"))
    return (
        centre_table(grouped.sparkSession, centres)
        .join(sizes, "group_id", "left")
        .withColumn("n_stations", F.coalesce("n_stations", F.lit(0)))
    )


def bounding_box(rows: DataFrame) -> DataFrame:
    """One row: the box around all stations and its centre."""
    box = rows.agg(
        F.min("Latitude").alias("min_lat"),
        F.min("Longitude").alias("min_lon"),
        F.max("Latitude").alias("max_lat"),
        F.max("Longitude").alias("max_lon"),
    )
    return box.select(
        "*",
        ((F.col("max_lat") + F.col("min_lat")) / 2).alias("center_lat"),
        ((F.col("max_lon") + F.col("min_lon")) / 2).alias("center_lon"),
    )


def markers(grouped: DataFrame, colours: Sequence[str] = COLOURS) -> DataFrame:
    """`lat, lon, radius, color` of each station's circle; its area follows the count."""
    return grouped.select(
        F.col("Latitude").alias("lat"),
        F.col("Longitude").alias("lon"),
        (RADIUS_SCALE * F.sqrt(F.col("count"))).cast("int").alias("radius"),
        F.get(F.array(*[F.lit(c) for c in colours]), F.col("group")).alias("color"),
    )
