"""Side tables (user groups, eigenbasis) and the filtered weather scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import schemas
from corvane.functions.vectors import Basis
from corvane.sources.fetch import fetch


def read_user_groups(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.USER_GROUPS).parquet(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.WEATHER).parquet(path)


def weather_of(spark: SparkSession, country: str, measurement: str, view: str = "weather") -> DataFrame:
    """The view's rows for one country and measurement.

    The values are bound parameters, and both equality tests reach the
    Parquet scan (partition the table by them to prune whole files).
    """
    return spark.sql(
        "SELECT * FROM IDENTIFIER(:view) WHERE country = :country AND measurement = :measurement",
        args={"view": view, "country": country, "measurement": measurement},
    )


def save_basis(spark: SparkSession, bases: dict[str, Basis], path: str) -> DataFrame:
    """Write one eigenbasis per measurement kind, in a folder of its own, and return the stored table.

    A kind is replaced as a whole; those of other names stay as they are.
    """
    rows = []
    for measurement, basis in bases.items():
        rows.append((measurement, 0, None, [float(v) for v in basis.mean]))
        for i, vector in enumerate(basis.vectors):
            eigval = None if basis.eigvals is None else float(basis.eigvals[i])
            rows.append((measurement, i + 1, eigval, [float(v) for v in vector]))
    table = spark.createDataFrame(rows, schemas.EIGENBASIS).coalesce(1)
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("measurement").parquet(path)
    return read_basis_table(spark, path)


def read_basis_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EIGENBASIS).parquet(path)


def top_basis(table: DataFrame, measurement: str, k: int) -> DataFrame:
    """The mean (component 0) and the first `k` eigenvectors of one measurement kind; other kinds' folders are not read."""
    return table.filter((F.col("measurement") == measurement) & (F.col("component") <= k))


def load_basis(table: DataFrame, measurement: str, k: int) -> Basis:
    """Those `k + 1` rows as a basis."""
    rows = {r["component"]: r for r in fetch(top_basis(table, measurement, k), k + 1)}
    missing = sorted(set(range(k + 1)) - set(rows))
    if missing:
        raise ValueError(f"eigenbasis of {measurement!r} lacks components {missing}")
    eigvals = [rows[i]["eigval"] for i in range(1, k + 1)]
    return Basis(
        mean=rows[0]["vector"],
        vectors=[rows[i]["vector"] for i in range(1, k + 1)],
        eigvals=None if any(v is None for v in eigvals) else eigvals,
    )
