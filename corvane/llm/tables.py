"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names: whatever else a table holds cannot clash."""
    return df.select(*(df[old].alias(new) for new, old in columns.items()))
