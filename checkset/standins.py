"""Inputs of the jobs, derived from the given tables; every row of those is used."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.vectors import Basis
from checkset.spread import spread

# Days of a month; a month without a 31st has no value there.
DAYS = 31
MISSING = -9999


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- points ---------------------------------------------------------------


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a point, some of them far out: past 1e6 along y, past 2**25 along x. Points repeat."""
    k, size = F.col("p_partkey") % 40, F.col("p_size").cast("bigint")
    return table(spark, sf_dir, "part").select(
        F.when(k >= 32, k * 40_000_000).otherwise(k).cast("bigint").alias("x"),
        F.when(k % 8 == 3, size * 3_000_000).otherwise(size).alias("y"),
    )


def point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).select(F.concat_ws(" ", "x", "y").alias("value"))


POINTS_SQL = """points AS (
  SELECT CASE WHEN p_partkey % 40 >= 32 THEN p_partkey % 40 * 40000000 ELSE p_partkey % 40 END::BIGINT AS x,
         CASE WHEN p_partkey % 8 = 3 THEN p_size::BIGINT * 3000000 ELSE p_size END::BIGINT AS y
  FROM part)"""

# --- messages -------------------------------------------------------------


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a message; seven consecutive ones share an author."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(F.expr("CAST(doc_id DIV 7 AS STRING)").alias("user_id"), "text")


def user_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as grouped users; fewer than there are authors, so some have no group."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("user_id"), (F.col("s_nationkey") % 7).cast("int").alias("group_id")
    )


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON line per document. The lines of some sources have a flaw each:

    src0 a notice without `created_at`, src1 cut short, src2 a null
    `created_at` (no flaw to the job), src3 no author id, src4 junk behind.
    """
    source = F.col("source")
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    author = F.expr("CAST(doc_id DIV 7 AS STRING)")
    message = F.to_json(
        F.struct(
            F.when(source != "src2", F.lit("Mon Jan 01 00:00:00 +0000 2024")).alias("created_at"),
            F.col("doc_id").cast("string").alias("id_str"),
            "text",
            F.when(source != "src3", F.struct(author.alias("id_str"), F.lit("a b").alias("name"))).alias("user"),
        ),
        {"ignoreNullFields": "false"},
    )
    notice = F.to_json(F.struct(F.struct(F.col("doc_id").alias("track")).alias("limit")))
    return docs.select(
        F.when(source == "src0", notice)
        .when(source == "src1", F.substring(message, F.lit(1), F.length(message) - 2))
        .when(source == "src4", F.concat(message, F.lit(" {}")))
        .otherwise(message)
        .alias("value")
    )


MESSAGES_SQL = "messages AS (SELECT CAST(doc_id // 7 AS VARCHAR) AS user_id, text FROM documents)"
VALID_MESSAGES_SQL = """
messages AS (SELECT CAST(doc_id // 7 AS VARCHAR) AS user_id, text FROM documents
             WHERE source NOT IN ('src0', 'src1', 'src3', 'src4'))"""
GROUPS_SQL = """
user_groups AS (SELECT CAST(s_suppkey AS VARCHAR) AS user_id, CAST(s_nationkey % 7 AS INTEGER) AS group_id
                FROM supplier)"""

# --- measurement vectors --------------------------------------------------


def day_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`user_id, measurement, day, v`: the mean event value of a day in whole tenths (cut off, so exact)."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.col("event_type").alias("measurement"), F.dayofmonth("ts").alias("day"))
        .agg(F.call_function("div", F.sum(cents), F.count("*") * 10).cast("int").alias("v"))
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and event type, with a month of values packed as little-endian int16.

    A row gathers at most one value per day of the month.
    """
    days = F.map_from_entries(F.collect_list(F.struct("day", "v")))

    def pack(day):
        number = F.pmod(F.coalesce(F.try_element_at("days", day), F.lit(MISSING)), F.lit(65536))
        digits = F.lpad(F.hex(number), 4, "0")
        return F.concat(F.substring(digits, 3, 2), F.substring(digits, 1, 2))

    packed = F.unhex(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(DAYS)), pack), ""))
    rows = day_values(spark, sf_dir).groupBy("user_id", "measurement").agg(days.alias("days"))
    homes = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.join(homes, F.col("user_id") == F.col("c_custkey")).select(
        F.concat(F.lit("ST"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("Station"),
        F.lit(2024).alias("Year"),
        F.col("n_name").alias("country"),
        "measurement",
        (F.col("c_acctbal") / 100).alias("latitude"),
        (F.col("c_nationkey") + 70).cast("double").alias("longitude"),
        packed.alias("Values"),
    )


def wave_basis(mean: list[float]) -> Basis:
    """The mean with one cosine and one sine over the month: orthonormal, and plain SQL can compute it."""
    size = math.sqrt(2 / DAYS)
    turn = [2 * math.pi * d / DAYS for d in range(1, DAYS + 1)]
    return Basis(mean, [[size * math.cos(t) for t in turn], [size * math.sin(t) for t in turn]])


WEATHER_SQL = f"""
day_values AS (
  SELECT user_id, event_type AS measurement, CAST(day(ts) AS INTEGER) AS day,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) // (10 * count(*)) AS INTEGER) AS v
  FROM events GROUP BY ALL),
weather AS (
  SELECT DISTINCT user_id, 'ST' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS Station, measurement,
         n_name AS country, c_acctbal / 100 AS latitude, CAST(c_nationkey + 70 AS DOUBLE) AS longitude
  FROM day_values JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
means AS (SELECT day, avg(v) AS mean FROM day_values GROUP BY day),
basis AS (
  SELECT CAST(d AS INTEGER) AS day, coalesce(mean, 0) AS mean, sqrt(2.0 / {DAYS}) * cos(2 * pi() * d / {DAYS}) AS v1,
         sqrt(2.0 / {DAYS}) * sin(2 * pi() * d / {DAYS}) AS v2
  FROM range(1, {DAYS + 1}) AS t(d) LEFT JOIN means ON means.day = d),
grid AS (
  SELECT w.*, b.day, d.v, b.mean, b.v1, b.v2, coalesce(d.v - b.mean, 0) AS c
  FROM weather w CROSS JOIN basis b
  LEFT JOIN day_values d ON d.user_id = w.user_id AND d.measurement = w.measurement AND d.day = b.day),
coeffs AS (
  SELECT Station, measurement, country, latitude, longitude, sum(c * v1) AS coeff_1, sum(c * v2) AS coeff_2,
         sum(c * c) AS cc, sum(v * v) AS vv
  FROM grid GROUP BY ALL),
decomposed AS (
  SELECT k.Station, k.measurement, k.country, k.latitude, k.longitude, coeff_1, coeff_2,
         cc / nullif(vv, 0) AS res_0,
         sum((c - coeff_1 * v1) ^ 2) / nullif(cc, 0) AS res_1,
         sum((c - coeff_1 * v1 - coeff_2 * v2) ^ 2) / nullif(cc, 0) AS res_2
  FROM grid g JOIN coeffs k ON k.Station = g.Station AND k.measurement = g.measurement
  GROUP BY k.Station, k.measurement, k.country, k.latitude, k.longitude, coeff_1, coeff_2, cc, vv)"""
