"""Declared schemas; nothing is inferred."""

from pyspark.sql import types as T

LINES = T.StructType([T.StructField("value", T.StringType())])

POINTS = T.StructType(
    [
        T.StructField("x", T.LongType(), False),
        T.StructField("y", T.LongType(), False),
    ]
)

MESSAGES = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("text", T.StringType(), False),
    ]
)

USER_GROUPS = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("group_id", T.IntegerType(), False),
    ]
)

WEATHER = T.StructType(
    [
        T.StructField("Station", T.StringType(), False),
        T.StructField("Year", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("measurement", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("Values", T.BinaryType()),
    ]
)

# One row a component; component 0 carries the mean and has no eigenvalue.
EIGENBASIS = T.StructType(
    [
        T.StructField("measurement", T.StringType(), False),
        T.StructField("component", T.IntegerType(), False),
        T.StructField("eigval", T.DoubleType()),
        T.StructField("vector", T.ArrayType(T.DoubleType(), False), False),
    ]
)

CENTRES = T.StructType(
    [
        T.StructField("group_id", T.IntegerType(), False),
        T.StructField("c1", T.DoubleType(), False),
        T.StructField("c2", T.DoubleType(), False),
    ]
)
