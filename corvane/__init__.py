"""Analytics jobs on Spark DataFrames: collinear points, messages and measurement vectors."""
