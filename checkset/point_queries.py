"""Registered queries on points."""

from __future__ import annotations

from pyspark.sql import functions as F

from checkset.standins import POINTS_SQL, point_lines, points
from corvane.operators import points as pt
from corvane.plans.collinear import collinear_job

PAIRS_SQL = f"""WITH {POINTS_SQL},
places AS (SELECT DISTINCT x, y FROM points),
pairs AS (
  SELECT a.x AS ax, a.y AS ay, b.x AS bx, b.y AS "by",
         CASE WHEN a.x = b.x THEN 'Infinity'::DOUBLE ELSE CAST(b.y - a.y AS DOUBLE) / (b.x - a.x) + 0.0 END AS slope
  FROM places a JOIN places b ON a.x <> b.x OR a.y <> b.y)"""

# Slopes as reduced fractions, as doubles do not tell all of these apart.
GROUPS_SQL = f"""{PAIRS_SQL},
units AS (SELECT *, (bx - ax) // gcd(bx - ax, "by" - ay) * CASE WHEN bx < ax OR (bx = ax AND "by" < ay) THEN -1 ELSE 1 END AS ux,
                 ("by" - ay) // gcd(bx - ax, "by" - ay) * CASE WHEN bx < ax OR (bx = ax AND "by" < ay) THEN -1 ELSE 1 END AS uy FROM pairs)"""

# Every anchor's set with its points in order, by an ordinary grouping of pairs.
SETS_SQL = f"""{GROUPS_SQL},
with_anchor AS (SELECT ax, ay, ux, uy, slope, bx AS x, "by" AS y FROM units UNION SELECT ax, ay, ux, uy, slope, ax, ay FROM units),
sets AS (
  SELECT ax, ay, any_value(slope) AS slope, count(*) AS n_points, string_agg(x || ':' || y, ';' ORDER BY x, y) AS points
  FROM with_anchor GROUP BY ax, ay, ux, uy HAVING count(*) >= 3)"""

# Lines by direction in lowest terms and exact offset, their points by an ordinary grouping of pairs.
LINES_SQL = f"""{GROUPS_SQL},
members AS (SELECT DISTINCT ux, uy, ux * ay - uy * ax AS c, ax AS x, ay AS y FROM units),
lines AS (
  SELECT *, count(*) OVER (PARTITION BY ux, uy, c) AS n_points, row_number() OVER (PARTITION BY ux, uy, c ORDER BY x, y) AS position,
         CASE WHEN ux = 0 THEN 'Infinity'::DOUBLE ELSE CAST(uy AS DOUBLE) / ux + 0.0 END AS slope,
         CASE WHEN ux = 0 THEN CAST(x AS DOUBLE) ELSE CAST(c AS DOUBLE) / ux + 0.0 END AS intercept
  FROM members QUALIFY n_points >= 3)"""


def _text(points):
    pair = F.transform(points, lambda p: F.concat_ws(":", p["x"], p["y"]))
    return F.array_join(pair, ";").alias(points)


def _anchor_sets(spark, sf_dir):
    return pt.anchor_sets(pt.anchor_groups(pt.point_rays(points(spark, sf_dir), least=2)))


def p01_parse(spark, sf_dir):
    return pt.parse_points(point_lines(spark, sf_dir))


def p02_pairs(spark, sf_dir):
    return pt.ordered_pairs(points(spark, sf_dir))


def p03_slope(spark, sf_dir):
    return pt.with_slope(pt.ordered_pairs(points(spark, sf_dir)))


def p04_anchor_groups(spark, sf_dir):
    groups = pt.anchor_groups(pt.point_rays(points(spark, sf_dir)))
    return groups.select("ax", "ay", "slope", "n_others", _text("others"))


def p05_min3(spark, sf_dir):
    return _anchor_sets(spark, sf_dir).select("ax", "ay", "slope", "n_points", _text("points"))


def p06_sorted(spark, sf_dir):
    sets = pt.sort_points(_anchor_sets(spark, sf_dir))
    return sets.select("ax", "ay", "slope", "n_points", _text("points"))


def p07_distinct_sets(spark, sf_dir):
    sets = pt.distinct_sets(pt.sort_points(_anchor_sets(spark, sf_dir)))
    return sets.select(_text("points"))


def p08_collinear(spark, sf_dir):
    return collinear_job(point_lines(spark, sf_dir)).select("slope", "intercept", "n_points", "x", "y")


def p09_line_params(spark, sf_dir):
    lines = pt.distinct_lines(pt.lines_through_points(points(spark, sf_dir)))
    exact = [F.col(f"line.{c}").cast("bigint").alias(c) for c in ("dx", "dy", "offset")]
    return lines.select("slope", "intercept", *exact)


def p10_set_differences(spark, sf_dir):
    """The sets of all points that change when every third column is left out, and those that come up instead."""
    some = points(spark, sf_dir)
    lines = [pt.lines_through_points(df) for df in (some, some.filter("x % 3 <> 0"))]
    found = pt.set_differences(*lines)
    return found.select("side", F.concat_ws(" ", "line.dx", "line.dy", "line.offset").alias("line"), "n_points")


QUERIES = {
    f.__name__: f
    for f in (
        p01_parse,
        p02_pairs,
        p03_slope,
        p04_anchor_groups,
        p05_min3,
        p06_sorted,
        p07_distinct_sets,
        p08_collinear,
        p09_line_params,
        p10_set_differences,
    )
}

SQL = {
    "p01_parse": f"WITH {POINTS_SQL} SELECT x, y FROM points",
    "p02_pairs": f'{PAIRS_SQL} SELECT ax, ay, bx, "by" FROM pairs',
    "p03_slope": f'{PAIRS_SQL} SELECT ax, ay, bx, "by", slope FROM pairs',
    "p04_anchor_groups": f"""{GROUPS_SQL}
SELECT ax, ay, any_value(slope) AS slope, count(*) AS n_others, string_agg(bx || ':' || "by", ';' ORDER BY bx, "by") AS others
FROM units GROUP BY ax, ay, ux, uy""",
    "p05_min3": f"""{GROUPS_SQL}
SELECT ax, ay, any_value(slope) AS slope, count(*) + 1 AS n_points,
       string_agg(bx || ':' || "by", ';' ORDER BY bx, "by") || ';' || ax || ':' || ay AS points
FROM units GROUP BY ax, ay, ux, uy HAVING count(*) >= 2""",
    "p06_sorted": f"{SETS_SQL} SELECT ax, ay, slope, n_points, points FROM sets",
    "p07_distinct_sets": f"{SETS_SQL} SELECT DISTINCT points FROM sets",
    "p08_collinear": f"{LINES_SQL} SELECT slope, intercept, n_points, x, y FROM lines",
    "p09_line_params": f'{LINES_SQL} SELECT DISTINCT slope, intercept, ux AS dx, uy AS dy, c AS "offset" FROM lines',
    "p10_set_differences": f"""{LINES_SQL},
held AS (SELECT ux, uy, c, count(*) AS n_all, count(*) FILTER (x % 3 <> 0) AS n_some FROM lines GROUP BY ux, uy, c),
named AS (SELECT ux || ' ' || uy || ' ' || c AS line, n_all, n_some FROM held WHERE n_all <> n_some)
SELECT 'a' AS side, line, n_all AS n_points FROM named UNION ALL SELECT 'b', line, n_some FROM named WHERE n_some >= 3""",
}
