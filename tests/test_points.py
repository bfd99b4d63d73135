import itertools
import math
import random
from collections import Counter

import pytest
from conftest import plan_of

from corvane import schemas
from corvane.operators import points as pt
from corvane.plans.collinear import collinear_file, collinear_job
from corvane.sources.fetch import fetch
from corvane.sources.lines import lines_from, rows_to_frame

# Small inputs whose lines are known.
NINE = [(1, 1), (0, 1), (2, 2), (3, 3), (0, 5), (3, 4), (5, 6), (0, -3), (-2, -2)]
EIGHT = [(4, -2), (2, -1), (-3, 4), (6, 3), (-9, 4), (6, -3), (8, -4), (6, 9)]
# An input whose number of lines is known.
FORTY = """0 2
0 5
0 7
0 8
1 0
1 1
1 2
1 3
1 5
1 8
2 4
2 5
3 3
3 6
4 3
4 5
4 6
5 0
5 2
5 7
5 9
6 0
6 1
6 9
7 2
7 4
7 6
7 8
8 9
9 5
0 3
0 4
1 6
2 0
3 1
6 5
7 3
8 1
9 3
9 4
"""

# An input whose number of lines is known, in its own order.
EIGHTY_FIVE = [
    (0, 1), (0, -10), (0, 3), (0, -4), (0, 5), (0, 7), (0, -7), (-10, -1), (-10, 2), (-10, 7), (-10, -7), (1, -3),
    (-1, 5), (1, -6), (-1, -9), (-2, 1), (-2, -1), (-2, -10), (2, 2), (-2, 5), (2, 5), (2, 6), (2, -6), (-2, 7),
    (-2, 9), (-2, -9), (2, 9), (-3, 0), (-3, -10), (3, -10), (3, -4), (3, -5), (3, -7), (-3, 8), (3, 8), (3, 9),
    (4, -10), (4, 4), (-4, 6), (-4, -6), (4, -6), (-5, -1), (5, -1), (5, -10), (-5, 4), (5, -5), (-5, -6), (5, 6),
    (-5, 7), (-5, -8), (5, -8), (5, -9), (-6, 2), (-6, -2), (6, -3), (6, 4), (-6, -8), (-6, -9), (-7, 1), (-7, -1),
    (7, -1), (-7, 4), (7, -4), (8, -10), (-8, -2), (-8, -7), (8, -7), (8, 8), (-9, -3), (9, 3), (-9, 9), (0, -8),
    (0, 9), (3, 5), (-3, 7), (5, 2), (-6, -3), (6, -5), (7, 2), (7, 6), (7, 7), (7, -7), (-7, -8), (-9, 8),
    (9, -4),
]


def frame(spark, rows):
    return rows_to_frame(spark, rows, schemas.POINTS)


def sets_of(members):
    """The sets of a table of line points, whose positions must be their order."""
    found = {}
    for r in members.collect():
        found.setdefault((tuple(r["line"]), r["slope"], r["intercept"], r["n_points"]), []).append((r["position"], r["x"], r["y"]))
    assert len(found) == len({line for line, *_ in found})
    sets = set()
    for (_, _, _, n), rows in found.items():
        rows = sorted(rows)
        assert [r[0] for r in rows] == list(range(1, n + 1))
        sets.add(tuple(r[1:] for r in rows))
    assert all(list(line) == sorted(line) for line in sets)
    return sets


def brute_force(rows):
    """All maximal collinear sets, by cross products over every pair."""
    rows = sorted(set(rows))
    lines = set()
    for (ax, ay), (bx, by) in itertools.combinations(rows, 2):
        line = tuple(p for p in rows if (bx - ax) * (p[1] - ay) == (by - ay) * (p[0] - ax))
        if len(line) >= 3:
            lines.add(line)
    return lines


@pytest.fixture(params=["together", "dealt out"], autouse=True)
def held(request, monkeypatch):
    """Every test runs with all directions of a block at once, and with blocks of one anchor and several classes."""
    if request.param == "dealt out":
        monkeypatch.setattr(pt, "RAYS_HELD", 30)
    return request.param


def job(spark, rows):
    return pt.lines_through_points(frame(spark, rows))


def test_parse_reads_integers_and_any_spacing(spark):
    lines = lines_from(spark, ["1 2", "  -3\t4 ", "5   -6", "7 8 9"])
    assert [tuple(r) for r in pt.parse_points(lines).collect()] == [(1, 2), (-3, 4), (5, -6), (7, 8)]


@pytest.mark.parametrize("bad", ["1", "", "a b", "1.5 2"])
def test_parse_fails_on_other_lines(spark, bad):
    with pytest.raises(Exception):
        pt.parse_points(lines_from(spark, [bad])).collect()


def test_pairs_are_both_orders_without_self_pairs(spark):
    pairs = pt.ordered_pairs(frame(spark, [(1, 0), (2, 0), (3, 0)]))
    found = {((r["ax"], r["ay"]), (r["bx"], r["by"])) for r in pairs.collect()}
    assert found == set(itertools.permutations([(1, 0), (2, 0), (3, 0)], 2))


@pytest.mark.parametrize(
    "b, expected", [((-7, -2), 0.5), ((3, 4), 1.0), ((1, 5), math.inf), ((2, 5), 3.0), ((9, 2), 0.0), ((-9, 2), 0.0)]
)
def test_slope(spark, b, expected):
    pairs = spark.createDataFrame([(1, 2, *b)], "ax bigint, ay bigint, bx bigint, by bigint")
    slope = pt.with_slope(pairs).first()["slope"]
    assert slope == expected and math.copysign(1, slope) == 1


def test_known_sets(spark):
    assert sets_of(job(spark, NINE)) == {
        ((-2, -2), (1, 1), (2, 2), (3, 3)),
        ((0, 1), (3, 4), (5, 6)),
        ((0, -3), (0, 1), (0, 5)),
    }
    assert sets_of(job(spark, EIGHT)) == {
        ((6, -3), (6, 3), (6, 9)),
        ((2, -1), (4, -2), (6, -3), (8, -4)),
    }


def test_forty_points_from_a_file(spark, tmp_path):
    path = tmp_path / "points.txt"
    path.write_text(FORTY)
    found = sets_of(collinear_file(spark, str(path)))
    assert len(found) == 65
    assert found == brute_force([tuple(map(int, p.split())) for p in FORTY.splitlines()])


def test_eighty_five_points(spark):
    found = sets_of(job(spark, EIGHTY_FIVE))
    assert len(EIGHTY_FIVE) == 85 and len(found) == 252
    assert found == brute_force(EIGHTY_FIVE)


def test_duplicates_do_not_make_a_line(spark):
    assert sets_of(collinear_job(lines_from(spark, ["0 0", "0 0", "1 5", "1 5"]))) == set()
    assert sets_of(job(spark, NINE + NINE)) == brute_force(NINE)


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, 1), (2, 2)]])
def test_too_few_points(spark, rows):
    assert sets_of(job(spark, rows)) == set()


def random_points(seed, n, low, high):
    rng = random.Random(seed)
    return [(rng.randint(low, high), rng.randint(low, high)) for _ in range(n)]


def test_random_points_match_brute_force(spark):
    rows = random_points(5, 70, -6, 6)
    expected = brute_force(rows)
    assert sets_of(job(spark, rows)) == expected
    by_anchor = pt.anchor_sets(pt.anchor_groups(pt.point_rays(frame(spark, rows))))
    # Seen from every anchor, a line of k points comes k times, each time with the same ends.
    ends = Counter((r["n_points"], tuple(r["first"]), tuple(r["last"])) for r in by_anchor.collect())
    assert ends == Counter((len(line), line[0], line[-1]) for line in expected for _ in line)
    assert pt.distinct_lines(job(spark, rows)).count() == len(expected)


def test_groups_hold_what_an_anchor_sees(spark):
    rows = random_points(4, 30, -3, 3)
    got = {(r["ax"], r["ay"], r["dx"], r["dy"]): (r["n_others"], tuple(r["first"]), tuple(r["last"])) for r in pt.anchor_groups(pt.point_rays(frame(spark, rows))).collect()}
    seen = {}
    for (ax, ay), (bx, by) in itertools.permutations(sorted(set(rows)), 2):
        g = math.gcd(bx - ax, by - ay) * (-1 if (bx, by) < (ax, ay) else 1)
        seen.setdefault((ax, ay, (bx - ax) // g, (by - ay) // g), []).append((bx, by))
    assert got == {key: (len(others), min(others), max(others)) for key, others in seen.items()}


def test_sets_follow_an_affine_map(spark):
    rows = random_points(6, 40, 0, 7)

    def moved(p):
        return (2 * p[0] - 3 * p[1] + 11, p[0] + p[1] - 5)

    expected = {tuple(sorted(map(moved, line))) for line in sets_of(job(spark, rows))}
    assert sets_of(job(spark, [moved(p) for p in rows])) == expected


def test_a_third_of_the_points_on_one_line(spark):
    rows = [(i, 2 * i) for i in range(60)] + random_points(7, 120, -200, 200)
    assert sets_of(job(spark, rows)) == brute_force(rows)


def test_large_coordinates_are_told_apart_exactly(spark):
    base = 1 << 40
    # Slopes 1 and 1 + 2**-55 or so: equal as doubles.
    near = [(0, 0), (base, base), (2 * base, 2 * base), (3 * base, 3 * base + 1), (-base, -base)]
    assert sets_of(job(spark, near)) == brute_force(near)
    grid = [(x * base + 7, y * base - 3) for x, y in random_points(8, 40, 0, 6)]
    assert sets_of(job(spark, grid)) == brute_force(grid)


def test_coordinates_out_of_range_are_refused(spark):
    with pytest.raises(Exception, match="below 2"):
        job(spark, [(1 << 62, 0), (0, 0), (1, 1)]).collect()


def test_points_far_apart_stay_in_one_set(spark):
    rows = [(0, 0), (3_000_000, 3_000_000), (6_000_000, 6_000_000)]
    assert sets_of(job(spark, rows)) == brute_force(rows) == {tuple(rows)}


def test_the_same_columns_at_any_range(spark):
    assert job(spark, NINE).schema == job(spark, [(1 << 61, 0), (0, 0), (-(1 << 61), 0)]).schema
    assert sets_of(job(spark, [(1 << 61, 0), (0, 0), (-(1 << 61), 0)])) == {((-(1 << 61), 0), (0, 0), (1 << 61, 0))}


def test_same_sets(spark):
    a, b = job(spark, NINE), job(spark, list(reversed(NINE)) + NINE[:3])
    assert pt.same_sets(a, b) and pt.set_differences(a, b).isEmpty()
    c = job(spark, [p for p in NINE if p != (-2, -2)])
    assert not pt.same_sets(a, c)
    # The line through (-2, -2) is shorter without it; the others are the same.
    assert sorted((r["side"], r["n_points"]) for r in pt.set_differences(a, c).collect()) == [("a", 4), ("b", 3)]


def test_lines_come_without_a_join_or_a_row_for_a_pair(spark):
    plan = plan_of(job(spark, NINE))
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert plan.count("MapInArrow") == 2


def test_pairs_meet_on_a_grid(spark, monkeypatch):
    monkeypatch.setattr(pt, "PAIRS_PER_BLOCK", 4)
    rows = random_points(3, 25, 0, 9)
    pairs = pt.ordered_pairs(frame(spark, rows))
    assert sorted(tuple(r) for r in pairs.collect()) == sorted((*a, *b) for a, b in itertools.permutations(set(rows), 2))
    assert "CartesianProduct" not in plan_of(pairs) and "NestedLoopJoin" not in plan_of(pairs)


@pytest.mark.parametrize("rows", [[0, 1, 2], [5], []])
def test_fetch_keeps_to_its_bound(spark, rows):
    df = spark.createDataFrame([(i,) for i in rows], "i long")
    assert sorted(r.i for r in fetch(df, len(rows))) == rows
    with pytest.raises(ValueError, match="stated"):
        fetch(df.unionByName(spark.createDataFrame([(9,)], "i long")), len(rows))


def seen_groups(rows):
    """The points that each anchor sees in one direction, by brute force."""
    seen = {}
    for (ax, ay), (bx, by) in itertools.permutations(sorted(set(rows)), 2):
        g = math.gcd(bx - ax, by - ay) * (-1 if (bx, by) < (ax, ay) else 1)
        seen.setdefault((ax, ay, (bx - ax) // g, (by - ay) // g), []).append((bx, by))
    return seen


def test_groups_list_all_their_points(spark):
    rows = random_points(9, 40, -4, 4) + [(1 << 40, 3 << 40), (-(1 << 40), -(3 << 40)), (0, 0)]
    got = {(r["ax"], r["ay"], r["dx"], r["dy"]): list(map(tuple, r["others"])) for r in pt.anchor_groups(pt.point_rays(frame(spark, rows))).collect()}
    assert got == {key: sorted(others) for key, others in seen_groups(rows).items()}


def test_sets_of_an_anchor_hold_all_points_and_the_anchor_last(spark):
    rows = random_points(10, 40, -4, 4)
    sets = pt.anchor_sets(pt.anchor_groups(pt.point_rays(frame(spark, rows), least=2)))
    got = {(r["ax"], r["ay"], r["dx"], r["dy"]): list(map(tuple, r["points"])) for r in sets.collect()}
    assert got == {key: [*sorted(others), key[:2]] for key, others in seen_groups(rows).items() if len(others) >= 2}


def test_sorted_sets_come_from_every_anchor(spark):
    rows = random_points(11, 40, -4, 4)
    sets = pt.sort_points(pt.anchor_sets(pt.anchor_groups(pt.point_rays(frame(spark, rows)))))
    got = Counter(((r["ax"], r["ay"]), tuple(map(tuple, r["points"]))) for r in sets.collect())
    assert got == Counter((p, line) for line in brute_force(rows) for p in line)


def test_distinct_sets_list_their_points_once(spark):
    rows = random_points(12, 60, -5, 5)
    sets = pt.distinct_sets(pt.sort_points(pt.anchor_sets(pt.anchor_groups(pt.point_rays(frame(spark, rows), least=2)))))
    got = Counter(tuple(map(tuple, r["points"])) for r in sets.collect())
    assert got == Counter(brute_force(rows))


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, 1), (2, 2)]])
def test_too_few_points_make_no_set(spark, rows):
    groups = pt.anchor_groups(pt.point_rays(frame(spark, rows)))
    assert groups.count() == max(0, 2 * (len(rows) - 1)) and pt.anchor_sets(groups).isEmpty()
