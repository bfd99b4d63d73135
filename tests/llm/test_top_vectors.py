import math
import random

import numpy as np
import pytest

from corvane.llm import top_vectors as tv

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, score string, vector int"


def brute(rows, k, every, scale=256):
    """All scores with Python's integers."""
    fits = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = {(i, tuple(math.floor(scale * float(np.float32(x))) for x in v)) for i, v in fits}
    packed = lambda v: np.array(v, "<i4").tobytes()
    asks = {}
    for i, v in ints:
        if i % every == 0 and (i not in asks or packed(v) < packed(asks[i])):
            asks[i] = v
    out = []
    for i, q in asks.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ints if j != i and len(v) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, k=5, every=5, **options):
    df = spark.createDataFrame([(i, v, 1, "c", "s", 2) for i, v in rows], SCHEMA)
    found = tv.top_vectors(df, f"vec_id % {every} = 0", k=k, **options)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("QUERY_ROWS", 8), ("STEP", 3), ("SAMPLE_ROWS", 40)):
        monkeypatch.setattr(tv, name, value)


def test_clusters_against_brute_force(spark, small_blocks):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), (centres[i % 6] + 0.05 * rng.normal(size=8)).tolist()) for i in rng.permutation(150)]
    assert run(spark, rows, pivots=6) == brute(rows, 5, 5)


def test_a_hot_vector_and_ties(spark, small_blocks):
    rows = [(i, [0.5, 0.5]) for i in range(60)] + [(i, [float(i % 3), 0.25]) for i in range(60, 90)]
    assert run(spark, rows, k=4, pivots=3) == brute(rows, 4, 5)


def test_nulls_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-1.0, 2.0]), (1, None), (5, [nan, 1.0]), (5, [1.0, inf]), (10, [None, 1.0]), (None, [9.0, 9.0])]
    rows += [(15, [1.0]), (16, [2.0]), (17, [1.0, 1.0]), (20, []), (21, []), (25, [-3.5, 0.001]), (30, [7.0, 7.0, 7.0])]
    got = run(spark, rows)
    assert got == brute(rows, 5, 5)
    assert {r[0] for r in got} == {0, 15, 20, 25}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**22 + 1 + i, -(2.0**21), 3.0 * i]) for i in range(12)]
    assert run(spark, rows, k=3) == brute(rows, 3, 5)
    assert tv.exact_scores(np.array([2.0**31 - 1, 1]), np.array([[2.0**30 + 1, 5]])).tolist() == [(2**31 - 1) * (2**30 + 1) + 5]
    with pytest.raises(OverflowError):
        tv.exact_scores(np.full(8, 2.0**31 - 1), np.full((1, 8), 2.0**31 - 1))


def test_the_search_stops_early_and_misses_nothing():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16)) * 4
    x = np.floor(256 * (centres[rng.integers(0, 20, 3000)] + 0.1 * rng.normal(size=(3000, 16))))
    pivots = tv.far_apart(x, 24)
    table, norms, ids = tv.distances(x, pivots), (x * x).sum(axis=1), np.arange(3000)
    looked = 0
    for i in range(0, 3000, 100):
        apart = np.abs(table - table[i]).max(axis=1)
        found, done = tv.best_of_block(x[i], i, float("-inf"), x, ids, norms, apart, 5)
        scores = x @ x[i]
        expected = sorted((-int(s), j) for j, s in enumerate(scores) if j != i)[:5]
        assert found == expected
        assert (tv.most(norms[i], norms, apart) >= scores).all()
        looked += done
    assert looked < 0.5 * 30 * 3000


def test_random_bounds_hold():
    rng = random.Random(5)
    for _ in range(200):
        q, x, p = (np.array([[rng.randrange(-300, 300) for _ in range(4)]], "f8") for _ in range(3))
        apart = abs(tv.distances(q, p)[0, 0] - tv.distances(x, p)[0, 0])
        assert tv.most((q * q).sum(), (x * x).sum(), apart) >= (q * x).sum()
