import os
import subprocess
import sys

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corvane.functions import vectors as vx
from corvane.functions.vectors import Basis
from corvane.operators import decomposition as dc
from corvane.sources.tables import load_basis, save_basis, top_basis

DAYS = 12
MISSING = -999


def packed(values):
    return np.array([MISSING if v is None else v for v in values], dtype="<i2").tobytes()


@pytest.fixture(scope="module")
def sample():
    """Rows from two known orthonormal waves with noise; some days missing, one row all missing."""
    rng = np.random.default_rng(1)
    t = 2 * np.pi * np.arange(1, DAYS + 1) / DAYS
    waves = np.sqrt(2 / DAYS) * np.stack([np.cos(t), np.sin(t)])
    mean = 100 + 20 * np.sin(t / 2)
    rows = []
    for i in range(40):
        x = np.rint(mean + rng.normal(0, 60) * waves[0] + rng.normal(0, 25) * waves[1] + rng.normal(0, 3, DAYS))
        row = [int(v) for v in x]
        if i % 4 == 0:
            row[i % DAYS] = None
        rows.append(row)
    rows.append([None] * DAYS)
    return rows, waves, mean


@pytest.fixture
def frame(spark, sample):
    rows = [(i, bytearray(packed(r))) for i, r in enumerate(sample[0])] + [(99, None)]
    return spark.createDataFrame(rows, "id int, Values binary").repartition(3)


def decoded(df, scale=1.0):
    return df.withColumn("v", vx.decode_values(F.col("Values"), scale, MISSING))


def test_decode(frame, sample):
    found = {r["id"]: r["v"] for r in decoded(frame).collect()}
    expected = {i: [None if v is None else float(v) for v in row] for i, row in enumerate(sample[0])}
    assert found == {**expected, 99: None}
    halved = {r["id"]: r["v"] for r in decoded(frame, 0.5).collect()}
    assert halved[1] == [v * 0.5 for v in expected[1]]


def test_decode_byte_order_and_range(spark):
    df = spark.createDataFrame([(bytearray(b"\x01\x00\xff\xff\x00\x80\xff\x7f"),), (bytearray(),)], "v binary")
    assert [r[0] for r in df.select(vx.decode_values(F.col("v"))).collect()] == [[1.0, -1.0, -32768.0, 32767.0], []]
    with pytest.raises(Exception, match="even number of bytes"):
        spark.createDataFrame([(bytearray(b"abc"),)], "v binary").select(vx.decode_values(F.col("v"))).collect()


def test_decompose_against_numpy(frame, sample):
    rows, waves, mean = sample
    basis = Basis(mean.tolist(), waves.tolist())
    found = {r["id"]: r for r in dc.decompose(decoded(frame), "v", basis).collect()}
    for i, row in enumerate(rows):
        x = np.array([np.nan if v is None else v for v in row], dtype=float)
        d = np.nan_to_num(x - mean)
        c = waves @ d
        r = found[i]
        assert np.allclose([r["coeff_1"], r["coeff_2"]], c)
        if not d.any():
            assert (r["res_0"], r["res_1"], r["res_2"]) == (None, None, None)
            continue
        assert np.isclose(r["res_0"], d @ d / np.nansum(x * x))
        left1 = d - c[0] * waves[0]
        left2 = left1 - c[1] * waves[1]
        assert np.isclose(r["res_1"], left1 @ left1 / (d @ d))
        assert np.isclose(r["res_2"], left2 @ left2 / (d @ d))
        assert 1 >= r["res_1"] >= r["res_2"]
    assert found[99]["coeff_1"] is None and found[99]["res_0"] is None


def test_a_row_equal_to_the_mean_has_no_coefficients(spark):
    basis = Basis([1.0, 2.0], [[1.0, 0.0]])
    df = spark.createDataFrame([([1.0, 2.0],), ([0.0, 0.0],)], "v array<double>")
    a, b = dc.decompose(df, "v", basis).collect()
    assert (a["coeff_1"], a["res_0"], a["res_1"]) == (0.0, 0.0, None)
    assert (b["coeff_1"], b["res_0"], b["res_1"]) == (-1.0, None, 0.8)


def test_wrong_length_fails(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
    with pytest.raises(Exception, match="must have 2 values"):
        dc.decompose(df, "v", Basis([0.0, 0.0], [[1.0, 0.0]])).collect()
    with pytest.raises(ValueError):
        Basis([0.0, 0.0], [[1.0]])


def test_approximations(frame, sample):
    rows, waves, mean = sample
    basis = Basis(mean.tolist(), waves.tolist())
    split = dc.decompose(decoded(frame), "v", basis)
    steps = {(r["id"], r["k"], r["day"]): r["value"] for r in dc.approximations(split, ["id"], basis).collect()}
    coeffs = {r["id"]: (r["coeff_1"], r["coeff_2"]) for r in split.collect()}
    a, b = coeffs[1]
    for k, expected in enumerate([mean, mean + a * waves[0], mean + a * waves[0] + b * waves[1]]):
        assert np.allclose([steps[1, k, d] for d in range(1, DAYS + 1)], expected)


def test_fit_against_numpy(frame, sample):
    x = np.array([[np.nan if v is None else v for v in row] for row in sample[0]], dtype=float)
    mean = np.nanmean(x[:-1], axis=0)
    filled = np.where(np.isnan(x), mean, x)
    cov = np.cov(filled.T)
    rows = decoded(frame).filter("id < 99")
    found = np.zeros((DAYS, DAYS))
    for r in dc.covariance(rows, "v", mean.tolist()).collect():
        found[r["i"] - 1, r["j"] - 1] = r["cov"]
    assert np.allclose(found, cov)

    basis = dc.fit_basis(rows, "v")
    vectors, eigvals = np.array(basis.vectors), np.array(basis.eigvals)
    assert np.allclose(basis.mean, mean)
    assert np.allclose(vectors @ vectors.T, np.eye(DAYS))
    assert np.allclose(eigvals, np.linalg.eigvalsh(cov)[::-1])
    assert np.allclose(cov @ vectors[0], eigvals[0] * vectors[0])
    assert all(v[np.abs(v).argmax()] > 0 for v in vectors)
    assert dc.fit_basis(rows, "v", k=2).k == 2


def test_variance_explained(spark):
    eigvals = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate([5, 3, 1, 1])], "component int, eigval double")
    rows = {r["i"]: r["cumvar"] for r in dc.variance_explained(eigvals).collect()}
    assert rows == {0: 0.0, 1: 50.0, 2: 80.0, 3: 90.0, 4: 100.0}
    many = spark.createDataFrame([(i + 1, 1.0) for i in range(50)], "component int, eigval double")
    assert sorted(r["i"] for r in dc.variance_explained(many).collect()) == list(range(10))


def test_scaled_series(spark):
    rows = [(0, [1.0, 4.0, 2.0]), (1, [0.6, 0.8, 0.0])]
    df = spark.createDataFrame(rows, "component int, vector array<double>")
    found = {(r["component"], r["day"]): r["value"] for r in dc.scaled_series(df).collect()}
    assert np.allclose([found[0, d] for d in (1, 2, 3)], [0.05, 0.2, 0.1])
    assert [found[1, d] for d in (1, 2, 3)] == [0.6, 0.8, 0.0]


def test_selection_and_extremes(spark):
    rows = [(f"s{i:02d}", float(i), float(-i), 0.01 * i, 0.005 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "Station string, coeff_1 double, coeff_2 double, res_1 double, res_2 double")
    assert [r["coeff_1"] for r in dc.well_described(df, 1, below=0.05).collect()] == [0, 1, 2, 3, 4]
    second = dc.well_described(df, 2, below=0.11, above_previous=0.2).collect()
    assert [r["coeff_2"] for r in second] == [-21.0]
    ends = dc.extremes(df, "coeff_1", ["Station"], n=3).collect()
    assert sorted((r["side"], r["coeff_1"]) for r in ends) == [("high", 37), ("high", 38), ("high", 39), ("low", 0), ("low", 1), ("low", 2)]
    assert dc.highest(df, "coeff_2").first()["Station"] == "s00"


def test_projection_runs_once_with_decoding_inside(frame):
    basis = Basis([0.0] * DAYS, [[1.0] + [0.0] * (DAYS - 1)])
    split = dc.decompose(frame, vx.decode_values(F.col("Values")), basis)
    plan = plan_of(dc.well_described(split, 1, below=0.5))
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan
    assert plan_of(dc.day_means(frame, vx.decode_values(F.col("Values")))).count("ArrowEvalPython") == 1


def test_workers_need_not_have_the_package(tmp_path):
    """A session started elsewhere, with the package on the driver's path alone."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from corvane.functions.vectors import Basis, decode_values
from corvane.operators import decomposition as dc
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([(bytearray(b"\\x01\\x00\\x02\\x00"),), (bytearray(b"\\x03\\x00\\x02\\x00"),)], "Values binary")
values = decode_values(F.col("Values"))
basis = dc.fit_basis(df, values, 1)
split = dc.decompose(df, values, basis)
assert dc.approximations(split, [], basis).count() == 8
assert sorted(round(r["coeff_1"], 9) for r in split.collect()) == [-1, 1]
print("done")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]


def test_an_empty_day_has_no_part_in_the_basis(spark):
    rng = np.random.default_rng(4)
    rows = [([float(v) for v in rng.normal(size=2)] + [None, float(i % 3)],) for i in range(20)] + [(None,)]
    df = spark.createDataFrame(rows, "v array<double>")
    basis = dc.fit_basis(df, "v")
    assert basis.mean[2] == 0.0 and basis.eigvals[-1] == 0.0
    assert all(abs(v[2]) < 1e-12 for v in basis.vectors[:-1]) and abs(basis.vectors[-1][2]) == 1.0


def test_pairwise_covariance_counts_rows_with_both_days(spark):
    rows = [([1.0, 2.0, None],), ([3.0, None, None],), ([5.0, 8.0, 1.0],), (None,)]
    mean = [3.0, 5.0, 1.0]
    got = {(r.i, r.j): (r.n, r.cov) for r in dc.covariance(spark.createDataFrame(rows, "v array<double>"), "v", mean, pairwise=True).collect()}
    assert got[1, 1] == (3, 4.0) and got[1, 2] == got[2, 1] == (2, 12.0) and got[2, 2] == (2, 18.0)
    assert got[3, 3] == (1, 0.0) and got[1, 3] == (1, 0.0)
    plain = {(r.i, r.j): (r.n, r.cov) for r in dc.covariance(spark.createDataFrame(rows, "v array<double>"), "v", mean).collect()}
    assert plain[1, 2] == (3, 6.0)


def test_a_stored_basis_is_orthonormal_and_solves_the_eigenproblem(spark, tmp_path):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(rng.normal(size=6).tolist(),) for _ in range(50)], "v array<double>")
    basis = dc.fit_basis(df, "v")
    table = save_basis(spark, {"a": basis, "b": Basis([0.0], [[1.0]], [2.0])}, str(tmp_path / "basis"))
    mine = top_basis(table, "a", 6)
    assert "measurement=a" in str(mine.inputFiles()) and load_basis(table, "a", 6) == basis
    assert max(r.error for r in dc.eigen_errors(dc.covariance(df, "v", basis.mean), mine).collect()) < 1e-9
    assert all(abs(r["dot"] - (r["i"] == r["j"])) < 1e-9 for r in dc.gram(mine).collect())
    # A kind that is written again is replaced, the other stays.
    again = save_basis(spark, {"b": Basis([1.0], [[1.0]], [3.0])}, str(tmp_path / "basis"))
    assert load_basis(again, "b", 1).mean == [1.0] and load_basis(again, "a", 6) == basis
