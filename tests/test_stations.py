import numpy as np
import pytest
from conftest import plan_of

from corvane import schemas
from corvane.functions.vectors import Basis
from corvane.operators import profiles as pf
from corvane.operators import stations as st
from corvane.operators.ordering import with_position
from corvane.plans.weather_report import weather_report
from corvane.sources import tables
from corvane.sources.lines import rows_to_frame
from corvane.sources.results import ResultStore


@pytest.mark.parametrize(
    "c1, c2, group",
    [
        (501.83, 56.07, 2),
        (440.25, -10.41, 2),
        (269.62, 135.32, 2),
        (318.56, -95.62, 2),
        (428.89, -43.88, 2),
        (-125.0, -125.0, 0),  # as near to 0 as to 1
        (500.0, 200.0, 2),  # as near to 2 as to 3
        (-1500.0, 500.0, 5),
        (None, 1.0, None),
    ],
)
def test_nearest_centre(spark, c1, c2, group):
    df = spark.createDataFrame([(c1, c2)], "coeff_1 double, coeff_2 double")
    assert st.with_nearest_group(df).first()["group"] == group


@pytest.fixture
def decomposed(spark):
    rows = [("b", 10.0, 1.0, 77.0, 14.0), ("b", 20.0, 3.0, 77.0, 14.0), ("a", 500.0, 390.0, 80.0, 8.0)]
    return spark.createDataFrame(rows, "Station string, coeff_1 double, coeff_2 double, Longitude double, Latitude double")


def test_stations_equal_the_join_of_means_and_counts(spark, tmp_path, decomposed):
    store = ResultStore(spark, str(tmp_path))
    ours = with_position(st.stations(decomposed), ["Station"], store, "stations").orderBy("position").drop("position")
    assert ours.columns == ["Station", "coeff_1", "coeff_2", "Longitude", "Latitude", "count"]
    assert [tuple(r) for r in ours.collect()] == [("a", 500.0, 390.0, 80.0, 8.0, 1), ("b", 15.0, 2.0, 77.0, 14.0, 2)]
    joined = st.station_means(decomposed).join(st.station_counts(decomposed), "Station").orderBy("Station")
    assert [tuple(r) for r in joined.collect()] == [tuple(r) for r in ours.collect()]


def test_map_layers(decomposed):
    grouped = st.with_nearest_group(st.stations(decomposed))
    assert tuple(st.bounding_box(grouped).first()) == (8.0, 77.0, 14.0, 80.0, 11.0, 78.5)
    rows = {r["lat"]: tuple(r) for r in st.markers(grouped).collect()}
    assert rows == {8.0: (8.0, 80.0, 4800, "green"), 14.0: (14.0, 77.0, 6788, "red")}
    sizes = {r["group_id"]: r["n_stations"] for r in st.centre_sizes(grouped).collect()}
    assert sizes == {0: 1, 1: 0, 2: 0, 3: 1, 4: 0, 5: 0, 6: 0}


def test_assignment_needs_no_join(decomposed):
    assert "Join" not in plan_of(st.with_nearest_group(decomposed))


def test_profile_skips_missing_days(spark):
    rows = [("a", 0, [1.0, None, 3.0]), ("a", 0, [3.0, None, 5.0]), ("b", 2, [7.0, 8.0, None]), ("c", 4, None)]
    df = spark.createDataFrame(rows, "Station string, group int, values array<double>")
    profile = pf.profile(df)
    found = {(r["group_id"], r["day"]): r["value"] for r in profile.collect()}
    assert found == {(0, 1): 2.0, (0, 3): 4.0, (2, 1): 7.0, (2, 2): 8.0}
    vectors = {r["group_id"]: r["values"] for r in pf.profile_vectors(profile, 3).collect()}
    assert vectors == {0: [2.0, None, 4.0], 2: [7.0, 8.0, None]}


DAYS = 8
WAVES = np.array([np.ones(DAYS), np.tile([1.0, -1.0], DAYS // 2)]) / np.sqrt(DAYS)


def weather_rows():
    """Four stations around known coefficients, one of them with most of the rows."""
    rng = np.random.default_rng(2)
    centre = {"S1": (0, 0), "S2": (500, 0), "S3": (500, 400), "S4": (-200, 100)}
    rows = []
    for name, (a, b) in centre.items():
        for year in range(12 if name == "S2" else 3):
            x = 50 + a * WAVES[0] + b * WAVES[1] + rng.normal(0, 2, DAYS)
            values = np.rint(x).astype("<i2")
            if year == 1:
                values[3] = -999
            rows.append((name, 2000 + year, "India", "TAVG", 10.0 + int(name[1]), 70.0, bytearray(values.tobytes())))
    return rows


def test_whole_report(spark, tmp_path):
    weather = rows_to_frame(spark, weather_rows(), schemas.WEATHER)
    weather.write.partitionBy("country", "measurement").parquet(str(tmp_path / "weather"))
    tables.read_weather(spark, str(tmp_path / "weather")).createOrReplaceTempView("weather_rows")
    rows = tables.weather_of(spark, "India", "TAVG", view="weather_rows")
    assert rows.count() == len(weather_rows())
    assert tables.weather_of(spark, "India' OR '1'='1", "TAVG", view="weather_rows").count() == 0

    basis = Basis([50.0] * DAYS, WAVES.tolist(), [2.0, 1.0])
    tables.save_basis(spark, {"TAVG": basis}, str(tmp_path / "basis"))
    loaded = tables.load_basis(tables.read_basis_table(spark, str(tmp_path / "basis")), "TAVG", 2)
    assert loaded == basis
    with pytest.raises(ValueError, match="lacks components"):
        tables.load_basis(tables.read_basis_table(spark, str(tmp_path / "basis")), "TAVG", 3)

    results = weather_report(rows, loaded, ResultStore(spark, str(tmp_path / "out")), missing=-999)
    groups = {r["Station"]: (r["group"], r["count"]) for r in results["stations"].collect()}
    assert groups == {"S1": (0, 3), "S2": (2, 12), "S3": (3, 3), "S4": (6, 3)}
    assert {r["group_id"]: r["matched"] for r in results["profile_matches"].collect()} == {0: 0, 2: 2, 3: 3, 6: 6}
    assert results["profiles"].count() == 4 * DAYS
    assert results["markers"].count() == 4
    expected = 50 + 500 * WAVES[0] + 400 * WAVES[1]
    three = {r["day"]: r["value"] for r in results["profiles"].filter("group_id = 3").collect()}
    assert np.allclose([three[d] for d in range(1, DAYS + 1)], expected, atol=6)
    box = results["box"].first()
    assert (box["min_lat"], box["max_lat"]) == (11.0, 14.0)


def test_filters_reach_the_scan(spark, tmp_path):
    rows_to_frame(spark, weather_rows(), schemas.WEATHER).write.parquet(str(tmp_path / "w"))
    tables.read_weather(spark, str(tmp_path / "w")).createOrReplaceTempView("weather_flat")
    plan = plan_of(tables.weather_of(spark, "India", "TAVG", view="weather_flat").select("Station"))
    assert "EqualTo(country,India)" in plan and "EqualTo(measurement,TAVG)" in plan
    assert "ReadSchema: struct<Station:string,country:string,measurement:string>" in plan
