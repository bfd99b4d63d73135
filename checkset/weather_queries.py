"""Registered queries on measurement vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from checkset.standins import DAYS, MISSING, WEATHER_SQL, table, wave_basis, weather
from corvane import schemas
from corvane.functions.vectors import decode_values
from corvane.operators import decomposition as dc
from corvane.operators import profiles as pf
from corvane.operators import stations as st
from corvane.operators.ordering import with_position
from corvane.plans.weather_report import weather_report
from corvane.session import shared_folder
from corvane.sources.fetch import fetch
from corvane.sources.results import ResultStore
from corvane.sources.tables import load_basis, save_basis, top_basis, weather_of

COUNTRY, MEASUREMENT = "NATION_3", "click"


def _stored(spark, df, name):
    """`df` as a written table, for inputs that a query reads more than once."""
    return ResultStore(spark, shared_folder(spark, "weather")).write(name, df)


def _values():
    return decode_values(F.col("Values"), missing=MISSING)


def _basis(rows):
    return wave_basis(dc.fetch_means(dc.day_means(rows, _values())))


def _decomposed(spark, sf_dir):
    """The decomposed rows, not yet run, and the basis."""
    rows = _stored(spark, weather(spark, sf_dir), "weather")
    basis = _basis(rows)
    return dc.decompose(rows, _values(), basis), basis


def _stations(spark, sf_dir):
    return st.with_nearest_group(st.stations(_decomposed(spark, sf_dir)[0]))


def _grouped_rows(spark, sf_dir):
    """Measurements with their station's group, and the basis; all from one decomposed table."""
    decomposed, basis = _decomposed(spark, sf_dir)
    decomposed = _stored(spark, decomposed, "decomposed")
    stations = st.with_nearest_group(st.stations(decomposed))
    return pf.grouped_rows(decomposed.select("Station", "Year", _values().alias("values")), stations), basis


def _rounded(df, columns, digits):
    return df.select([F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def _axis_basis(spark, sf_dir):
    """A basis table from the embeddings: unit axes, those of the largest variance first."""
    parts = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("pos", "value"))
    value = F.col("value").cast("double")
    axes = parts.groupBy("pos").agg(F.avg(value).alias("mean"), F.var_samp(value).alias("eigval"))
    ranked = axes.withColumn("component", F.row_number().over(Window.orderBy(F.desc("eigval"), "pos")))
    days = F.sequence(F.lit(0), F.max("pos").over(Window.partitionBy()))
    vectors = ranked.select(
        "component", "eigval", F.transform(days, lambda i: (i == F.col("pos")).cast("double")).alias("vector")
    )
    means = F.transform(F.array_sort(F.collect_list(F.struct("pos", "mean"))), lambda s: s["mean"])
    mean_row = axes.agg(means.alias("vector")).select(
        F.lit(0).alias("component"), F.lit(None).cast("double").alias("eigval"), "vector"
    )
    table_ = mean_row.unionByName(vectors).select(F.lit("embedding").alias("measurement"), "*")
    return table_.select(schemas.EIGENBASIS.fieldNames())


def s04_basis_store(spark, sf_dir):
    """One basis a measurement, stored and loaded again by measurement and component."""
    rows = _stored(spark, weather(spark, sf_dir), "weather")
    # One row an event type, of which there are five.
    kinds = [r["measurement"] for r in fetch(rows.select("measurement").distinct(), 100)]
    bases = {kind: _basis(rows.filter(F.col("measurement") == kind)) for kind in kinds}
    stored = save_basis(spark, bases, shared_folder(spark, "basis"))
    loaded = {kind: load_basis(stored, kind, 2) for kind in kinds}
    again = save_basis(spark, loaded, shared_folder(spark, "basis"))
    top = again.filter("component <= 2").select("measurement", "component", F.posexplode("vector").alias("pos", "value"))
    return _rounded(top.select("measurement", "component", (F.col("pos") + 1).alias("day"), "value"), ["value"], 6)


def s05_sql_weather_filter(spark, sf_dir):
    weather(spark, sf_dir).createOrReplaceTempView("corvane_s05_weather")
    return weather_of(spark, COUNTRY, MEASUREMENT, "corvane_s05_weather").select("Station", "country", "measurement", "latitude", "longitude")


def w01_filter(spark, sf_dir):
    weather(spark, sf_dir).createOrReplaceTempView("corvane_w01_weather")
    rows = weather_of(spark, COUNTRY, MEASUREMENT, "corvane_w01_weather")
    return rows.groupBy("country", "measurement").agg(F.count("*").alias("n"))


def w02_topk_basis(spark, sf_dir):
    top = top_basis(_axis_basis(spark, sf_dir), "embedding", 2)
    long = top.select("component", F.coalesce("eigval", F.lit(0.0)).alias("eigval"), F.posexplode("vector"))
    return long.select("component", F.round("eigval", 9).alias("eigval"), "pos", F.round("col", 9).alias("value"))


def w03_cumvar(spark, sf_dir):
    eigvals = _axis_basis(spark, sf_dir).filter("component > 0")
    return _rounded(dc.variance_explained(eigvals), ["cumvar"], 6)


def w04_decode(spark, sf_dir):
    decoded = weather(spark, sf_dir).select("Station", "measurement", _values().alias("values"))
    rows = decoded.select("Station", "measurement", F.posexplode_outer("values").alias("pos", "value"))
    return rows.select(
        "Station",
        "measurement",
        (F.col("pos") + 1).alias("day"),
        F.coalesce("value", F.lit(float(MISSING))).alias("value"),
    )


def w05_decompose(spark, sf_dir):
    rows, _ = _decomposed(spark, sf_dir)
    rows = rows.select("Station", "measurement", "coeff_1", "coeff_2", "res_0", "res_1", "res_2")
    return _rounded(_rounded(rows, ["coeff_1", "coeff_2"], 4), ["res_0", "res_1", "res_2"], 6)


def w06_reconstruct(spark, sf_dir):
    decomposed, basis = _decomposed(spark, sf_dir)
    rows = dc.approximations(decomposed, ["Station", "measurement"], basis)
    return _rounded(rows, ["value"], 4)


def w07_residual_filter(spark, sf_dir):
    columns = ("Station", "measurement", "coeff_1", "coeff_2", "res_1", "res_2")
    decomposed = _stored(spark, _decomposed(spark, sf_dir)[0].select(*columns), "decomposed")
    store = ResultStore(spark, shared_folder(spark, "ordered"))
    kept = {1: dc.well_described(decomposed, 1, below=0.9), 2: dc.well_described(decomposed, 2, below=0.8, above_previous=0.85)}
    ordered = [with_position(rows, [f"coeff_{i}", "Station", "measurement"], store, f"by-{i}").withColumn("by", F.lit(i)) for i, rows in kept.items()]
    rows = ordered[0].unionByName(ordered[1]).select("by", "position", "Station", "measurement", "coeff_1", "coeff_2")
    return _rounded(rows, ["coeff_1", "coeff_2"], 4)


def w08_extremes(spark, sf_dir):
    columns = ("Station", "measurement", "coeff_1", "coeff_2")
    decomposed = _stored(spark, _decomposed(spark, sf_dir)[0].select(*columns), "decomposed")
    ends = dc.extremes(decomposed, "coeff_1", ["Station", "measurement"])
    best = dc.highest(decomposed, "coeff_2").withColumn("side", F.lit("best_2"))
    return _rounded(ends.unionByName(best), ["coeff_1", "coeff_2"], 4)


def w09_station_means(spark, sf_dir):
    means = st.station_means(_decomposed(spark, sf_dir)[0])
    means = means.toDF("Station", "coeff_1", "coeff_2", "Longitude", "Latitude")
    return _rounded(means, ["coeff_1", "coeff_2", "Longitude", "Latitude"], 4)


def w10_station_counts(spark, sf_dir):
    return st.station_counts(weather(spark, sf_dir)).withColumnRenamed("count", "n")


def w11_stations(spark, sf_dir):
    store = ResultStore(spark, shared_folder(spark, "ordered"))
    rows = with_position(st.stations(_decomposed(spark, sf_dir)[0]), ["Station"], store, "stations").withColumnRenamed("count", "n")
    return _rounded(rows, ["coeff_1", "coeff_2", "Longitude", "Latitude"], 4)


def w12_nearest_centre(spark, sf_dir):
    return _stations(spark, sf_dir).select("Station", "group")


def w13_centres(spark, sf_dir):
    return st.centre_sizes(_stations(spark, sf_dir))


def w14_bbox(spark, sf_dir):
    box = st.bounding_box(weather(spark, sf_dir))
    return _rounded(box, box.columns, 6)


def w15_markers(spark, sf_dir):
    return _rounded(st.markers(_stations(spark, sf_dir)), ["lat", "lon"], 6)


def w16_group_rows(spark, sf_dir):
    rows, _ = _grouped_rows(spark, sf_dir)
    return rows.select(
        "Station",
        "Year",
        "group",
        F.array_join(F.transform("values", lambda v: v.cast("int").cast("string")), ",", "-").alias("days"),
    )


def w17_profile(spark, sf_dir):
    return _rounded(pf.profile(_grouped_rows(spark, sf_dir)[0]), ["value"], 6)


def w18_scaled_series(spark, sf_dir):
    top = top_basis(_axis_basis(spark, sf_dir), "embedding", 2)
    return _rounded(dc.scaled_series(top), ["value"], 6)


def w19_fit_moments(spark, sf_dir):
    rows = _stored(spark, weather(spark, sf_dir), "weather")
    means = dc.day_means(rows, _values())
    spread = dc.covariance(rows, _values(), dc.fetch_means(means))
    joined = spread.drop("n").join(means.select(F.col("day").alias("i"), "mean"), "i")
    return joined.select("i", "j", F.round("mean", 6).alias("mean"), F.round("cov", 3).alias("cov"))


def w19_fit_pairwise(spark, sf_dir):
    """Covariances over the rows that have both days."""
    rows = _stored(spark, weather(spark, sf_dir), "weather")
    spread = dc.covariance(rows, _values(), dc.fetch_means(dc.day_means(rows, _values())), pairwise=True)
    return spread.select("i", "j", "n", F.round("cov", 3).alias("cov"))


def w19_fit_basis(spark, sf_dir):
    """What a fitted and stored basis must fulfil, as figures: eigenvectors, orthonormality, eigenvalues and what they explain."""
    rows = _stored(spark, weather(spark, sf_dir), "weather")
    basis = dc.fit_basis(rows, _values())
    stored = save_basis(spark, {"all": basis}, shared_folder(spark, "basis"))
    loaded = load_basis(stored, "all", DAYS)
    cov = _stored(spark, dc.covariance(rows, _values(), loaded.mean), "cov")
    vectors = stored.filter("component > 0")
    split = dc.decompose(rows, _values(), loaded)
    spreads = split.select([F.var_samp(f"coeff_{i}").alias(str(i)) for i in range(1, DAYS + 1)])
    spreads = spreads.unpivot([], spreads.columns, "component", "spread").withColumn("component", F.col("component").cast("int"))
    whole = vectors.agg(F.sum("eigval").alias("whole"))
    falling = dc.variance_explained(vectors, n=DAYS + 1).agg(F.max("cumvar").alias("v"))
    figure = lambda df, name, i, j, value, digits: df.select(F.lit(name).alias("figure"), i.cast("int").alias("i"), j.cast("int").alias("j"), (F.round(value, digits) + 0.0).alias("value"))
    zero, own = F.lit(0), F.col("component")
    shown = [
        figure(dc.eigen_errors(cov, stored).crossJoin(F.broadcast(whole)), "error", own, zero, F.col("error") / F.col("whole"), 6),
        figure(dc.gram(stored), "dot", F.col("i"), F.col("j"), F.col("dot"), 6),
        figure(spreads.join(vectors, "component").crossJoin(F.broadcast(whole)), "spread", own, zero, (F.col("spread") - F.col("eigval")) / F.col("whole"), 6),
        figure(falling, "explained", zero, zero, F.col("v"), 6),
    ]
    for power in (1, 2, 3):
        moment = vectors.agg(F.pow(F.sum(F.pow("eigval", F.lit(power))), F.lit(1 / power)).alias("v"))
        shown.append(figure(moment, "moment", F.lit(power), zero, F.col("v"), 3))
    return reduce(lambda a, b: a.unionByName(b), shown)


def w21_weather_report(spark, sf_dir):
    """The whole job: its stored tables, told apart by name."""
    rows = _stored(spark, weather(spark, sf_dir), "weather")
    store = ResultStore(spark, shared_folder(spark, "report"))
    results = weather_report(rows, _basis(rows), store, missing=MISSING, small=0.9, smaller=0.8, above=0.85)
    box = results["box"]
    results["box"] = box.unpivot([], box.columns, "side", "value")
    shown = [
        results[name].select(F.lit(name).alias("result"), F.concat_ws(" ", *item).alias("item"), F.round(F.col(value).cast("double"), 4).alias("value"))
        for name, item, value in (
            ("decomposed", ["Station", "measurement"], "res_1"),
            ("stations", ["position", "Station", "count"], "group"),
            ("by_coeff_1", ["position", "Station", "measurement"], "coeff_1"),
            ("by_coeff_2", ["position", "Station", "measurement"], "coeff_2"),
            ("box", ["side"], "value"),
            ("markers", ["color"], "radius"),
            ("profiles", ["group_id", "day"], "value"),
            ("profile_matches", ["group_id"], "matched"),
        )
    ]
    return reduce(lambda a, b: a.unionByName(b), shown)


def w20_profile_match(spark, sf_dir):
    grouped, basis = _grouped_rows(spark, sf_dir)
    rows = pf.match_profiles(pf.profile(grouped), basis)
    return _rounded(rows, ["coeff_1", "coeff_2"], 4)


QUERIES = {
    f.__name__: f
    for f in (
        s04_basis_store,
        s05_sql_weather_filter,
        w01_filter,
        w02_topk_basis,
        w03_cumvar,
        w04_decode,
        w05_decompose,
        w06_reconstruct,
        w07_residual_filter,
        w08_extremes,
        w09_station_means,
        w10_station_counts,
        w11_stations,
        w12_nearest_centre,
        w13_centres,
        w14_bbox,
        w15_markers,
        w16_group_rows,
        w17_profile,
        w18_scaled_series,
        w19_fit_moments,
        w19_fit_pairwise,
        w19_fit_basis,
        w20_profile_match,
        w21_weather_report,
    )
}

WITH = f"WITH {WEATHER_SQL}"
# Typed out, so that a slip in the library's own table would show.
CENTRES_SQL = """centres(group_id, c1, c2) AS (VALUES (0, 0::DOUBLE, 0::DOUBLE), (1, -250, -250), (2, 500, 0), (3, 500, 400), (4, -100, 600),
  (5, -1500, 500), (6, -200, 100))"""
STATIONS_SQL = f"""{WITH}, {CENTRES_SQL},
stations AS (
  SELECT Station, avg(coeff_1) AS coeff_1, avg(coeff_2) AS coeff_2, avg(longitude) AS Longitude,
         avg(latitude) AS Latitude, count(*) AS n
  FROM decomposed GROUP BY Station),
grouped AS (
  SELECT s.*, (SELECT group_id FROM centres ORDER BY (coeff_1 - c1) ^ 2 + (coeff_2 - c2) ^ 2, group_id LIMIT 1) AS "group"
  FROM stations s),
profiles AS (
  SELECT "group" AS group_id, day, avg(v) AS value
  FROM grid JOIN grouped USING (Station) WHERE v IS NOT NULL GROUP BY 1, 2)"""
AXES_SQL = """WITH parts AS (
  SELECT unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
axes AS (SELECT pos, avg(value) AS mean, var_samp(value) AS eigval FROM parts GROUP BY pos),
ranked AS (SELECT *, row_number() OVER (ORDER BY eigval DESC, pos) AS component FROM axes),
vectors AS (
  SELECT CAST(a.component AS INTEGER) AS component, a.eigval, CAST(b.pos AS INTEGER) AS pos,
         CAST(a.pos = b.pos AS INTEGER)::DOUBLE AS value
  FROM ranked a, axes b WHERE a.component <= 2
  UNION ALL SELECT 0, 0.0, CAST(pos AS INTEGER), mean FROM axes)"""
ROUNDED_SQL = "round(coeff_1, 4) AS coeff_1, round(coeff_2, 4) AS coeff_2"

SQL = {
    "s04_basis_store": f"""{WITH},
kind_means AS (SELECT measurement, day, avg(v) AS mean FROM day_values GROUP BY 1, 2),
kinds AS (SELECT DISTINCT measurement FROM weather)
SELECT measurement, 0 AS component, day, round(coalesce(k.mean, 0), 6) AS value
FROM kinds CROSS JOIN basis b LEFT JOIN kind_means k USING (measurement, day)
UNION ALL SELECT measurement, 1, day, round(v1, 6) FROM kinds, basis
UNION ALL SELECT measurement, 2, day, round(v2, 6) FROM kinds, basis""",
    "s05_sql_weather_filter": f"""{WITH} SELECT Station, country, measurement, latitude, longitude FROM weather
WHERE country = '{COUNTRY}' AND measurement = '{MEASUREMENT}'""",
    "w01_filter": f"""{WITH} SELECT country, measurement, count(*) AS n FROM weather
WHERE country = '{COUNTRY}' AND measurement = '{MEASUREMENT}' GROUP BY 1, 2""",
    "w02_topk_basis": f"{AXES_SQL} SELECT component, round(eigval, 9) AS eigval, pos, round(value, 9) AS value FROM vectors",
    "w03_cumvar": f"""{AXES_SQL}
SELECT 0 AS i, 0.0::DOUBLE AS cumvar UNION ALL
SELECT CAST(component AS INTEGER), round(100 * c / t, 6)
FROM (SELECT component, sum(eigval) OVER (ORDER BY component) AS c, sum(eigval) OVER () AS t FROM ranked)
WHERE component < 10""",
    "w04_decode": f"""{WITH} SELECT Station, measurement, day, CAST(coalesce(v, {MISSING}) AS DOUBLE) AS value FROM grid""",
    "w05_decompose": f"""{WITH} SELECT Station, measurement, {ROUNDED_SQL},
       round(res_0, 6) AS res_0, round(res_1, 6) AS res_1, round(res_2, 6) AS res_2 FROM decomposed""",
    "w06_reconstruct": f"""{WITH}
SELECT g.Station, g.measurement, CAST(k AS INTEGER) AS k, day,
       round(mean + CASE WHEN k >= 1 THEN coeff_1 * v1 ELSE 0 END + CASE WHEN k >= 2 THEN coeff_2 * v2 ELSE 0 END, 4) AS value
FROM grid g JOIN coeffs c ON c.Station = g.Station AND c.measurement = g.measurement, range(3) AS t(k)""",
    "w07_residual_filter": f"""{WITH}
SELECT 1 AS "by", row_number() OVER (ORDER BY coeff_1, Station, measurement) AS position, Station, measurement, {ROUNDED_SQL}
FROM decomposed WHERE res_1 < 0.9
UNION ALL SELECT 2, row_number() OVER (ORDER BY coeff_2, Station, measurement), Station, measurement, round(coeff_1, 4), round(coeff_2, 4)
FROM decomposed WHERE res_2 < 0.8 AND res_1 > 0.85""",
    "w08_extremes": f"""{WITH},
ends AS (
  SELECT *, row_number() OVER (ORDER BY coeff_1, Station, measurement) AS a,
         row_number() OVER (ORDER BY coeff_1 DESC, Station DESC, measurement DESC) AS z,
         row_number() OVER (ORDER BY coeff_2 DESC) AS best
  FROM decomposed),
sides AS (
  SELECT *, 'low' AS side FROM ends WHERE a <= 12 UNION ALL SELECT *, 'high' FROM ends WHERE z <= 12
  UNION ALL SELECT *, 'best_2' FROM ends WHERE best = 1)
SELECT Station, measurement, {ROUNDED_SQL}, side FROM sides""",
    "w09_station_means": f"""{STATIONS_SQL} SELECT Station, {ROUNDED_SQL},
       round(Longitude, 4) AS Longitude, round(Latitude, 4) AS Latitude FROM stations""",
    "w10_station_counts": f"{WITH} SELECT Station, count(*) AS n FROM weather GROUP BY 1",
    "w11_stations": f"""{STATIONS_SQL} SELECT Station, {ROUNDED_SQL},
       round(Longitude, 4) AS Longitude, round(Latitude, 4) AS Latitude, n,
       row_number() OVER (ORDER BY Station) AS position FROM stations""",
    "w12_nearest_centre": f'{STATIONS_SQL} SELECT Station, "group" FROM grouped',
    "w13_centres": f"""{STATIONS_SQL} SELECT group_id, c1, c2, count(g.Station) AS n_stations
FROM centres LEFT JOIN grouped g ON g."group" = group_id GROUP BY ALL""",
    "w14_bbox": f"""{WITH}
SELECT round(min(latitude), 6) AS min_lat, round(min(longitude), 6) AS min_lon,
       round(max(latitude), 6) AS max_lat, round(max(longitude), 6) AS max_lon,
       round((max(latitude) + min(latitude)) / 2, 6) AS center_lat,
       round((max(longitude) + min(longitude)) / 2, 6) AS center_lon
FROM weather""",
    "w15_markers": f"""{STATIONS_SQL}
SELECT round(Latitude, 6) AS lat, round(Longitude, 6) AS lon, CAST(trunc(4800 * sqrt(n)) AS INTEGER) AS radius,
       ['red', 'orange', 'yellow', 'green', 'black', 'blue', 'purple']["group" + 1] AS color FROM grouped""",
    "w16_group_rows": f"""{STATIONS_SQL}
SELECT g.Station, 2024 AS Year, "group", string_agg(coalesce(CAST(v AS VARCHAR), '-'), ',' ORDER BY day) AS days
FROM grid g JOIN grouped USING (Station) GROUP BY g.Station, g.measurement, "group\"""",
    "w17_profile": f"{STATIONS_SQL} SELECT group_id, day, round(value, 6) AS value FROM profiles",
    "w18_scaled_series": f"""{AXES_SQL}
SELECT component, pos + 1 AS day,
       round(CASE component WHEN 0 THEN value / max(value) OVER (PARTITION BY component) * 0.2 ELSE value END, 6) AS value
FROM vectors""",
    "w19_fit_moments": f"""{WITH}
SELECT a.day AS i, b.day AS j, round(any_value(a.mean), 6) AS mean, round(sum(a.c * b.c) / (count(*) - 1), 3) AS cov
FROM grid a JOIN grid b ON a.Station = b.Station AND a.measurement = b.measurement GROUP BY 1, 2""",
    "w19_fit_pairwise": f"""{WITH}
SELECT a.day AS i, b.day AS j, count(*) FILTER (a.v IS NOT NULL AND b.v IS NOT NULL) AS n,
       CASE WHEN count(*) FILTER (a.v IS NOT NULL AND b.v IS NOT NULL) > 1
            THEN round(sum(a.c * b.c) / (count(*) FILTER (a.v IS NOT NULL AND b.v IS NOT NULL) - 1), 3) ELSE 0 END AS cov
FROM grid a JOIN grid b ON a.Station = b.Station AND a.measurement = b.measurement GROUP BY 1, 2""",
    "w19_fit_basis": f"""{WITH},
cov AS (SELECT a.day AS i, b.day AS j, sum(a.c * b.c) / (count(*) - 1) AS cov
        FROM grid a JOIN grid b ON a.Station = b.Station AND a.measurement = b.measurement GROUP BY 1, 2),
squared AS (SELECT a.i, b.j, sum(a.cov * b.cov) AS cov FROM cov a JOIN cov b ON a.j = b.i GROUP BY 1, 2),
days AS (SELECT CAST(d AS INTEGER) AS d FROM range(1, {DAYS + 1}) AS t(d))
SELECT 'error' AS figure, d AS i, 0 AS j, 0.0::DOUBLE AS value FROM days
UNION ALL SELECT 'spread', d, 0, 0.0 FROM days
UNION ALL SELECT 'dot', a.d, b.d, CASE WHEN a.d = b.d THEN 1.0 ELSE 0.0 END FROM days a, days b
UNION ALL SELECT 'explained', 0, 0, 100.0
UNION ALL SELECT 'moment', 1, 0, round(sum(cov), 3) FROM cov WHERE i = j
UNION ALL SELECT 'moment', 2, 0, round(sqrt(sum(cov)), 3) FROM squared WHERE i = j
UNION ALL SELECT 'moment', 3, 0, round(sum(s.cov * c.cov) ** (1.0 / 3), 3) FROM squared s JOIN cov c ON s.j = c.i AND s.i = c.j""",
    "w20_profile_match": f"""{STATIONS_SQL},
projected AS (
  SELECT p.group_id, sum((value - mean) * v1) AS coeff_1, sum((value - mean) * v2) AS coeff_2
  FROM profiles p JOIN basis USING (day) GROUP BY 1)
SELECT p.group_id, {ROUNDED_SQL},
       (SELECT group_id FROM centres ORDER BY (coeff_1 - c1) ^ 2 + (coeff_2 - c2) ^ 2, group_id LIMIT 1) AS matched
FROM projected p""",
    "w21_weather_report": f"""{STATIONS_SQL},
projected AS (
  SELECT p.group_id, sum((value - mean) * v1) AS coeff_1, sum((value - mean) * v2) AS coeff_2
  FROM profiles p JOIN basis USING (day) GROUP BY 1),
box AS (
  SELECT unnest(['min_lat', 'min_lon', 'max_lat', 'max_lon', 'center_lat', 'center_lon']) AS side,
         unnest([min(Latitude), min(Longitude), max(Latitude), max(Longitude),
                 (max(Latitude) + min(Latitude)) / 2, (max(Longitude) + min(Longitude)) / 2]) AS value FROM stations)
SELECT 'decomposed' AS result, Station || ' ' || measurement AS item, round(res_1, 4) AS value FROM decomposed
UNION ALL SELECT 'stations', row_number() OVER (ORDER BY Station) || ' ' || Station || ' ' || n, "group" FROM grouped
UNION ALL SELECT 'by_coeff_1', row_number() OVER (ORDER BY coeff_1, Station, measurement) || ' ' || Station || ' ' || measurement, round(coeff_1, 4)
FROM decomposed WHERE res_1 < 0.9
UNION ALL SELECT 'by_coeff_2', row_number() OVER (ORDER BY coeff_2, Station, measurement) || ' ' || Station || ' ' || measurement, round(coeff_2, 4)
FROM decomposed WHERE res_2 < 0.8 AND res_1 > 0.85
UNION ALL SELECT 'box', side, round(value, 4) FROM box
UNION ALL SELECT 'markers', ['red', 'orange', 'yellow', 'green', 'black', 'blue', 'purple']["group" + 1], trunc(4800 * sqrt(n)) FROM grouped
UNION ALL SELECT 'profiles', group_id || ' ' || day, round(value, 4) FROM profiles
UNION ALL SELECT 'profile_matches', CAST(p.group_id AS VARCHAR),
  (SELECT group_id FROM centres ORDER BY (coeff_1 - c1) ^ 2 + (coeff_2 - c2) ^ 2, group_id LIMIT 1) FROM projected p""",
}
