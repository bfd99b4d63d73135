"""From packed measurements of one country to station groups and their yearly profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.vectors import Basis, decode_values
from corvane.operators import decomposition as dc
from corvane.operators import profiles as pf
from corvane.operators import stations as st
from corvane.operators.ordering import with_position
from corvane.sources.results import ResultStore


def weather_report(
    weather: DataFrame,
    basis: Basis,
    store: ResultStore,
    scale: float = 1.0,
    missing: int | None = None,
    small: float = 0.3,
    smaller: float = 0.11,
    above: float = 0.2,
) -> dict[str, DataFrame]:
    """Store and return the job's tables by name.

    The decomposed rows and the station groups are written out, as several
    results need them; the packed values stay with the rows, being the most
    compact form, and are decoded again only for the profiles. Rows whose first residual is
    `small`, and those whose second is `smaller` while the first is `above`, come with
    their position by that coefficient, stations with theirs by name.
    """
    values = decode_values(F.col("Values"), scale, missing)
    decomposed = store.write("decomposed", dc.decompose(weather, values, basis))
    stations = with_position(st.with_nearest_group(st.stations(decomposed)), ["Station"], store, "stations")

    measurements = decomposed.select("Station", "Year", values.alias("values"))
    profiles = store.write("profiles", pf.profile(pf.grouped_rows(measurements, stations)))
    results = {
        "box": st.bounding_box(stations),
        "markers": st.markers(stations),
        "profile_matches": pf.match_profiles(profiles, basis),
    }
    described = {
        "by_coeff_1": dc.well_described(decomposed, 1, below=small),
        "by_coeff_2": dc.well_described(decomposed, 2, below=smaller, above_previous=above),
    }
    for name, rows in described.items():
        coeff = name.removeprefix("by_")
        results[name] = with_position(rows.drop("Values"), [coeff, "Station", "measurement", "Year"], store, f"{name}-ordered")
    stored = {name: store.write(name, df) for name, df in results.items()}
    return {"decomposed": decomposed, "stations": stations, "profiles": profiles, **stored}
