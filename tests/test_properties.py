"""Randomised properties: roll-ups agree, first-peak ⊆ all-peaks,
percentages in range, cube answers = direct answers, repartitioning changes nothing."""

import datetime as dt
from functools import partial

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from crashgrid.operators import rollups
from crashgrid.plans import reports as R

from .fixtures import rows

AREAS = ["A", "B", "C", None]
ROW = st.fixed_dictionaries({
    "Area_Name": st.sampled_from(AREAS),
    "Hour": st.one_of(st.none(), st.integers(0, 23)),
    "Date_Occurred": st.dates(dt.date(2019, 12, 25), dt.date(2020, 1, 10)),
    "Collision_Severity": st.sampled_from(["Injury Involved", "Property Damage Only"]),
    "Is_Hotspot": st.one_of(st.none(), st.booleans()),
    "Victim_Age": st.one_of(st.none(), st.integers(0, 9000).map(lambda c: c / 100)),
    "DR_Number": st.one_of(st.none(), st.integers(1, 10**6)),
})


def _set(df):
    return sorted(map(tuple, df.collect()), key=repr)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=40))
def test_properties(spark, specs):
    df = rows(spark, specs)
    # roll-ups agree: every count report sums to the same total
    total = sum(1 for s in specs if s["DR_Number"] is not None)
    for fn in (R.count_by_area, R.count_by_hour_band, R.count_by_day, R.weekend_split, R.count_by_season):
        assert sum(r.Total_Collisions for r in fn(df).collect()) == total
    assert sum(r.Collision_Count for r in R.hourly_flow(df).collect()) == total
    # ties="first" is one of the tied hours kept by ties="all", where hours are known
    known = df.where("Hour is not null")
    first = {(r.Area_Name, r.Peak_Hour) for r in R.peak_hour_single(df).collect()}
    assert first <= {(r.Area_Name, r.Peak_Hour) for r in R.peak_hour_per_area(known).collect()}
    # percentages within [0, 100]
    for r in R.area_peak_percent(df).collect():
        assert 0 <= r.Peak_Pct <= 100
    # the weighted cube gives the direct answers
    cube = rollups.weighted_cube(df, ["Area_Name", "Hour", "Date_Occurred", "Day_of_Week", "Is_Weekend",
                                      "Year", "Month", "Season", "Time_of_Day", "Collision_Severity",
                                      "Is_Hotspot"], scale=2)
    for fn in (partial(R.area_stats_with_peak, scale=2), R.area_peak_percent, R.weekend_daily_average, R.severity_matrix,
               R.hour_envelope, partial(R.day_profile_with_measure, scale=2)):
        assert _set(fn(cube)) == _set(fn(df)), fn
    # repartitioning changes nothing (no arrival-order dependence)
    shuffled = df.repartition(5)
    for fn in (R.area_peak_percent, R.peak_hour_single, R.top5_areas, R.top20_area_hours):
        assert _set(fn(shuffled)) == _set(fn(df)), fn.__name__
