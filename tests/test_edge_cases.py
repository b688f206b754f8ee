"""FIXTURES.md F4: nulls, ties, empty input, missing categories, rounding."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crashgrid.operators import ranking, rollups, trends
from crashgrid.plans import reports as R

from .fixtures import hour_rows, rows


def test_peak_ties_all_and_first(spark):
    df = rows(spark, hour_rows(spark, "A", {3: 2, 8: 2, 5: 1}))
    all_ = R.peak_hour_per_area(df, ties="all").collect()
    assert sorted(r.Peak_Hour for r in all_) == [3, 8]
    assert all(r.Peak_Collisions == 2 for r in all_)
    first = R.peak_hour_single(df).collect()
    assert [(r.Area_Name, r.Peak_Hour, r.Peak_Collisions) for r in first] == [("A", 3, 2)]


def test_peak_first_is_subset_of_all(spark):
    specs = hour_rows(spark, "A", {1: 3, 2: 3}) + hour_rows(spark, "B", {7: 1, 9: 4}, start_id=100)
    df = rows(spark, specs)
    all_ = {(r.Area_Name, r.Peak_Hour) for r in R.peak_hour_per_area(df).collect()}
    first = {(r.Area_Name, r.Peak_Hour) for r in R.peak_hour_single(df).collect()}
    assert first <= all_
    assert first == {("A", 1), ("B", 9)}


def test_peaks_of_unknown_areas_and_hours(spark):
    df = rows(spark, [{"Area_Name": None, "Hour": 1}] * 2 + [{"Area_Name": "A", "Hour": 2}] + [{"Area_Name": "A", "Hour": None}] * 2)
    assert [tuple(r) for r in R.peak_hour_per_area(df).collect()] == [("A", None, 2)]
    assert [tuple(r) for r in R.peak_hour_single(df).collect()] == [("A", 2, 1)]


def test_severity_top_is_ascending(spark):
    df = rows(spark, [{"Area_Name": a} for a in "AABBBC"])
    assert [r.Area_Name for r in R.severity_matrix(df, top=2).collect()] == ["A", "B"]


def test_null_keys_keep_and_drop(spark):
    df = rows(spark, [
        {"Area_Name": None, "Hour": 1},
        {"Area_Name": "A", "Hour": None},
        {"Area_Name": "A", "Hour": 2, "Year": None},
    ])
    keep = {r.Area_Name: r.Total_Collisions for r in R.count_by_area(df).collect()}
    assert keep == {None: 1, "A": 2}
    drop = {r.Area_Name: r.Collision_Count for r in R.area_rows(df).collect()}
    assert drop == {"A": 2}
    hours = {r.Hour for r in R.hourly_rows(df).collect()}
    assert None not in hours
    cube = {(r.Area_Name, r.Hour) for r in R.hourly_flow(df).collect()}
    assert (None, 1) in cube and ("A", None) in cube


def test_null_id_counts_fewer_than_rows(spark):
    df = rows(spark, [{"DR_Number": None}, {"DR_Number": 5}, {"DR_Number": 6}])
    by_id = R.count_by_area(df).collect()[0].Total_Collisions
    by_row = R.area_rows(df).collect()[0].Collision_Count
    assert (by_id, by_row) == (2, 3)


def test_empty_filter_keeps_schema(spark):
    df = rows(spark, [{"Hour": 3}, {"Hour": 8}])
    out = R.evening_rush_rows(df)
    assert out.count() == 0
    assert out.columns == ["DR_Number", "Area_Name", "Hour", "Address", "Severity"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "string", "int", "string", "string"]


def test_missing_category_pivot_zero(spark):
    df = rows(spark, [
        {"Area_Name": "A", "Collision_Severity": "Injury Involved"},
        {"Area_Name": "B", "Collision_Severity": "Property Damage Only"},
        {"Area_Name": "B", "Collision_Severity": "Injury Involved"},
    ])
    m = {r.Area_Name: r.asDict() for r in R.severity_matrix(df).collect()}
    assert m["A"]["Property Damage Only"] == 0
    assert m["A"]["Injury Involved"] == 1
    assert m["B"]["Total_Collisions"] == 2
    # pivot row sums equal the totals
    for r in m.values():
        assert r["Injury Involved"] + r["Property Damage Only"] == r["Total_Collisions"]


def test_missing_pivot_column_still_present(spark):
    df = rows(spark, [{"Area_Name": "A", "Collision_Severity": "Injury Involved"}])
    out = R.severity_matrix(df)
    assert "Property Damage Only" in out.columns
    assert out.collect()[0]["Property Damage Only"] == 0


def test_sparse_hours_envelope(spark):
    # area A has hour 4, area B does not: min at hour 4 is 0, mean divides by 2 areas
    specs = hour_rows(spark, "A", {4: 3, 5: 1}) + hour_rows(spark, "B", {5: 2}, start_id=50)
    env = {r.Hour: r for r in R.hour_envelope(rows(spark, specs)).collect()}
    assert set(env) == {4, 5}
    assert env[4].Min == 0 and env[4].Max == 3 and env[4].Total == 3
    assert env[4].Mean == pytest.approx(1.5)
    assert env[5].Mean == pytest.approx(1.5)
    # rescaled total: total / max(total) * max(mean)
    assert env[4].Total_Scaled == pytest.approx(3 / 3 * 1.5)


def test_heatmap_fixed_24_columns_zero_filled(spark):
    df = rows(spark, hour_rows(spark, "A", {0: 1, 23: 2}))
    out = R.area_hour_heatmap(df).collect()[0]
    assert out.H00 == 1 and out.H23 == 2 and out.H12 == 0
    assert out.Total_Collisions == 3


def test_missing_calendar_label(spark):
    # 2024-01-01 is a Monday; no Sunday rows
    df = rows(spark, [{"Date_Occurred": dt.date(2024, 1, 1)}, {"Date_Occurred": dt.date(2024, 1, 2)}])
    days = R.calendar_ordered_days(df).collect()
    assert [r.Day_of_Week for r in days] == [
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert days[6].Total_Collisions is None
    assert days[0].Total_Collisions == 1


def test_weekend_class_absent(spark):
    df = rows(spark, [{"Date_Occurred": dt.date(2024, 1, 1)}, {"Date_Occurred": dt.date(2024, 1, 2)}])
    pair = R.weekend_pair(df).collect()[0]
    assert pair.Weekend_Total is None and pair.Weekend_Avg_Daily is None
    assert pair.Weekday_Total == 2 and pair.Weekday_Avg_Daily == 1.0


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(1, 400), (3, 400), (1, 8)], "p long, t long")
    got = [r.v for r in df.select(trends.pct("p", "t").alias("v")).collect()]
    assert got == [0.2, 0.8, 12.5]  # 0.25 -> 0.2, 0.75 -> 0.8 (half-even)


def test_divide_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0)], "p long, t long")
    assert df.select(trends.pct("p", "t").alias("v")).collect()[0].v is None


def test_topn_tie_stable_under_repartition(spark):
    specs = []
    i = 1
    for area, n in [("A", 5), ("B", 3), ("C", 3), ("D", 3), ("E", 1)]:
        for _ in range(n):
            specs.append({"Area_Name": area, "DR_Number": i})
            i += 1
    df = rows(spark, specs)
    first = [tuple(r) for r in R.top5_areas(df, n=3).collect()]
    for parts in (1, 3, 7):
        again = [tuple(r) for r in R.top5_areas(df.repartition(parts), n=3).collect()]
        assert again == first
    assert [r[1] for r in first] == ["A", "B", "C"]


def test_trend_flat_on_equal_years(spark):
    df = spark.createDataFrame([(2019, 5), (2020, 5), (2021, 7), (2022, 2)], "Year int, Collision_Count long")
    got = [r.Direction for r in trends.direction(df, "Year", "Collision_Count").orderBy("Year").collect()]
    assert got == ["flat", "flat", "up", "down"]


def test_scenario_counts_one_pass(spark):
    df = rows(spark, [
        {"Hour": 7, "Road_Type": "Road", "Is_Hotspot": True},
        {"Hour": 18, "Road_Type": "Other", "Collision_Severity": "Property Damage Only"},
        {"Hour": None, "Is_Hotspot": None},
    ])
    r = R.scenario_counts(df).collect()[0]
    assert (r.Morning_Rush, r.Evening_Rush, r.Road_Only, r.Hotspot_Only, r.Injury_Only) == (1, 1, 2, 1, 2)


def test_count_by_where_and_null_rule(spark):
    df = rows(spark, [{"Area_Name": None}, {"Area_Name": "A"}])
    with pytest.raises(ValueError):
        rollups.count_by(df, "Area_Name", null_keys="nope")
    assert rollups.count_by(df, "Area_Name", where=F.col("Area_Name") == "A").count() == 1


def test_overall_peak_lowest_hour_on_tie(spark):
    df = spark.createDataFrame([(5, 10), (2, 10), (9, 3)], "Hour int, Total_Collisions long")
    assert ranking.overall_peak(df, "Total_Collisions", "Hour").collect()[0].Hour == 2
