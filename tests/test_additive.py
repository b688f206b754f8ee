"""Weights that add up: distinct days, arg-max, cubes of one scan, maintained cubes."""

import datetime as dt
import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crashgrid.operators import matrix, ranking, rollups, trends
from crashgrid.plans import batch, catalogue, maintained
from crashgrid.plans import reports as R
from crashgrid.sources import adapters, schema

from .conftest import SF_SMALL, have_data
from .fixtures import rows

DAYS = [dt.date(1958, 3, 4), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(2024, 1, 6), dt.date(2061, 5, 5), None]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _dated(spark):
    specs = [{"Date_Occurred": d, "Area_Name": a, "Is_Weekend": w, "Hour": i % 5, "DR_Number": None if i % 7 == 0 else i}
             for i, (d, a, w) in enumerate((d, a, w) for d in DAYS for a in ("A", "B", None) for w in (True, False, None))]
    return rows(spark, specs * 2, derive=False)


# ------------------------------------------------------------ distinct days
def test_days_add_up_to_any_grain(spark):
    df = _dated(spark)
    fine = rollups.fold_days(rollups.weighted_cube(df, ["Area_Name", "Is_Weekend", "Date_Occurred"]))
    assert "Date_Occurred" not in fine.columns
    coarse = rollups.weighted_cube(fine, ["Is_Weekend"])
    for keys in (["Is_Weekend"], ["Area_Name"], ["Area_Name", "Is_Weekend"]):
        want = _rows(df.groupBy(*keys).agg(F.count("DR_Number"), F.count_distinct("Date_Occurred")))
        assert _rows(rollups.count_and_days(df, keys)) == want
        assert _rows(rollups.count_and_days(fine, keys)) == want
        if keys == ["Is_Weekend"]:
            assert _rows(rollups.count_and_days(coarse, keys)) == want
            assert _rows(rollups.count_and_days(fine.unionByName(fine), keys).select(*keys, "Distinct_Days")) == [(w[0], w[2]) for w in want]


def test_weekend_average_from_a_cube_without_dates(spark):
    df = _dated(spark)
    cube = rollups.fold_days(rollups.weighted_cube(df, ["Day_of_Week", "Is_Weekend", "Date_Occurred"]))
    assert _rows(R.weekend_daily_average(cube)) == _rows(R.weekend_daily_average(df))
    assert _rows(R.weekend_pair(cube)) == _rows(R.weekend_pair(df))
    assert _rows(R.weekend_daily_average(df.limit(0))) == []


# ------------------------------------------------------------ arg-max
@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**62), st.integers(-(2**31), 2**31 - 1))
def test_packed_holds_value_and_by(value, by):
    packed = value * 2**32 + (2**31 - 1 - by)
    assert (packed >> 32, 2**31 - 1 - packed % 2**32) == (value, by)


def test_peak_single_equals_the_window_form(spark):
    import random

    rng = random.Random(5)
    data = [(f"a{rng.randrange(40)}", rng.choice([None, *range(-2, 24), 2**31 - 1, -(2**31)]), rng.choice([None, 1, 1, 2, 3, 2**40, 2**62])) for _ in range(2000)]
    df = spark.createDataFrame(list({(g, b): (g, b, v) for g, b, v in data}.values()), "g string, h int, n long")
    known = df.where("h is not null and n is not null")
    want = ranking.peak(known, "g", "n", by="h", ties="first").select("g", "h", "n")
    got = ranking.peak_single(df, "g", "n", by="h")
    assert _rows(got) == _rows(want)
    parts = [df.where(F.abs(F.hash("g", "h")) % 3 == i) for i in range(3)]  # maxima of parts merge
    best = None
    for part in parts:
        one = part.groupBy("g").agg(F.max(ranking.packed("n", "h")).alias("b"))
        best = one if best is None else best.unionByName(one)
    merged = best.groupBy("g").agg(F.max("b").alias("b")).where("b is not null")
    assert _rows(merged.select("g", ranking.peak_by("b"), ranking.peak_value("b"))) == _rows(want)


@pytest.mark.parametrize("name", ["peak_hour_single", "area_peak_percent", "area_stats_with_peak", "hotspot_with_peak"])
def test_peaks_are_hash_aggregates(spark, name):
    if not have_data(SF_SMALL):
        pytest.skip("driver tables absent")
    plan = catalogue.run(spark, SF_SMALL, name)._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan and "HashAggregate" in plan


# ------------------------------------------------------------ columns found in the data
def test_severities_found_in_the_data(spark):
    specs = [{"Area_Name": a, "Collision_Severity": s} for a, s in [("A", "Fatal"), ("A", "Injury Involved"), ("A", None), ("B", "Property Damage Only"), ("B", "Fatal"), ("B", "Fatal"), (None, "Other")]]
    got = R.severity_matrix(rows(spark, specs))
    assert got.columns == ["Area_Name", "Injury Involved", "Property Damage Only", "Fatal", "Total_Collisions"]
    assert [tuple(r) for r in got.collect()] == [("A", 1, 0, 1, 3), ("B", 0, 1, 2, 3)]
    found = R.severity_matrix(rows(spark, specs), ())
    assert found.columns == ["Area_Name", "Fatal", "Injury Involved", "Property Damage Only", "Total_Collisions"]
    assert [tuple(r) for r in found.collect()] == [("A", 1, 1, 0, 3), ("B", 2, 0, 1, 3)]
    assert R.severity_matrix(rows(spark, specs).limit(0), ()).columns == ["Area_Name", "Total_Collisions"]
    clash = rows(spark, [{"Collision_Severity": "Area_Name"}, {"Collision_Severity": "Total_Collisions"}])
    assert R.severity_matrix(clash, ()).columns == ["Area_Name", "Area_Name (Collision_Severity)", "Total_Collisions (Collision_Severity)", "Total_Collisions"]


def test_too_many_columns_are_an_error(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("s"))
    with pytest.raises(ValueError, match="more than 20"):
        matrix.found_values(df, "s", most=20)
    assert len(matrix.found_values(df, "s", most=30)[1]) == 30


# ------------------------------------------------------------ shares without a one-task window
def test_share_and_rescale_keep_their_rows_where_they_are(spark):
    df = spark.range(0, 1000, numPartitions=5).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), (F.col("id") / 2).alias("t"))
    for out in (trends.share(df, "v"), trends.rescale_to_max(df, "v", "t", "s")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and out.rdd.getNumPartitions() == 5
    total = sum(i % 7 for i in range(1000))
    assert {r.k: r.Share_Pct for r in trends.share(df, "v", digits=6).collect()} == {i: pytest.approx(i % 7 / total * 100, abs=1e-6) for i in range(1000)}
    assert trends.share(df.limit(0), "v").collect() == []


# ------------------------------------------------------------ one scan for all grains
def test_cubes_of_one_scan_equal_cubes_one_by_one(spark):
    df = _dated(spark)
    grains = [("Area_Name", "Hour"), ("Is_Weekend", "Date_Occurred"), ("Hour",), ()]
    found = rollups.cubes(df, grains, scale=3)
    for g, cube in found.items():
        assert _rows(cube) == _rows(rollups.weighted_cube(df, g, scale=3).select(*cube.columns)), g
    again = rollups.cubes(found["Area_Name", "Hour"], [("Area_Name",), ("Hour",)])
    assert _rows(again[("Hour",)]) == _rows(found[("Hour",)])
    with pytest.raises(ValueError):
        rollups.cubes(df, [("Hour", "Area_Name"), ("Area_Name", "Hour")])


def test_catalogue_scans_each_fact_once(spark):
    """Counted from the stages that ran: only a scan of the fact has as many tasks
    as the fact has splits."""
    if not have_data(SF_SMALL):
        pytest.skip("driver tables absent")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    sc = spark.sparkContext
    try:
        for table, view in (("events", catalogue.SHORT), ("orders", catalogue.LONG)):
            splits = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").rdd.getNumPartitions()
            names = [n for n, q in catalogue.QUERIES.items() if q.source is view and not batch.needs_rows(q)]
            sc.setJobGroup(f"batch-{table}", table)
            for df in batch.batch_frames(spark, SF_SMALL, names).values():
                df.write.format("noop").mode("overwrite").save()
            st = sc.statusTracker()
            infos = [st.getStageInfo(s) for j in st.getJobIdsForGroup(f"batch-{table}") for s in st.getJobInfo(j).stageIds]
            assert splits > 8 and sum(i is not None and i.numCompletedTasks == splits for i in infos) == 1, table
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# ------------------------------------------------------------ maintained cubes
@pytest.fixture
def folder(spark):
    if not have_data(SF_SMALL):
        pytest.skip("driver tables absent")
    table = adapters.incidents(spark, SF_SMALL, schema.REQUIRED_COLUMNS + ["Victim_Age"])
    where = tempfile.mkdtemp(prefix="crashgrid-maintained-")
    parts = table.withColumn("_k", F.pmod(F.xxhash64("DR_Number"), F.lit(3)))

    def add(k, fmt):
        part = parts.where(F.col("_k") == k).drop("_k").coalesce(1)
        out = f"{where}/new-{k}"
        (part.write.option("header", True).csv(out) if fmt == "csv" else part.write.parquet(out))
        (name,) = [f for f in os.listdir(out) if f.startswith("part-")]
        os.makedirs(f"{where}/data", exist_ok=True)
        os.link(f"{out}/{name}", f"{where}/data/f{k}.{fmt}")

    return where, add


def _store(spark, where, seen):
    def read(session, paths):
        seen.append(sorted(os.path.basename(p) for p in paths))
        return maintained.read_files(session, paths)

    return maintained.MaintainedCubes(spark, f"{where}/store", maintained.report_grains(), scale=6, read=read)


def test_only_new_files_are_read_and_results_equal_a_full_run(spark, folder, monkeypatch):
    where, add = folder
    seen = []
    store = _store(spark, where, seen)
    add(0, "csv")
    assert store.update(f"{where}/data") == 1 and store.update(f"{where}/data") == 0 and store.version() == 1
    add(1, "parquet")
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("the driver is gone")))
    with pytest.raises(OSError):
        store.update(f"{where}/data")
    monkeypatch.undo()
    store = _store(spark, where, seen)
    assert store.version() == 1
    assert store.update(f"{where}/data") == 1
    add(2, "csv")
    assert store.update(f"{where}/data") == 1 and store.update(f"{where}/data") == 0
    assert seen == [["f0.csv"], ["f1.parquet"], ["f1.parquet"], ["f2.csv"]]
    assert {os.path.basename(r.path) for r in store.files().collect()} == {"f0.csv", "f1.parquet", "f2.csv"}

    whole = maintained.read_files(spark, [f"{where}/data/{f}" for f in sorted(os.listdir(f"{where}/data")) if f[0] == "f"])
    from crashgrid.plans import runner

    want = runner.results(whole, [n for g in maintained.report_grains().values() for n in g], scale=6)
    got = maintained.reports(store)
    assert got.keys() == want.keys()
    for name in want:
        assert got[name].columns == want[name].columns and _rows(got[name]) == _rows(want[name]), name

    store.drop_old(keep=1)
    assert len(os.listdir(f"{where}/store/attempts")) == 1 and _rows(maintained.reports(store, ["obj2_dangerous_areas"])["obj2_dangerous_areas"])


def test_changed_files_are_an_error_until_rebuilt(spark, folder):
    where, add = folder
    store = _store(spark, where, [])
    add(0, "csv")
    add(1, "csv")
    store.update(f"{where}/data")
    total = lambda: sum(r[1] for r in maintained.reports(store, ["obj1_time_of_day"])["obj1_time_of_day"].collect())
    before = total()
    with open(f"{where}/data/f1.csv", "a") as f:
        f.write(open(f"{where}/data/f1.csv").readlines()[1])
    with pytest.raises(maintained.ChangedFiles, match="f1.csv"):
        store.update(f"{where}/data")
    assert total() == before
    store.rebuild(f"{where}/data")
    assert total() == before + 1 and store.update(f"{where}/data") == 0


def test_two_writers_make_one_state(spark, folder):
    where, add = folder
    store = _store(spark, where, [])
    add(0, "csv")
    store.update(f"{where}/data")
    with pytest.raises(Exception):
        store._commit(1, "other")
    assert store.version() == 1
