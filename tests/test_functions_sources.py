"""Derived dimensions, text flags, schema contract, CSV ingest."""

import datetime as dt
import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from crashgrid.functions import dims, enrich, formatting
from crashgrid.plans import reports
from crashgrid.sources import readers, schema, sinks


def test_hour_bands_cover_day(spark):
    df = spark.range(-1, 25).select(F.col("id").cast("int").alias("h"))
    got = {r.h: r.b for r in df.select("h", enrich.hour_band("h").alias("b")).collect()}
    assert got[-1] is None and got[24] is None
    assert [got[h] for h in (0, 5, 6, 9, 10, 12, 13, 16, 17, 19, 20, 23)] == [
        "Late Night", "Late Night", "Morning Rush", "Morning Rush", "Mid Morning", "Mid Morning",
        "Afternoon", "Afternoon", "Evening Rush", "Evening Rush", "Night", "Night"]


def test_seasons_and_month_labels(spark):
    df = spark.range(0, 14).select(F.col("id").cast("int").alias("m"))
    got = {r.m: r.s for r in df.select("m", enrich.season("m").alias("s")).collect()}
    assert got[0] is None and got[13] is None
    assert got[12] == got[1] == got[2] == "Winter"
    assert got[3] == "Spring" and got[6] == "Summer" and got[9] == "Fall"
    assert [r.MonthName for r in dims.month_dim(spark).orderBy("Month").collect()][::11] == ["Jan", "Dec"]


def test_day_names_and_weekend(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 8)], "d date")
    got = [tuple(r) for r in df.select(enrich.day_name("d"), enrich.is_weekend("d")).collect()]
    assert got == [("Monday", False), ("Tuesday", False), ("Wednesday", False), ("Thursday", False),
                   ("Friday", False), ("Saturday", True), ("Sunday", True)]


def test_text_flags(spark):
    df = spark.createDataFrame([("True",), ("true",), ("FALSE",), ("",), (None,), ("yes",)], "f string")
    assert [r.v for r in df.select(enrich.text_flag("f").alias("v")).collect()] == [True, True, False, None, None, None]


def test_labels(spark):
    df = spark.createDataFrame([("77th Street", 7, "Evening Rush", 94062)], "a string, h int, b string, n long")
    r = df.select(
        formatting.area_hour_label("a", "h").alias("x"),
        formatting.hour_band_label("h", "b").alias("y"),
        formatting.thousands("n").alias("z"),
        formatting.percent_text(F.lit(12.34)).alias("p"),
        formatting.count_bar(F.lit(9000)).alias("bar"),
    ).collect()[0]
    assert (r.x, r.y, r.z, r.p, r.bar) == ("77th Street  [07:00]", "07:00 (Evening)", "94,062", "12.3%", "###")


def test_dims(spark):
    assert [r.Day_of_Week for r in dims.day_dim(spark).orderBy("Day_Order").collect()][0] == "Monday"
    assert dims.month_dim(spark).count() == 12
    assert [r.Season for r in dims.season_dim(spark).orderBy("Season_Order").collect()] == ["Spring", "Summer", "Fall", "Winter"]


def test_validate_names_all_missing(spark):
    df = spark.createDataFrame([(1,)], "DR_Number long")
    with pytest.raises(schema.SchemaError) as e:
        schema.validate(df)
    assert "Hour" in str(e.value) and "Area_Name" in str(e.value)


def test_validate_rejects_mistyped(spark):
    fields = ", ".join(f"{c} string" if c == "Hour" else f"{c} {schema.COLUMN_TYPES[c].simpleString()}"
                       for c in schema.REQUIRED_COLUMNS)
    df = spark.createDataFrame([], fields)
    with pytest.raises(schema.SchemaError, match="Hour"):
        schema.validate(df)


def _csv(lines):
    d = tempfile.mkdtemp(prefix="crashgrid-csv-")
    p = os.path.join(d, "c.csv")
    with open(p, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return p


HEADER = ",".join(schema.REQUIRED_COLUMNS)


def _line(dr, hour, hotspot, area="Central"):
    vals = dict(DR_Number=dr, Date_Occurred="2024-01-06", Hour=hour, Area_Name=area, Day_of_Week="Saturday",
                Time_of_Day="Late Night", Season="Winter", Is_Weekend="true", Year=2024, Month=1,
                Collision_Severity="Injury Involved", Road_Type="Road", Is_Hotspot=hotspot,
                Congestion_Index="Low", Address="1 Main", Latitude=34.0, Longitude=-118.2)
    return ",".join(str(vals[c]) for c in schema.REQUIRED_COLUMNS)


def test_csv_ingest_flags_optional_and_bad_rows(spark):
    p = _csv([HEADER, _line(1, 3, "True"), _line(2, 4, "false"), _line(3, "abc", "TRUE"), _line(4, 5, "")])
    df = readers.read_collisions_csv(spark, p)
    assert "Victim_Age" in df.columns
    got = {r.DR_Number: (r.Hour, r.Is_Hotspot) for r in df.collect()}
    assert got["1"] == (3, True) and got["2"] == (4, False) and got["4"] == (5, None)
    assert got["3"][0] is None  # the bad value is null, the row is kept
    assert [r[0] for r in df.where("DR_Number = '3'").select("_corrupt_record").collect()] == ["Hour=abc"]
    assert readers.bad_row_count(df) == 1
    schema.validate(df)


def test_csv_text_ids_and_decimal_hours(spark):
    p = _csv([HEADER, _line("A12", "3.0", "True", "X"), _line("B13", "3.5", "True", "X")])
    df = readers.read_collisions_csv(spark, p)
    assert [tuple(r) for r in reports.count_by_area(df).collect()] == [("X", 2)]
    assert {r.DR_Number: r.Hour for r in df.collect()} == {"A12": 3, "B13": None}
    assert readers.bad_row_count(df) == 1


def test_csv_missing_column_one_error(spark):
    cols = [c for c in schema.REQUIRED_COLUMNS if c != "Hour"]
    p = _csv([",".join(cols), ",".join("x" for _ in cols)])
    with pytest.raises(schema.SchemaError, match="Hour"):
        readers.read_collisions_csv(spark, p)


def _files(**lines):
    d = tempfile.mkdtemp(prefix="crashgrid-csv-")
    for name, text in lines.items():
        with open(os.path.join(d, f"{name}.csv"), "w") as fh:
            fh.write("\n".join(text) + "\n" if text else "")
    return d


def _swapped(line, order):
    values = dict(zip(schema.REQUIRED_COLUMNS, line.split(",")))
    return ",".join(values[c] for c in order)


def test_each_csv_file_is_read_by_its_own_header(spark):
    order = [c for c in schema.REQUIRED_COLUMNS if c not in ("Area_Name", "Address")] + ["Address", "Area_Name"]
    line = _line(1, 3, "True", "X")
    d = _files(a=[HEADER, line], b=[",".join(order), _swapped(line, order)], c=[HEADER + ",Note,Victim_Age", line + ",7,30.5"], d=[])
    with gzip.open(f"{d}/e.csv.gz", "wt") as fh:
        fh.write("\n".join([",".join(order), _swapped(line, order)]) + "\n")
    got = readers.read_collisions_csv(spark, d).select("Area_Name", "Address", "Hour", "Victim_Age", "Note", "_corrupt_record").collect()
    assert sorted(map(tuple, got), key=repr) == [("X", "1 Main", 3, 30.5, 7, None)] + [("X", "1 Main", 3, None, None, None)] * 3


def test_a_missing_column_names_its_file(spark):
    short = [c for c in schema.REQUIRED_COLUMNS if c not in ("Hour", "Year")]
    d = _files(good=[HEADER, _line(1, 3, "True")], short=[",".join(short), _swapped(_line(1, 3, "True"), short)], twice=[HEADER + ",Hour", _line(1, 3, "True") + ",4"])
    with pytest.raises(schema.SchemaError) as e:
        readers.read_collisions_csv(spark, d)
    text = str(e.value)
    assert "missing columns: Hour, Year in" in text and "short.csv" in text and "repeated columns: Hour" in text and "twice.csv" in text and "good.csv" not in text


def test_types_of_extra_columns_are_found(spark):
    extra = {"n": ["1", "", "-3"], "big": ["9999999999", "1", ""], "x": ["1.5", "2", ""], "flag": ["true", "False", ""], "day": ["2024-01-05", "", ""],
             "at": ["2024-01-05 10:00:00", "2024-01-06", ""], "word": ["a", "1", ""], "none": ["", "", ""]}
    d = _files(a=[HEADER + "," + ",".join(extra)] + [_line(i, 3, "True") + "," + ",".join(v[i] for v in extra.values()) for i in range(3)])
    got = readers.read_collisions_csv(spark, d)
    kinds = dict(got.dtypes)
    assert {c: kinds[c] for c in extra} == {"n": "int", "big": "bigint", "x": "double", "flag": "boolean", "day": "date", "at": "timestamp", "word": "string", "none": "string"}
    assert [r.n for r in got.orderBy("DR_Number").collect()] == [1, None, -3]
    plain = dict(readers.read_collisions_csv(spark, d, infer_extra=False).dtypes)
    assert all(plain[c] == "string" for c in extra)


def test_single_file_csv_keeps_sort(spark):
    df = spark.range(0, 500).select((F.col("id") % 37).alias("k"), F.col("id")).orderBy(F.col("k").desc(), "id")
    out = tempfile.mkdtemp(prefix="crashgrid-out-") + "/r"
    sinks.write_csv(df.repartition(5).orderBy(F.col("k").desc(), "id"), out, single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-") and f.endswith(".csv")]
    assert len(parts) == 1
    back = spark.read.option("header", True).schema("k long, id long").csv(out).collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in df.collect()]


def test_csv_layout_is_what_the_caller_says(spark):
    root = tempfile.mkdtemp(prefix="crashgrid-out-")
    files = lambda name: [f for f in os.listdir(f"{root}/{name}") if f.endswith(".csv")]
    df = spark.range(0, 100, numPartitions=4)
    sinks.write_catalogue({"one": df, "many": df, "loose": df}, root, single_file={"one", "loose"}, unsorted={"loose"})
    assert (len(files("one")), len(files("many")), len(files("loose"))) == (1, 4, 1)


def test_catalogue_writer(spark):
    root = tempfile.mkdtemp(prefix="crashgrid-cat-")
    df = spark.range(3)
    written = sinks.write_catalogue({"a": df, "b": lambda: df}, root, fmt="parquet")
    assert set(written) == {"a", "b"}
    assert spark.read.parquet(written["b"]).count() == 3
