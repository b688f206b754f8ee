"""Hand-made collision rows for edge cases (FIXTURES.md F4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashgrid.functions.enrich import enrich
from crashgrid.sources.schema import collision_schema

_BASE = dict(
    DR_Number=None, Date_Occurred=dt.date(2024, 1, 1), Hour=0, Area_Name="A",
    Day_of_Week=None, Time_of_Day=None, Season=None, Is_Weekend=None, Year=None, Month=None,
    Collision_Severity="Injury Involved", Road_Type="Road", Is_Hotspot=False,
    Congestion_Index="Low", Address="1 Main St", Latitude=0.0, Longitude=0.0, Victim_Age=30.0,
)


def rows(spark: SparkSession, specs: list[dict], derive: bool = True) -> DataFrame:
    """Build a collision frame; unspecified columns take defaults, ids are
    numbered unless given, calendar columns are derived from date and hour."""
    schema = collision_schema()
    data = []
    for i, spec in enumerate(specs):
        r = dict(_BASE)
        r["DR_Number"] = i + 1
        r.update(spec)
        r["DR_Number"] = None if r["DR_Number"] is None else str(r["DR_Number"])
        data.append(tuple(r[f.name] for f in schema.fields))
    df = spark.createDataFrame(data, schema)
    if derive:
        derived = ["Day_of_Week", "Time_of_Day", "Season", "Is_Weekend", "Year", "Month"]
        keep = [c for c in df.columns if c not in derived]
        explicit = {c for spec in specs for c in spec if c in derived}
        df = enrich(df.select(*keep, *[F.col(c) for c in explicit]), overwrite=False)
    return df


def hour_rows(spark: SparkSession, area: str, hour_counts: dict[int, int], start_id: int = 1) -> list[dict]:
    out = []
    for h, n in hour_counts.items():
        for _ in range(n):
            out.append({"Area_Name": area, "Hour": h, "DR_Number": start_id})
            start_id += 1
    return out
