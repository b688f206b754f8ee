"""Run the whole catalogue from a few small roll-ups per source.

Running the queries one by one scans and joins the fact table as many times.
Here every query is answered from a cube (``operators.rollups``) that a handful
of queries share. A cube's grain is what they look at and no more, and all cubes
of a source are filled by one scan of its table. Dates are in no cube: a cube
that is asked for distinct days has them as bitmaps, which add up. Cubes are
checkpointed to the shared checkpoint folder, so a lost executor does not lead
back to the fact.

Only the queries that need row-level columns (``Address``, the rows
themselves) read the fact again.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators import rollups
from ..session import checkpoint_dir
from ..sources import adapters
from . import catalogue

ROW_LEVEL_COLUMNS = {"Address", "Latitude", "Longitude"}
WEIGHT_COLUMNS = {"DR_Number", "Victim_Age"}
UNSORTED = {"area_rows", "area_hour_rows", "scenario_counts"}


def needs_rows(q: catalogue.Query) -> bool:
    return q.rows or bool(ROW_LEVEL_COLUMNS & set(q.columns))


# What is looked at together. A query reads the first grain that has its columns;
# a grain is pruned to the columns of the queries that read it.
GRAINS = (
    ("Area_Name", "Hour", "Time_of_Day"),
    ("Area_Name", "Collision_Severity"),
    ("Day_of_Week", "Is_Weekend", "Date_Occurred"),
    ("Year", "Month", "Season"),
    ("Hour", "Road_Type", "Collision_Severity", "Is_Hotspot"),
    ("Area_Name", "Is_Hotspot", "Hour"),
    ("Area_Name", "Congestion_Index", "Road_Type"),
)


def assign(queries: Iterable[catalogue.Query]) -> dict[tuple, list[catalogue.Query]]:
    """(source name, grain) -> queries; a query that no grain fits has its own."""
    return by_grain({q: (q.source.table, set(q.columns) - WEIGHT_COLUMNS) for q in queries})


def by_grain(wanted: Mapping) -> dict[tuple, list]:
    """name -> (source, columns) turned into (source, pruned grain) -> names."""
    groups: dict[tuple, list] = {}
    for name, (source, columns) in wanted.items():
        grain = next((g for g in GRAINS if columns <= set(g)), tuple(sorted(columns)))
        groups.setdefault((source, grain), []).append(name)
    return {
        (source, tuple(c for c in grain if any(c in wanted[n][1] for n in names))): names
        for (source, grain), names in groups.items()
    }


def build_cubes(
    spark: SparkSession, sf_dir: str, source: adapters.View, grains: Iterable[Iterable[str]], scale: int | None = catalogue.MEASURE_SCALE
) -> dict[tuple[str, ...], DataFrame]:
    """The weighted cubes of one source, all grains from one scan of it (eager,
    checkpointed). Dates of a grain become days that add up (``rollups.fold_days``)."""
    found = adapters.incident_cubes(spark, sf_dir, source, [tuple(g) for g in grains], scale)
    return {g: rollups.fold_days(c).checkpoint() if "Date_Occurred" in g else c for g, c in found.items()}


def batch_frames(spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """name -> result frame for the chosen queries (all by default)."""
    chosen = {n: catalogue.QUERIES[n] for n in (names or catalogue.QUERIES)}
    out = {n: q.build(spark, sf_dir) for n, q in chosen.items() if needs_rows(q)}
    by_source: dict[str, dict[tuple, list[catalogue.Query]]] = {}
    for (source, grain), qs in assign(q for q in chosen.values() if not needs_rows(q)).items():
        by_source.setdefault(source, {})[grain] = qs
    for groups in by_source.values():
        view = next(iter(groups.values()))[0].source
        for grain, cube in build_cubes(spark, sf_dir, view, groups).items():
            out |= {q.name: q.fn(cube) for q in groups[grain]}
    return {n: out[n] for n in chosen}


def write_batch(
    spark: SparkSession, sf_dir: str, out_root: str, names: Iterable[str] | None = None, fmt: str = "csv"
) -> dict[str, str]:
    """Write every chosen result once under ``out_root/<name>``."""
    from ..sources.sinks import write_catalogue

    small = {n for n, q in catalogue.QUERIES.items() if not needs_rows(q)}
    return write_catalogue(batch_frames(spark, sf_dir, names), out_root, fmt=fmt, single_file=small, unsorted=UNSORTED)
