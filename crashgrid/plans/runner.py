"""Run the named results over a collision table and write each one once.

This is the library's equivalent of submitting the original report scripts:
read the collision table (CSV or Parquet), check its contract, then produce
the published reports, the pattern outputs and the chart tables. Results that
look at the same columns share a small cube (see ``plans.batch``), checkpointed
to the shared folder; only the results that list rows or addresses read the
table again. Rows with values that do not fit are counted and reported.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators import rollups
from ..session import checkpoint_dir
from ..sources import readers, sinks
from . import batch, catalogue
from . import reports as R

# Parameters of the single-area and year-slice chart tables.
CHART_AREA = "77th Street"
CHART_YEARS = (2018, 2019, 2020, 2021, 2022)

# Result names as published; those without a published name are
# called pattern_ or chart_ after where the scripts show them.
# name -> (query of the catalogue, parameters for a collision table)
RESULTS: dict[str, tuple[str, dict]] = {
    **{name: (query, {}) for name, query in {**catalogue.REPORTS, **catalogue.PATTERNS}.items()},
    "pattern_scenario_counts": ("scenario_counts", {}),
    "pattern_yearly_direction": ("yearly_direction", {}),
    "chart_hour_profile": ("hour_profile", {}),
    "chart_hour_labels": ("hour_labels", {}),
    "chart_overall_peak_hour": ("overall_peak_hour", {}),
    "chart_rush_breakdown": ("rush_breakdown", {}),
    "chart_days_with_age": ("calendar_ordered_days", {}),
    "chart_weekend_daily_average": ("weekend_daily_average", {}),
    "chart_weekend_pair": ("weekend_pair", {}),
    "chart_season_share": ("season_share", {}),
    "chart_top10_areas_overlay": ("top10_areas_overlay", {}),
    "chart_top15_hotspot_addresses": ("top15_hotspot_addresses", {}),
    "chart_severity_matrix": ("severity_matrix", {}),
    "chart_severity_matrix_top10": ("severity_matrix_top10", {}),
    "chart_peak_hour_single": ("peak_hour_single", {}),
    "chart_area_stats_with_peak": ("area_stats_with_peak", {}),
    "chart_top5_area_peaks": ("top5_area_peaks", {}),
    "chart_area_hour_heatmap": ("area_hour_heatmap", {}),
    "chart_monthly_profile": ("monthly_profile", {}),
    "chart_single_area_flow": ("single_area_flow", {"area": CHART_AREA}),
    "chart_year_month_slice": ("year_month_slice", {"years": CHART_YEARS}),
    "chart_top20_area_hours": ("top20_area_hours", {}),
    "chart_hour_envelope": ("hour_envelope", {}),
}


def report(name: str, df: DataFrame) -> DataFrame:
    """One result over a collision table or a cube of it."""
    query, parameters = RESULTS[name]
    return getattr(R, query)(df, **parameters)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV or Parquet by extension/format; contract checked, flags normalised."""
    if path.rstrip("/").lower().endswith(".parquet"):
        return readers.read_collisions_parquet(spark, path)
    return readers.read_collisions_csv(spark, path)


def results(df: DataFrame, names: Iterable[str] | None = None, scale: int | None = None) -> dict[str, DataFrame]:
    """name -> result frame. Aggregate results come from checkpointed cubes."""
    chosen = list(names or RESULTS)
    unknown = [n for n in chosen if n not in RESULTS]
    if unknown:
        raise KeyError(f"unknown results: {unknown}")
    queries = {n: catalogue.QUERIES[RESULTS[n][0]] for n in chosen}
    out = {n: report(n, df) for n, q in queries.items() if batch.needs_rows(q)}
    checkpoint_dir(df.sparkSession)
    small = {n: ("table", set(q.columns) - batch.WEIGHT_COLUMNS) for n, q in queries.items() if n not in out}
    groups = {grain: group for (_, grain), group in batch.by_grain(small).items()}
    if groups:  # one scan of the table fills every cube
        for grain, cube in rollups.cubes(df, list(groups), measure="Victim_Age", scale=scale).items():
            cube = rollups.fold_days(cube).checkpoint() if "Date_Occurred" in grain else cube
            out |= {n: report(n, cube) for n in groups[grain]}
    return {n: out[n] for n in chosen}


def run(spark: SparkSession, input_path: str, output: str, names: Iterable[str] | None = None,
        fmt: str = "csv") -> dict[str, str]:
    """Read, check, compute and write every chosen result once. Rows with values
    that do not fit the contract are counted first and a warning says how many:
    their null values drop them from results that need the value."""
    df = read_table(spark, input_path)
    bad = readers.bad_row_count(df)
    if bad:
        warnings.warn(f"{bad} rows of {input_path} have values that do not fit the contract; those values are null", stacklevel=2)
    small = {n for n, (q, _) in RESULTS.items() if not batch.needs_rows(catalogue.QUERIES[q])}
    unsorted = {n for n, (q, _) in RESULTS.items() if q in batch.UNSORTED}
    return sinks.write_catalogue(results(df, names), output, fmt=fmt, single_file=small, unsorted=unsorted)
