"""Query registry: each named query = source view + columns it needs + report.

``run(spark, sf_dir, name)`` builds the source with only the needed columns
(so unused joins are never planned) and applies the report function. The
published report and pattern names map onto the same queries.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators import rollups
from ..sources import adapters
from . import reports as R

SHORT = adapters.EVENTS   # hours, days, weekend, areas, sites
LONG = adapters.ORDERS    # years, months, seasons

# Parameters of the driver-table adapters (the collision data uses the
# defaults in ``reports``: 'Road', 'Injury Involved', ...).
ROAD_VALUE = "view"
INJURY_VALUE = "major"
SINGLE_AREA = "NATION_10"
SLICE_YEARS = (1996, 1997, 1998, 1999, 2000)
# Measures of the driver tables are summed as decimals of this many digits, so
# that means do not depend on the order rows are read in.
MEASURE_SCALE = 6
BAR_UNIT = 100


@dataclass(frozen=True)
class Query:
    """A report and what it reads: a cube if it looks at areas or sites, unless it
    lists base rows (``rows``); else the rows, which it aggregates itself."""

    name: str
    fn: Callable[[DataFrame], DataFrame]
    source: adapters.View
    columns: tuple[str, ...]
    rows: bool = field(default=False)
    years: tuple[int, ...] | None = field(default=None)

    def build(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        if self.rows or not adapters.JOINED & set(self.columns):
            return self.fn(self.source.rows(spark, sf_dir, self.columns, self.years))
        return self.fn(adapters.incident_cube(spark, sf_dir, self.source, self.columns, self.years, MEASURE_SCALE))


def _q(name, fn, source, *columns, rows=False, years=None):
    """``rows=True``: the result lists base rows. ``years``: the query only looks
    at those years, so the scan may skip the rest."""
    return Query(name, fn, source, tuple(columns), rows, years)


_ID = "DR_Number"
QUERIES: dict[str, Query] = {
    q.name: q
    for q in [
        _q("count_by_hour_band", R.count_by_hour_band, SHORT, _ID, "Hour", "Time_of_Day"),
        _q("count_by_band", R.count_by_band, SHORT, _ID, "Time_of_Day"),
        _q("count_by_day", R.count_by_day, SHORT, _ID, "Day_of_Week"),
        _q("day_profile_with_measure", partial(R.day_profile_with_measure, scale=MEASURE_SCALE), SHORT, _ID, "Day_of_Week", "Victim_Age"),
        _q("weekend_split", R.weekend_split, SHORT, _ID, "Is_Weekend"),
        _q("weekend_daily_average", R.weekend_daily_average, SHORT, _ID, "Is_Weekend", "Date_Occurred"),
        _q("weekend_pair", R.weekend_pair, SHORT, _ID, "Is_Weekend", "Date_Occurred"),
        _q("count_by_season", R.count_by_season, LONG, _ID, "Season"),
        _q("season_share", R.season_share, LONG, _ID, "Season"),
        _q("count_by_area", R.count_by_area, SHORT, _ID, "Area_Name"),
        _q("area_stats", partial(R.area_stats, scale=MEASURE_SCALE), SHORT, _ID, "Area_Name", "Is_Hotspot", "Victim_Age"),
        _q("congestion_by_area", partial(R.congestion_by_area, road_value=ROAD_VALUE), SHORT,
           _ID, "Area_Name", "Congestion_Index", "Road_Type"),
        _q("hotspot_addresses", R.hotspot_addresses, SHORT, _ID, "Address", "Area_Name", "Is_Hotspot"),
        _q("top15_hotspot_addresses", R.top15_hotspot_addresses, SHORT, _ID, "Address", "Area_Name", "Is_Hotspot"),
        _q("hotspot_address_ranks", R.hotspot_address_ranks, SHORT, _ID, "Address", "Area_Name", "Is_Hotspot"),
        _q("severity_by_area", R.severity_by_area, SHORT, _ID, "Area_Name", "Collision_Severity"),
        _q("severity_matrix", partial(R.severity_matrix, severities=()), SHORT,
           _ID, "Area_Name", "Collision_Severity"),
        _q("severity_matrix_top10", partial(R.severity_matrix_top10, severities=()), SHORT,
           _ID, "Area_Name", "Collision_Severity"),
        _q("peak_hour_per_area", R.peak_hour_per_area, SHORT, _ID, "Area_Name", "Hour"),
        _q("peak_hour_single", R.peak_hour_single, SHORT, _ID, "Area_Name", "Hour"),
        _q("area_peak_percent", R.area_peak_percent, SHORT, "Area_Name", "Hour"),
        _q("hotspot_with_peak", R.hotspot_with_peak, SHORT, "Area_Name", "Hour", "Address", "Is_Hotspot"),
        _q("area_stats_with_peak", partial(R.area_stats_with_peak, scale=MEASURE_SCALE), SHORT, _ID, "Area_Name", "Hour", "Is_Hotspot", "Victim_Age"),
        _q("top5_area_peaks", partial(R.top5_area_peaks, scale=MEASURE_SCALE), SHORT, _ID, "Area_Name", "Hour", "Is_Hotspot", "Victim_Age"),
        _q("yearly_trend", R.yearly_trend, LONG, _ID, "Year"),
        _q("yearly_direction", R.yearly_direction, LONG, "Year"),
        _q("monthly_trend", R.monthly_trend, LONG, _ID, "Month", "Season"),
        _q("monthly_profile", R.monthly_profile, LONG, _ID, "Month", "Season"),
        _q("year_month_slice", partial(R.year_month_slice, years=SLICE_YEARS), LONG, _ID, "Year", "Month",
           years=SLICE_YEARS),
        _q("hourly_flow", R.hourly_flow, SHORT, _ID, "Area_Name", "Hour"),
        _q("single_area_flow", partial(R.single_area_flow, area=SINGLE_AREA), SHORT,
           _ID, "Area_Name", "Hour", "Time_of_Day"),
        _q("count_by_road_type", R.count_by_road_type, SHORT, _ID, "Road_Type"),
        _q("rush_breakdown", R.rush_breakdown, SHORT, _ID, "Hour", "Time_of_Day"),
        _q("scenario_counts", partial(R.scenario_counts, road_value=ROAD_VALUE, injury_value=INJURY_VALUE), SHORT,
           "Hour", "Road_Type", "Is_Hotspot", "Collision_Severity"),
        _q("evening_rush_rows", R.evening_rush_rows, SHORT, _ID, "Area_Name", "Hour", "Address", "Collision_Severity",
           rows=True),
        _q("hourly_rows", R.hourly_rows, SHORT, "Hour"),
        _q("area_rows", R.area_rows, SHORT, "Area_Name"),
        _q("area_hour_rows", R.area_hour_rows, SHORT, "Area_Name", "Hour"),
        _q("yearly_rows", R.yearly_rows, LONG, "Year"),
        _q("top10_hours", R.top10_hours, SHORT, "Hour"),
        _q("top5_areas", R.top5_areas, SHORT, "Area_Name"),
        _q("top10_areas_overlay", partial(R.top10_areas_overlay, scale=MEASURE_SCALE), SHORT, _ID, "Area_Name", "Is_Hotspot", "Victim_Age"),
        _q("top20_area_hours", R.top20_area_hours, SHORT, _ID, "Area_Name", "Hour"),
        _q("area_hour_heatmap", R.area_hour_heatmap, SHORT, _ID, "Area_Name", "Hour"),
        _q("hour_envelope", R.hour_envelope, SHORT, _ID, "Area_Name", "Hour"),
        _q("calendar_ordered_days", partial(R.calendar_ordered_days, scale=MEASURE_SCALE), SHORT, _ID, "Day_of_Week", "Victim_Age"),
        _q("overall_peak_hour", R.overall_peak_hour, SHORT, _ID, "Hour", "Time_of_Day"),
        _q("hour_labels", partial(R.hour_labels, unit=BAR_UNIT), SHORT, _ID, "Hour", "Time_of_Day"),
        _q("row_and_partition_counts", rollups.row_and_partition_counts, SHORT, _ID, rows=True),
        _q("row_count", rollups.row_count, SHORT, _ID, rows=True),
        _q("hour_profile", R.hour_profile, SHORT, _ID, "Hour", "Time_of_Day"),
    ]
}

# Published report and pattern names.
# Report name (saved by the DataFrame script) -> query.
REPORTS = {
    "obj1_peak_hours": "count_by_hour_band",
    "obj1_time_of_day": "count_by_band",
    "obj1_day_of_week": "count_by_day",
    "obj1_weekend_vs_weekday": "weekend_split",
    "obj1_seasonal": "count_by_season",
    "obj2_dangerous_areas": "count_by_area",
    "obj2_road_congestion": "congestion_by_area",
    "obj2_hotspot_addresses": "hotspot_addresses",
    "obj2_severity_by_area": "severity_by_area",
    "obj2_peak_hour_per_district": "peak_hour_per_area",
    "obj3_yearly_trend": "yearly_trend",
    "obj3_monthly_trend": "monthly_trend",
    "obj3_hourly_flow": "hourly_flow",
    "obj3_road_type": "count_by_road_type",
}

# Pattern output names -> query.
PATTERNS = {
    "pattern1_filter_evening_rush": "evening_rush_rows",
    "pattern2_agg_hourly_count": "hourly_rows",
    "pattern2_agg_area_count": "area_rows",
    "pattern2_agg_area_hour_count": "area_hour_rows",
    "pattern2_agg_yearly_trend": "yearly_rows",
    "pattern4_join_area_peak_hour": "area_peak_percent",
    "pattern4_join_hotspot_area": "hotspot_with_peak",
    "pattern3_sort_top_peak_hours": "top10_hours",
    "pattern3_sort_top_areas": "top5_areas",
}


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in REPORTS:
        name = REPORTS[name]
    elif name in PATTERNS:
        name = PATTERNS[name]
    return QUERIES[name].build(spark, sf_dir)


def query_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.build for name, q in QUERIES.items()}
