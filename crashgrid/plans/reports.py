"""Named results: every report, pattern output and chart table as a
``DataFrame -> DataFrame`` function over a collision-shaped frame.

Counting and null rules follow the three families of results (SURVEY §2.0):

* report family  - ``count(DR_Number)``, null group keys kept;
* pattern family - every row counted, rows with a null key dropped,
                   peak ties broken by the lowest hour;
* chart family   - ``count(DR_Number)``, rows with a null key dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dims, formatting, predicates
from ..functions.enrich import text_flag
from ..operators import combine, matrix, ranking, rollups, trends

ID = "DR_Number"
TOTAL = "Total_Collisions"
CCOUNT = "Collision_Count"


def _desc(col: str, *tiebreak: str):
    return [F.col(col).desc()] + [F.col(t).asc_nulls_first() for t in tiebreak]


# ---------------------------------------------------------------- report family
def count_by_hour_band(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, ["Hour", "Time_of_Day"], TOTAL).orderBy(*_desc(TOTAL, "Hour", "Time_of_Day"))


def count_by_band(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Time_of_Day", TOTAL).orderBy(*_desc(TOTAL, "Time_of_Day"))


def count_by_day(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Day_of_Week", TOTAL).orderBy(*_desc(TOTAL, "Day_of_Week"))


def weekend_split(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Is_Weekend", TOTAL).orderBy(F.col("Is_Weekend").asc_nulls_first())


def count_by_season(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Season", TOTAL).orderBy(*_desc(TOTAL, "Season"))


def count_by_area(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Area_Name", TOTAL).orderBy(*_desc(TOTAL, "Area_Name"))


def congestion_by_area(df: DataFrame, road_value: str = "Road") -> DataFrame:
    return rollups.count_by(
        df, ["Area_Name", "Congestion_Index"], CCOUNT, where=predicates.equals("Road_Type", road_value)
    ).orderBy(*_desc(CCOUNT, "Area_Name", "Congestion_Index"))


def hotspot_addresses(df: DataFrame) -> DataFrame:
    return rollups.count_by(
        df, ["Address", "Area_Name"], CCOUNT, where=predicates.is_true("Is_Hotspot")
    ).orderBy(*_desc(CCOUNT, "Address", "Area_Name"))


def top15_hotspot_addresses(df: DataFrame, n: int = 15) -> DataFrame:
    """The hotspot report's top rows (count desc, then address, area)."""
    return ranking.top_n(hotspot_addresses(df), n, _desc(CCOUNT, "Address", "Area_Name"))


def severity_by_area(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, ["Area_Name", "Collision_Severity"], "Count").orderBy(
        F.col("Area_Name").asc_nulls_first(), F.col("Count").desc(), F.col("Collision_Severity").asc_nulls_first()
    )


def area_hour_cube(df: DataFrame, alias: str = "Hourly_Count", family: str = "report") -> DataFrame:
    """The (area, hour) cube that feeds peaks, flow, heatmap and envelope."""
    if family == "report":
        return rollups.count_by(df, ["Area_Name", "Hour"], alias)
    if family == "chart":
        return rollups.count_by(df, ["Area_Name", "Hour"], alias, null_keys="drop")
    return rollups.count_by(df, ["Area_Name", "Hour"], alias, id_col=None, null_keys="drop")


def peak_hour_per_area(df: DataFrame, ties: str = "all") -> DataFrame:
    """Peak hour per named area; ``ties="all"`` returns every tied hour. Counts and
    maxima are joined by area in the report's definition, so a null area has no
    peak; a null hour is a group like any other."""
    return _peaks(area_hour_cube(df.where(F.col("Area_Name").isNotNull())), ties)


def peak_hour_single(df: DataFrame) -> DataFrame:
    """One peak per area, the lowest hour on ties; unknown hours are no peak."""
    known = df.where(F.col("Area_Name").isNotNull() & F.col("Hour").isNotNull())
    return _peaks(area_hour_cube(known), "first")


def _peaks(cube: DataFrame, ties: str) -> DataFrame:
    if ties == "first":
        peaks = ranking.peak_single(cube, "Area_Name", "Hourly_Count", by="Hour")
    else:
        peaks = ranking.peak(cube, "Area_Name", "Hourly_Count", by="Hour", ties=ties)
    return (
        peaks.select("Area_Name", F.col("Hour").alias("Peak_Hour"), F.col("Hourly_Count").alias("Peak_Collisions"))
        .orderBy(*_desc("Peak_Collisions", "Area_Name", "Peak_Hour"))
    )


def yearly_trend(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Year", TOTAL, where=F.col("Year").isNotNull()).orderBy("Year")


def monthly_trend(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, ["Month", "Season"], TOTAL).orderBy(
        F.col("Month").asc_nulls_first(), F.col("Season").asc_nulls_first()
    )


def hourly_flow(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, ["Area_Name", "Hour"], CCOUNT).orderBy(
        F.col("Area_Name").asc_nulls_first(), F.col("Hour").asc_nulls_first()
    )


def count_by_road_type(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Road_Type", TOTAL).orderBy(*_desc(TOTAL, "Road_Type"))


# --------------------------------------------------------------- pattern family
def evening_rush_rows(df: DataFrame) -> DataFrame:
    """Every row with 17 <= Hour <= 19, five typed columns (nulls stay null)."""
    return df.where(predicates.evening_rush()).select(
        F.col(ID).cast("string").alias("DR_Number"),
        F.col("Area_Name").cast("string").alias("Area_Name"),
        F.col("Hour").cast("int").alias("Hour"),  # never null: the range test drops unknown hours
        F.col("Address").cast("string").alias("Address"),
        F.col("Collision_Severity").cast("string").alias("Severity"),
    )


def hourly_rows(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Hour", CCOUNT, id_col=None, null_keys="drop").orderBy("Hour")


def area_rows(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Area_Name", CCOUNT, id_col=None, null_keys="drop")


def area_hour_rows(df: DataFrame) -> DataFrame:
    return area_hour_cube(df, CCOUNT, family="pattern")


def yearly_rows(df: DataFrame) -> DataFrame:
    return rollups.count_by(df, "Year", CCOUNT, id_col=None, null_keys="drop").orderBy("Year")


def scenario_counts(df: DataFrame, road_value: str = "Road", injury_value: str = "Injury Involved") -> DataFrame:
    """The five filter counts in one scan."""
    return rollups.scenario_counts(
        df,
        {
            "Morning_Rush": predicates.morning_rush(),
            "Evening_Rush": predicates.evening_rush(),
            "Road_Only": predicates.one_of("Road_Type", [road_value]),
            "Hotspot_Only": predicates.is_true("Is_Hotspot"),
            "Injury_Only": predicates.equals("Collision_Severity", injury_value),
        },
    )


def area_peak_percent(df: DataFrame) -> DataFrame:
    """Area total, peak hour, peak count and the peak's percent of the total.

    One aggregation to the (area, hour) cube -- null hours kept as a cell so the
    total counts them -- then one hash aggregation per area: the total is the sum
    of its cells, the peak the mergeable arg-max of those with a known hour (the
    lowest on ties). Areas without a known hour drop out, as an inner join of
    totals and peaks would do.
    """
    cube = rollups.count_by(df, ["Area_Name", "Hour"], CCOUNT, id_col=None, null_keys="keep",
                            where=F.col("Area_Name").isNotNull())
    return (
        cube.groupBy("Area_Name")
        .agg(F.sum(CCOUNT).alias(TOTAL), F.max(ranking.packed(CCOUNT, "Hour")).alias("_best"))
        .where(F.col("_best").isNotNull())
        .select(
            "Area_Name", TOTAL, ranking.peak_by("_best").alias("Peak_Hour"),
            ranking.peak_value("_best").alias("Peak_Hour_Collisions"),
            trends.pct(ranking.peak_value("_best"), F.col(TOTAL)).alias("Peak_Pct"),
        )
        .orderBy(*_desc(TOTAL, "Area_Name"))
    )


# An area's addresses meet its peak on this many join keys.
PEAK_KEYS = 32


def hotspot_with_peak(df: DataFrame) -> DataFrame:
    """Hotspot (area, address) counts with the area's peak hour attached.

    One aggregation of the fact to (area, hour, hotspot address) -- the address
    is kept only on hotspot rows, so the cells are at most areas x 24 plus
    hotspot addresses x 24 -- and both parts are roll-ups of it: the (area,
    hour) counts give the peak by arg-max, the (area, address) counts the
    hotspot rows. Both roll-ups read only the cell count and filter only their
    own outputs, so the shared aggregate stays one sub-plan and is computed
    once. A peak is repeated on ``PEAK_KEYS`` keys over which its area's
    addresses are spread, so an area with most addresses is no single task.
    """
    named = df.where(F.col("Area_Name").isNotNull())
    hot_address = F.when(predicates.is_true("Is_Hotspot"), F.col("Address"))
    cells = named.groupBy("Area_Name", "Hour", hot_address.alias("_addr")).agg(
        rollups.count_col(named, None).alias("_rows")
    )
    per_hour = cells.groupBy("Area_Name", "Hour").agg(F.sum("_rows").alias("_n"))
    peaks = ranking.peak_single(per_hour, "Area_Name", "_n", by="Hour").select(
        "Area_Name", F.col("Hour").alias("Area_Peak_Hour"), F.explode(F.sequence(F.lit(0), F.lit(PEAK_KEYS - 1))).alias("_key")
    )
    hot = (
        cells.groupBy("Area_Name", "_addr")
        .agg(F.sum(F.when(F.col("_addr").isNotNull(), F.col("_rows")).otherwise(F.lit(0))).alias(CCOUNT))
        .where(F.col(CCOUNT) > 0)
        .select("Area_Name", F.col("_addr").alias("Address"), CCOUNT,
                F.pmod(F.xxhash64("_addr"), F.lit(PEAK_KEYS)).cast("int").alias("_key"))
    )
    return (
        hot.join(peaks, ["Area_Name", "_key"], "inner")
        .select("Area_Name", "Address", CCOUNT, "Area_Peak_Hour")
        .orderBy(*_desc(CCOUNT, "Area_Name", "Address"))
    )


def hotspot_address_ranks(df: DataFrame) -> DataFrame:
    """Every hotspot (area, address) with its count, its rank number (count desc,
    then address and area) and its share of all hotspot rows. Addresses are not
    bounded: ranks come from ranges of the order, shares from a one-row total."""
    counts = rollups.count_by(df, ["Address", "Area_Name"], CCOUNT, where=predicates.is_true("Is_Hotspot"))
    ranked = ranking.with_global_rank(counts, _desc(CCOUNT, "Address", "Area_Name"))
    return trends.share(ranked, CCOUNT, digits=4).select("Rank", "Address", "Area_Name", CCOUNT, "Share_Pct")


def top10_hours(df: DataFrame, n: int = 10) -> DataFrame:
    top = ranking.top_n(hourly_rows(df), n, _desc(CCOUNT, "Hour"))
    return ranking.with_rank_number(top, _desc(CCOUNT, "Hour")).select("Rank", "Hour", CCOUNT)


def top5_areas(df: DataFrame, n: int = 5) -> DataFrame:
    top = ranking.top_n(area_rows(df), n, _desc(CCOUNT, "Area_Name"))
    return ranking.with_rank_number(top, _desc(CCOUNT, "Area_Name")).select("Rank", "Area_Name", CCOUNT)


def yearly_direction(df: DataFrame) -> DataFrame:
    return trends.direction(yearly_rows(df), "Year", CCOUNT).orderBy("Year")


# ----------------------------------------------------------------- chart family
def _chart_count(df: DataFrame, keys, alias=TOTAL) -> DataFrame:
    return rollups.count_by(df, keys, alias, null_keys="drop")


def hour_profile(df: DataFrame) -> DataFrame:
    return _chart_count(df, ["Hour", "Time_of_Day"]).orderBy("Hour", "Time_of_Day")


def overall_peak_hour(df: DataFrame) -> DataFrame:
    return ranking.overall_peak(hour_profile(df), TOTAL, by="Hour")


def rush_breakdown(df: DataFrame) -> DataFrame:
    return (
        rollups.count_by(df, ["Time_of_Day", "Hour"], "Rush_Collisions", null_keys="drop", where=predicates.commute_rush())
        .withColumn("Label", formatting.hour_band_label("Hour", "Time_of_Day"))
        .orderBy("Time_of_Day", "Hour")
    )


def day_profile_with_measure(df: DataFrame, scale: int | None = None) -> DataFrame:
    return (
        rollups.count_and_mean(
            df.where(F.col("Day_of_Week").isNotNull()), "Day_of_Week", "Victim_Age", "Avg_Victim_Age", scale=scale
        )
        .orderBy(*_desc(TOTAL, "Day_of_Week"))
    )


def calendar_ordered_days(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Monday..Sunday, a missing day as a row of nulls; unknown labels dropped."""
    spark = df.sparkSession
    return combine.reindex(dims.day_dim(spark), day_profile_with_measure(df, scale), "Day_of_Week", "Day_Order")


def weekend_daily_average(df: DataFrame) -> DataFrame:
    """Per weekend flag: count, exact distinct days, average per day (1 digit).
    Days are counted from bitmaps, which add up from any finer grain."""
    return (
        rollups.count_and_days(df.where(F.col("Is_Weekend").isNotNull()), "Is_Weekend", TOTAL, "Distinct_Days", id_col=ID)
        .withColumn("Avg_Daily", trends.ratio(TOTAL, "Distinct_Days"))
        .orderBy("Is_Weekend")
    )


def weekend_pair(df: DataFrame) -> DataFrame:
    """One row: weekday and weekend totals and daily averages; an absent class
    gives null, not an error."""
    per = weekend_daily_average(df)
    return per.agg(
        F.max(F.when(~F.col("Is_Weekend"), F.col(TOTAL))).alias("Weekday_Total"),
        F.max(F.when(F.col("Is_Weekend"), F.col(TOTAL))).alias("Weekend_Total"),
        F.max(F.when(~F.col("Is_Weekend"), F.col("Avg_Daily"))).alias("Weekday_Avg_Daily"),
        F.max(F.when(F.col("Is_Weekend"), F.col("Avg_Daily"))).alias("Weekend_Avg_Daily"),
    )


def season_share(df: DataFrame) -> DataFrame:
    """Seasons in chart order with count and percent of the shown total."""
    spark = df.sparkSession
    seasonal = _chart_count(df, "Season")
    ordered = dims.season_dim(spark).join(seasonal, "Season", "left")
    return trends.share(ordered, TOTAL).orderBy("Season_Order").drop("Season_Order")


def area_stats(df: DataFrame, scale: int | None = None) -> DataFrame:
    return (
        df.where(F.col("Area_Name").isNotNull())
        .groupBy("Area_Name")
        .agg(
            rollups.count_col(df, ID).alias(TOTAL),
            rollups.count_if_col(df, predicates.is_true("Is_Hotspot")).alias("Hotspot_Count"),
            rollups.mean_col(df, "Victim_Age", scale).alias("Avg_Victim_Age"),
        )
        .orderBy(*_desc(TOTAL, "Area_Name"))
    )


def top10_areas_overlay(df: DataFrame, n: int = 10, scale: int | None = None) -> DataFrame:
    top = ranking.top_n(area_stats(df, scale), n, _desc(TOTAL, "Area_Name"))
    return top.orderBy(F.col(TOTAL).asc(), F.col("Area_Name").desc())


# Severities that always have a column.
SEVERITIES = ("Injury Involved", "Property Damage Only")


def severity_matrix(df: DataFrame, severities: Sequence[str] = SEVERITIES, top: int | None = None) -> DataFrame:
    """Area x severity counts (missing -> 0) with the area total, by total.

    One aggregation to the (area, severity) cube; the matrix and the total are
    both sums over the cube's cells. The given severities have columns, found or
    not; every other severity found in the data has one too, in the order of
    their names. A null one is only in the total.
    """
    cube = rollups.count_by(df, ["Area_Name", "Collision_Severity"], "_n", where=F.col("Area_Name").isNotNull())
    cube, found = matrix.found_values(cube, "Collision_Severity")
    columns = [*severities, *(s for s in found if s not in severities)]
    out = matrix.pivot_sum(cube, "Area_Name", "Collision_Severity", columns, "_n", total=TOTAL)
    order = _desc(TOTAL, "Area_Name")
    if top is None:
        return out.orderBy(*order)
    # the chart draws its top areas from the smallest up
    return ranking.top_n(out, top, order).orderBy(F.col(TOTAL).asc(), F.col("Area_Name").desc())


def severity_matrix_top10(df: DataFrame, severities: Sequence[str] = SEVERITIES) -> DataFrame:
    return severity_matrix(df, severities, top=10)


def area_stats_with_peak(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Area stats with the peak hour (lowest on ties), null peak when an area has
    no known hour. One aggregation to an (area, hour) cube of additive measures
    (counts, exact decimal sums), one more of its cells per area: sums and the
    mergeable arg-max."""
    total, cnt = rollups.sum_parts(df, "Victim_Age", scale)
    cube = (
        df.where(F.col("Area_Name").isNotNull())
        .groupBy("Area_Name", "Hour")
        .agg(
            rollups.count_col(df, ID).alias("_n"),
            rollups.count_if_col(df, predicates.is_true("Is_Hotspot")).alias("_hot"),
            total.alias("_sum"),
            cnt.alias("_cnt"),
        )
    )
    return (
        cube.groupBy("Area_Name")
        .agg(
            F.sum("_n").alias(TOTAL), F.sum("_hot").alias("Hotspot_Count"),
            F.try_divide(F.sum("_sum").cast("double"), F.sum("_cnt").cast("double")).alias("Avg_Victim_Age"),
            F.max(ranking.packed("_n", "Hour")).alias("_best"),
        )
        .select(
            "Area_Name", TOTAL, "Hotspot_Count", "Avg_Victim_Age",
            ranking.peak_by("_best").alias("Peak_Hour"), ranking.peak_value("_best").alias("Peak_Collisions"),
        )
        .orderBy(*_desc(TOTAL, "Area_Name"))
    )


def top5_area_peaks(df: DataFrame, n: int = 5, scale: int | None = None) -> DataFrame:
    """The first areas of the stats-with-peak table (the annotated points)."""
    return ranking.top_n(area_stats_with_peak(df, scale), n, _desc(TOTAL, "Area_Name"))


def monthly_profile(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    mt = _chart_count(df, ["Month", "Season"])
    return mt.join(F.broadcast(dims.month_dim(spark)), "Month", "left").orderBy("Month", "Season")


def single_area_flow(df: DataFrame, area: str) -> DataFrame:
    return (
        _chart_count(df.where(predicates.equals("Area_Name", area)), ["Hour", "Time_of_Day"], CCOUNT)
        .orderBy("Hour", "Time_of_Day")
    )


def year_month_slice(df: DataFrame, years: Sequence[int]) -> DataFrame:
    spark = df.sparkSession
    sl = _chart_count(df.where(predicates.one_of("Year", years)), ["Year", "Month"], "Monthly_Collisions")
    return sl.join(F.broadcast(dims.month_dim(spark)), "Month", "left").select(
        "Year", "Month", "Monthly_Collisions", "MonthName"
    ).orderBy("Year", "Month")


def top20_area_hours(df: DataFrame, n: int = 20) -> DataFrame:
    cube = area_hour_cube(df, CCOUNT, family="chart")
    top = ranking.top_n(cube, n, _desc(CCOUNT, "Area_Name", "Hour"))
    return top.withColumn("Label", formatting.area_hour_label("Area_Name", "Hour")).orderBy(
        F.col(CCOUNT).asc(), F.col("Area_Name").desc(), F.col("Hour").desc()
    )


def hour_labels(df: DataFrame, unit: int = 3000) -> DataFrame:
    """The hour profile as the console prints it: clock text, count with
    thousands, share of all as text, a bar, the band in lower case, and whether
    the band is a rush, read back from text."""
    shown = trends.share(hour_profile(df), TOTAL)
    rush = F.initcap(F.col("Time_of_Day").contains("Rush").cast("string"))
    return shown.select(
        formatting.hour_text("Hour").alias("Clock"),
        formatting.thousands(TOTAL).alias("Count_Text"),
        formatting.percent_text("Share_Pct").alias("Share_Text"),
        formatting.count_bar(TOTAL, unit).alias("Bar"),
        F.lower("Time_of_Day").alias("Band"),
        text_flag(rush).alias("Is_Rush"),
    ).orderBy("Clock")


HOUR_COLUMNS = [f"H{h:02d}" for h in range(24)]


def area_hour_heatmap(df: DataFrame) -> DataFrame:
    """Area x hour matrix (24 fixed columns H00..H23, missing -> 0), by area total.
    One aggregation to the (area, hour) cube; cells and total are sums over it."""
    cube = rollups.count_by(df, ["Area_Name", "Hour"], "_n", where=F.col("Area_Name").isNotNull())
    out = matrix.pivot_sum(cube, "Area_Name", "Hour", list(range(24)), "_n", names=HOUR_COLUMNS, total=TOTAL)
    return out.orderBy(*_desc(TOTAL, "Area_Name"))


def hour_envelope(df: DataFrame) -> DataFrame:
    """Per hour present: total, mean, max, min across areas (absent area-hours are
    0) and the total rescaled to the highest mean. One cube, one pass."""
    cube = area_hour_cube(df, CCOUNT, family="chart")
    env = matrix.envelope(cube, "Area_Name", "Hour", CCOUNT)
    return trends.rescale_to_max(env, "Total", "Mean", "Total_Scaled").orderBy("Hour")
