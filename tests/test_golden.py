"""Golden replay: the published hour and year totals, expanded back to rows.

Fixed values (the published results for the full collision table, 621,677 rows):
  hour -> total:  0:16596 1:15222 2:15494 3:10108 4:7475 5:8540 6:13231 7:25880
                  8:29230 9:25721 10:26841 11:28842 12:33441 13:33950 14:36604
                  15:39361 16:38546 17:41828 18:39322 19:33362 20:29398 21:26973
                  22:23956 23:21756
  year -> total:  2010:45098 2011:45280 2012:45409 2013:45040 2014:46957
                  2015:52488 2016:56532 2017:57727 2018:57159 2019:56628
                  2020:42385 2021:18796 2022:16417 2023:16461 2024:16720 2025:2580
  rush counts:    6-9: 94,062   17-19: 114,512   7-9 or 17-19: 195,343
  directions:     flat up up down up up up up down down down down down up up down
"""

from pyspark.sql import functions as F

from crashgrid.functions.enrich import hour_band
from crashgrid.plans import reports as R

HOUR_TOTALS = {
    0: 16596, 1: 15222, 2: 15494, 3: 10108, 4: 7475, 5: 8540, 6: 13231, 7: 25880,
    8: 29230, 9: 25721, 10: 26841, 11: 28842, 12: 33441, 13: 33950, 14: 36604,
    15: 39361, 16: 38546, 17: 41828, 18: 39322, 19: 33362, 20: 29398, 21: 26973,
    22: 23956, 23: 21756,
}
YEAR_TOTALS = {
    2010: 45098, 2011: 45280, 2012: 45409, 2013: 45040, 2014: 46957, 2015: 52488,
    2016: 56532, 2017: 57727, 2018: 57159, 2019: 56628, 2020: 42385, 2021: 18796,
    2022: 16417, 2023: 16461, 2024: 16720, 2025: 2580,
}
DIRECTIONS = "flat up up down up up up up down down down down down up up down".split()
BAND_TOTALS = {"Late Night": 73435, "Morning Rush": 94062, "Mid Morning": 89124,
               "Afternoon": 148461, "Evening Rush": 114512, "Night": 102083}


def _expand(spark, totals: dict[int, int], key: str):
    counts = spark.createDataFrame(list(totals.items()), f"{key} int, n long")
    return counts.select(
        F.col(key), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_i")
    ).select(
        F.monotonically_increasing_id().alias("DR_Number"), F.col(key)
    )


def test_hours_replay(spark):
    base = _expand(spark, HOUR_TOTALS, "Hour").withColumn("Time_of_Day", hour_band("Hour"))
    assert base.count() == 621677
    by_hour = R.count_by_hour_band(base).collect()
    assert {r.Hour: r.Total_Collisions for r in by_hour} == HOUR_TOTALS
    assert by_hour[0].Hour == 17 and by_hour[-1].Hour == 4
    bands = {r.Time_of_Day: r.Total_Collisions for r in R.count_by_band(base).collect()}
    assert bands == BAND_TOTALS
    s = R.scenario_counts(base.withColumns({
        "Road_Type": F.lit("Road"), "Is_Hotspot": F.lit(False), "Collision_Severity": F.lit("x")})).collect()[0]
    assert (s.Morning_Rush, s.Evening_Rush) == (94062, 114512)
    rush = R.rush_breakdown(base).agg(F.sum("Rush_Collisions")).collect()[0][0]
    assert rush == 195343
    top = R.top10_hours(base).collect()
    assert [r.Hour for r in top][:3] == [17, 15, 18]
    assert R.overall_peak_hour(base).collect()[0].Hour == 17


def test_years_replay(spark):
    base = _expand(spark, YEAR_TOTALS, "Year")
    trend = R.yearly_trend(base).collect()
    assert [(r.Year, r.Total_Collisions) for r in trend] == sorted(YEAR_TOTALS.items())
    assert [r.Direction for r in R.yearly_direction(base).collect()] == DIRECTIONS
