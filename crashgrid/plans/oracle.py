"""Independent DuckDB SQL for the registered queries (the correctness oracle),
all but ``row_and_partition_counts``: SQL knows no partitions (its rows are
``row_count``).

Written directly against the driver's tables (``events``, ``orders``,
``customer``, ``nation``), sharing nothing with the Spark code but the rules
documented in ``sources.adapters``. Types are pinned to what Spark returns:
INTEGER for hour/year/month and rank numbers, BIGINT for counts, DOUBLE for
means and percents (half-even rounding = ``round_even``).
"""

from __future__ import annotations

from .catalogue import BAR_UNIT, INJURY_VALUE, ROAD_VALUE, SINGLE_AREA, SLICE_YEARS


def _site_sql(fact: str, site: str) -> str:
    share = "CAST(cnt AS HUGEINT) * sites * 100"
    return f"""
site_counts AS (
  SELECT {site} AS site, COUNT(*) AS cnt FROM {fact} WHERE {site} IS NOT NULL GROUP BY {site}
),
site_tot AS (SELECT SUM(cnt) AS total, COUNT(*) AS sites FROM site_counts),
site_cls AS (
  SELECT site,
         {share} >= total * 115 AS is_hot,
         CASE WHEN {share} >= total * 115 THEN 'Critical'
              WHEN {share} >= total * 100 THEN 'High'
              WHEN {share} >= total * 85 THEN 'Medium'
              ELSE 'Low' END AS congestion
  FROM site_counts CROSS JOIN site_tot
),
dim AS (
  SELECT c.c_custkey, n.n_name, s.is_hot, s.congestion
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN site_cls s ON c.c_custkey = s.site
)"""


def _time_cols(ts: str) -> str:
    return f"""
    CAST({ts} AS DATE) AS Date_Occurred,
    CAST(hour({ts}) AS INTEGER) AS Hour,
    dayname({ts}) AS Day_of_Week,
    CASE WHEN hour({ts}) BETWEEN 0 AND 5 THEN 'Late Night'
         WHEN hour({ts}) BETWEEN 6 AND 9 THEN 'Morning Rush'
         WHEN hour({ts}) BETWEEN 10 AND 12 THEN 'Mid Morning'
         WHEN hour({ts}) BETWEEN 13 AND 16 THEN 'Afternoon'
         WHEN hour({ts}) BETWEEN 17 AND 19 THEN 'Evening Rush'
         WHEN hour({ts}) BETWEEN 20 AND 23 THEN 'Night' END AS Time_of_Day,
    CASE WHEN month({ts}) IN (12, 1, 2) THEN 'Winter'
         WHEN month({ts}) IN (3, 4, 5) THEN 'Spring'
         WHEN month({ts}) IN (6, 7, 8) THEN 'Summer'
         WHEN month({ts}) IN (9, 10, 11) THEN 'Fall' END AS Season,
    isodow({ts}) >= 6 AS Is_Weekend,
    CAST(year({ts}) AS INTEGER) AS Year,
    CAST(month({ts}) AS INTEGER) AS Month"""


INCIDENTS = f"""WITH {_site_sql('events', 'user_id')},
inc AS (
  SELECT e.event_id AS DR_Number, {_time_cols('e.ts')},
    d.n_name AS Area_Name,
    CASE WHEN e.event_type = 'error' THEN 'major' WHEN e.event_type IS NOT NULL THEN 'minor' END
      AS Collision_Severity,
    e.event_type AS Road_Type,
    d.is_hot AS Is_Hotspot,
    d.congestion AS Congestion_Index,
    CAST(e.user_id AS VARCHAR) AS Address,
    e.value AS Victim_Age
  FROM events e
  LEFT JOIN dim d ON e.user_id = d.c_custkey
)"""

INCIDENTS_LONG = f"""WITH {_site_sql('orders', 'o_custkey')},
inc AS (
  SELECT o.o_orderkey AS DR_Number, {_time_cols('o.o_orderdate')},
    d.n_name AS Area_Name,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'major'
         WHEN o.o_orderpriority IS NOT NULL THEN 'minor' END AS Collision_Severity,
    o.o_orderstatus AS Road_Type,
    d.is_hot AS Is_Hotspot,
    d.congestion AS Congestion_Index,
    CAST(o.o_custkey AS VARCHAR) AS Address,
    o.o_totalprice AS Victim_Age
  FROM orders o
  LEFT JOIN dim d ON o.o_custkey = d.c_custkey
)"""

_VALUE = "CASE WHEN isfinite(Victim_Age) THEN CAST(Victim_Age AS DECIMAL(38,6)) END"
_MEAN = f"CAST(SUM({_VALUE}) AS DOUBLE) / CAST(COUNT({_VALUE}) AS DOUBLE)"
_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
_PCT = "round_even(CAST({p} AS DOUBLE) / CAST({w} AS DOUBLE) * 100.0, 1)"

_AREA_PEAKS_PATTERN = """
ah AS (
  SELECT Area_Name, Hour, COUNT(*) AS Collision_Count FROM inc
  WHERE Area_Name IS NOT NULL AND Hour IS NOT NULL GROUP BY Area_Name, Hour
),
pk AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY Area_Name ORDER BY Collision_Count DESC, Hour) AS rn FROM ah
  ) WHERE rn = 1
)"""

_AREA_STATS = f"""
st AS (
  SELECT Area_Name, COUNT(DR_Number) AS Total_Collisions,
         COUNT(*) FILTER (WHERE COALESCE(Is_Hotspot, false)) AS Hotspot_Count,
         {_MEAN} AS Avg_Victim_Age
  FROM inc WHERE Area_Name IS NOT NULL GROUP BY Area_Name
)"""

_DAY_PROFILE = f"""
dp AS (
  SELECT Day_of_Week, COUNT(DR_Number) AS Total_Collisions, {_MEAN} AS Avg_Victim_Age
  FROM inc WHERE Day_of_Week IS NOT NULL GROUP BY Day_of_Week
)"""

_WEEKEND = """
wk AS (
  SELECT Is_Weekend, COUNT(DR_Number) AS Total_Collisions,
         COUNT(DISTINCT Date_Occurred) AS Distinct_Days,
         round_even(CAST(COUNT(DR_Number) AS DOUBLE) / CAST(COUNT(DISTINCT Date_Occurred) AS DOUBLE), 1) AS Avg_Daily
  FROM inc WHERE Is_Weekend IS NOT NULL GROUP BY Is_Weekend
)"""

_CHART_CUBE = """
cube AS (
  SELECT Area_Name, Hour, COUNT(DR_Number) AS Collision_Count FROM inc
  WHERE Area_Name IS NOT NULL AND Hour IS NOT NULL GROUP BY Area_Name, Hour
)"""

_HOUR_COLS = ",\n  ".join(
    f"COUNT(DR_Number) FILTER (WHERE Hour = {h}) AS H{h:02d}" for h in range(24)
)

_sev_cols = ",\n  ".join(
    f"COUNT(DR_Number) FILTER (WHERE Collision_Severity = '{s}') AS \"{s}\"" for s in ("major", "minor")
)
_years = ", ".join(str(y) for y in SLICE_YEARS)

ORACLE_SQL: dict[str, str] = {
    "count_by_hour_band": f"""{INCIDENTS}
SELECT Hour, Time_of_Day, COUNT(DR_Number) AS Total_Collisions FROM inc
GROUP BY Hour, Time_of_Day ORDER BY Total_Collisions DESC, Hour""",
    "count_by_band": f"""{INCIDENTS}
SELECT Time_of_Day, COUNT(DR_Number) AS Total_Collisions FROM inc
GROUP BY Time_of_Day ORDER BY Total_Collisions DESC""",
    "count_by_day": f"""{INCIDENTS}
SELECT Day_of_Week, COUNT(DR_Number) AS Total_Collisions FROM inc
GROUP BY Day_of_Week ORDER BY Total_Collisions DESC""",
    "day_profile_with_measure": f"""{INCIDENTS}, {_DAY_PROFILE}
SELECT * FROM dp ORDER BY Total_Collisions DESC""",
    "weekend_split": f"""{INCIDENTS}
SELECT Is_Weekend, COUNT(DR_Number) AS Total_Collisions FROM inc
GROUP BY Is_Weekend ORDER BY Is_Weekend""",
    "weekend_daily_average": f"""{INCIDENTS}, {_WEEKEND}
SELECT * FROM wk ORDER BY Is_Weekend""",
    "weekend_pair": f"""{INCIDENTS}, {_WEEKEND}
SELECT MAX(CASE WHEN NOT Is_Weekend THEN Total_Collisions END) AS Weekday_Total,
       MAX(CASE WHEN Is_Weekend THEN Total_Collisions END) AS Weekend_Total,
       MAX(CASE WHEN NOT Is_Weekend THEN Avg_Daily END) AS Weekday_Avg_Daily,
       MAX(CASE WHEN Is_Weekend THEN Avg_Daily END) AS Weekend_Avg_Daily
FROM wk""",
    "count_by_season": f"""{INCIDENTS_LONG}
SELECT Season, COUNT(DR_Number) AS Total_Collisions FROM inc
GROUP BY Season ORDER BY Total_Collisions DESC""",
    "season_share": f"""{INCIDENTS_LONG},
sd AS (SELECT * FROM (VALUES ('Spring', 0), ('Summer', 1), ('Fall', 2), ('Winter', 3)) t(Season, ord)),
sc AS (SELECT Season, COUNT(DR_Number) AS Total_Collisions FROM inc WHERE Season IS NOT NULL GROUP BY Season)
SELECT sd.Season, sc.Total_Collisions,
       {_PCT.format(p='sc.Total_Collisions', w='SUM(sc.Total_Collisions) OVER ()')} AS Share_Pct
FROM sd LEFT JOIN sc ON sd.Season = sc.Season ORDER BY sd.ord""",
    "count_by_area": f"""{INCIDENTS}
SELECT Area_Name, COUNT(DR_Number) AS Total_Collisions FROM inc
GROUP BY Area_Name ORDER BY Total_Collisions DESC""",
    "area_stats": f"""{INCIDENTS}, {_AREA_STATS}
SELECT * FROM st ORDER BY Total_Collisions DESC, Area_Name""",
    "congestion_by_area": f"""{INCIDENTS}
SELECT Area_Name, Congestion_Index, COUNT(DR_Number) AS Collision_Count FROM inc
WHERE Road_Type = '{ROAD_VALUE}'
GROUP BY Area_Name, Congestion_Index ORDER BY Collision_Count DESC""",
    "hotspot_addresses": f"""{INCIDENTS}
SELECT Address, Area_Name, COUNT(DR_Number) AS Collision_Count FROM inc
WHERE Is_Hotspot GROUP BY Address, Area_Name ORDER BY Collision_Count DESC""",
    "hotspot_address_ranks": f"""{INCIDENTS}
SELECT row_number() OVER (ORDER BY Collision_Count DESC, Address NULLS FIRST, Area_Name NULLS FIRST)::BIGINT AS Rank, Address, Area_Name, Collision_Count,
  round_even(Collision_Count / CAST(SUM(Collision_Count) OVER () AS DOUBLE) * 100, 4) AS Share_Pct
FROM (SELECT Address, Area_Name, COUNT(DR_Number) AS Collision_Count FROM inc WHERE Is_Hotspot GROUP BY Address, Area_Name)""",
    "row_count": "SELECT COUNT(*) AS \"Rows\" FROM events",
    "top15_hotspot_addresses": f"""{INCIDENTS}
SELECT Address, Area_Name, COUNT(DR_Number) AS Collision_Count FROM inc
WHERE Is_Hotspot GROUP BY Address, Area_Name
ORDER BY Collision_Count DESC, Address, Area_Name LIMIT 15""",
    "severity_by_area": f"""{INCIDENTS}
SELECT Area_Name, Collision_Severity, COUNT(DR_Number) AS Count FROM inc
GROUP BY Area_Name, Collision_Severity ORDER BY Area_Name, Count DESC""",
    "severity_matrix": f"""{INCIDENTS}
SELECT Area_Name,
  {_sev_cols},
  COUNT(DR_Number) AS Total_Collisions
FROM inc WHERE Area_Name IS NOT NULL GROUP BY Area_Name ORDER BY Total_Collisions DESC, Area_Name""",
    "severity_matrix_top10": f"""{INCIDENTS}
SELECT * FROM (
  SELECT Area_Name,
    {_sev_cols},
    COUNT(DR_Number) AS Total_Collisions
  FROM inc WHERE Area_Name IS NOT NULL GROUP BY Area_Name ORDER BY Total_Collisions DESC, Area_Name LIMIT 10)
ORDER BY Total_Collisions, Area_Name DESC""",
    "peak_hour_per_area": f"""{INCIDENTS},
hc AS (SELECT Area_Name, Hour, COUNT(DR_Number) AS n FROM inc GROUP BY Area_Name, Hour),
mx AS (SELECT Area_Name, MAX(n) AS m FROM hc GROUP BY Area_Name)
SELECT hc.Area_Name, hc.Hour AS Peak_Hour, hc.n AS Peak_Collisions
FROM hc JOIN mx ON hc.Area_Name = mx.Area_Name AND hc.n = mx.m
ORDER BY Peak_Collisions DESC""",
    "peak_hour_single": f"""{INCIDENTS},
hc AS (SELECT Area_Name, Hour, COUNT(DR_Number) AS n FROM inc
       WHERE Area_Name IS NOT NULL AND Hour IS NOT NULL GROUP BY Area_Name, Hour),
mx AS (SELECT Area_Name, MAX(n) AS m FROM hc GROUP BY Area_Name)
SELECT hc.Area_Name, MIN(hc.Hour) AS Peak_Hour, MAX(hc.n) AS Peak_Collisions
FROM hc JOIN mx ON hc.Area_Name = mx.Area_Name AND hc.n = mx.m GROUP BY hc.Area_Name
ORDER BY Peak_Collisions DESC""",
    "area_peak_percent": f"""{INCIDENTS}, {_AREA_PEAKS_PATTERN},
tot AS (SELECT Area_Name, COUNT(*) AS Total_Collisions FROM inc WHERE Area_Name IS NOT NULL GROUP BY Area_Name)
SELECT tot.Area_Name, tot.Total_Collisions, pk.Hour AS Peak_Hour,
       pk.Collision_Count AS Peak_Hour_Collisions,
       {_PCT.format(p='pk.Collision_Count', w='tot.Total_Collisions')} AS Peak_Pct
FROM tot JOIN pk ON tot.Area_Name = pk.Area_Name ORDER BY Total_Collisions DESC""",
    "hotspot_with_peak": f"""{INCIDENTS}, {_AREA_PEAKS_PATTERN},
hot AS (
  SELECT Area_Name, Address, COUNT(*) AS Collision_Count FROM inc
  WHERE COALESCE(Is_Hotspot, false) AND Area_Name IS NOT NULL AND Address IS NOT NULL
  GROUP BY Area_Name, Address
)
SELECT hot.Area_Name, hot.Address, hot.Collision_Count, pk.Hour AS Area_Peak_Hour
FROM hot JOIN pk ON hot.Area_Name = pk.Area_Name ORDER BY Collision_Count DESC""",
    "area_stats_with_peak": f"""{INCIDENTS}, {_AREA_STATS}, {_CHART_CUBE},
pk AS (
  SELECT Area_Name, Hour AS Peak_Hour, Collision_Count AS Peak_Collisions FROM cube
  QUALIFY row_number() OVER (PARTITION BY Area_Name ORDER BY Collision_Count DESC, Hour) = 1
)
SELECT st.*, pk.Peak_Hour, pk.Peak_Collisions FROM st LEFT JOIN pk ON st.Area_Name = pk.Area_Name
ORDER BY Total_Collisions DESC""",
    "top5_area_peaks": f"""{INCIDENTS}, {_AREA_STATS}, {_CHART_CUBE},
pk AS (
  SELECT Area_Name, Hour AS Peak_Hour, Collision_Count AS Peak_Collisions FROM cube
  QUALIFY row_number() OVER (PARTITION BY Area_Name ORDER BY Collision_Count DESC, Hour) = 1
)
SELECT st.*, pk.Peak_Hour, pk.Peak_Collisions FROM st LEFT JOIN pk ON st.Area_Name = pk.Area_Name
ORDER BY Total_Collisions DESC, st.Area_Name LIMIT 5""",
    "yearly_trend": f"""{INCIDENTS_LONG}
SELECT Year, COUNT(DR_Number) AS Total_Collisions FROM inc WHERE Year IS NOT NULL
GROUP BY Year ORDER BY Year""",
    "yearly_direction": f"""{INCIDENTS_LONG},
yr AS (SELECT Year, COUNT(*) AS Collision_Count FROM inc WHERE Year IS NOT NULL GROUP BY Year),
lg AS (SELECT Year, Collision_Count, lag(Collision_Count) OVER (ORDER BY Year) AS Previous FROM yr)
SELECT Year, Collision_Count, Previous, Collision_Count - Previous AS Change,
       CASE WHEN Previous IS NULL THEN 'flat' WHEN Collision_Count > Previous THEN 'up'
            WHEN Collision_Count < Previous THEN 'down' ELSE 'flat' END AS Direction
FROM lg ORDER BY Year""",
    "monthly_trend": f"""{INCIDENTS_LONG}
SELECT Month, Season, COUNT(DR_Number) AS Total_Collisions FROM inc
GROUP BY Month, Season ORDER BY Month""",
    "monthly_profile": f"""{INCIDENTS_LONG}
SELECT Month, Season, COUNT(DR_Number) AS Total_Collisions,
       CASE WHEN Month BETWEEN 1 AND 12 THEN {_MONTHS}[Month] END AS MonthName
FROM inc WHERE Month IS NOT NULL AND Season IS NOT NULL
GROUP BY Month, Season ORDER BY Month""",
    "year_month_slice": f"""{INCIDENTS_LONG}
SELECT Year, Month, COUNT(DR_Number) AS Monthly_Collisions,
       CASE WHEN Month BETWEEN 1 AND 12 THEN {_MONTHS}[Month] END AS MonthName
FROM inc WHERE Year IN ({_years}) AND Month IS NOT NULL
GROUP BY Year, Month ORDER BY Year, Month""",
    "hourly_flow": f"""{INCIDENTS}
SELECT Area_Name, Hour, COUNT(DR_Number) AS Collision_Count FROM inc
GROUP BY Area_Name, Hour ORDER BY Area_Name, Hour""",
    "single_area_flow": f"""{INCIDENTS}
SELECT Hour, Time_of_Day, COUNT(DR_Number) AS Collision_Count FROM inc
WHERE Area_Name = '{SINGLE_AREA}' AND Hour IS NOT NULL AND Time_of_Day IS NOT NULL
GROUP BY Hour, Time_of_Day ORDER BY Hour""",
    "count_by_road_type": f"""{INCIDENTS}
SELECT Road_Type, COUNT(DR_Number) AS Total_Collisions FROM inc
GROUP BY Road_Type ORDER BY Total_Collisions DESC""",
    "rush_breakdown": f"""{INCIDENTS}
SELECT Time_of_Day, Hour, COUNT(DR_Number) AS Rush_Collisions,
       printf('%02d:00 (%s)', Hour, split_part(Time_of_Day, ' ', 1)) AS Label
FROM inc WHERE (Hour BETWEEN 7 AND 9 OR Hour BETWEEN 17 AND 19) AND Time_of_Day IS NOT NULL
GROUP BY Time_of_Day, Hour ORDER BY Time_of_Day, Hour""",
    "scenario_counts": f"""{INCIDENTS}
SELECT COUNT(*) FILTER (WHERE Hour BETWEEN 6 AND 9) AS Morning_Rush,
       COUNT(*) FILTER (WHERE Hour BETWEEN 17 AND 19) AS Evening_Rush,
       COUNT(*) FILTER (WHERE Road_Type = '{ROAD_VALUE}') AS Road_Only,
       COUNT(*) FILTER (WHERE COALESCE(Is_Hotspot, false)) AS Hotspot_Only,
       COUNT(*) FILTER (WHERE Collision_Severity = '{INJURY_VALUE}') AS Injury_Only
FROM inc""",
    "evening_rush_rows": f"""{INCIDENTS}
SELECT CAST(DR_Number AS VARCHAR) AS DR_Number, Area_Name, COALESCE(Hour, 0) AS Hour,
       Address, Collision_Severity AS Severity
FROM inc WHERE Hour BETWEEN 17 AND 19""",
    "hourly_rows": f"""{INCIDENTS}
SELECT Hour, COUNT(*) AS Collision_Count FROM inc WHERE Hour IS NOT NULL GROUP BY Hour ORDER BY Hour""",
    "area_rows": f"""{INCIDENTS}
SELECT Area_Name, COUNT(*) AS Collision_Count FROM inc WHERE Area_Name IS NOT NULL GROUP BY Area_Name""",
    "area_hour_rows": f"""{INCIDENTS}
SELECT Area_Name, Hour, COUNT(*) AS Collision_Count FROM inc
WHERE Area_Name IS NOT NULL AND Hour IS NOT NULL GROUP BY Area_Name, Hour""",
    "yearly_rows": f"""{INCIDENTS_LONG}
SELECT Year, COUNT(*) AS Collision_Count FROM inc WHERE Year IS NOT NULL GROUP BY Year ORDER BY Year""",
    "top10_hours": f"""{INCIDENTS},
hr AS (SELECT Hour, COUNT(*) AS Collision_Count FROM inc WHERE Hour IS NOT NULL GROUP BY Hour)
SELECT CAST(row_number() OVER (ORDER BY Collision_Count DESC, Hour) AS INTEGER) AS Rank, Hour, Collision_Count
FROM hr ORDER BY Collision_Count DESC, Hour LIMIT 10""",
    "top5_areas": f"""{INCIDENTS},
ar AS (SELECT Area_Name, COUNT(*) AS Collision_Count FROM inc WHERE Area_Name IS NOT NULL GROUP BY Area_Name)
SELECT CAST(row_number() OVER (ORDER BY Collision_Count DESC, Area_Name) AS INTEGER) AS Rank,
       Area_Name, Collision_Count
FROM ar ORDER BY Collision_Count DESC, Area_Name LIMIT 5""",
    "top10_areas_overlay": f"""{INCIDENTS}, {_AREA_STATS}
SELECT * FROM (SELECT * FROM st ORDER BY Total_Collisions DESC, Area_Name LIMIT 10)
ORDER BY Total_Collisions, Area_Name DESC""",
    "top20_area_hours": f"""{INCIDENTS}, {_CHART_CUBE}
SELECT Area_Name, Hour, Collision_Count, printf('%s  [%02d:00]', Area_Name, Hour) AS Label
FROM (SELECT * FROM cube ORDER BY Collision_Count DESC, Area_Name, Hour LIMIT 20)
ORDER BY Collision_Count, Area_Name DESC, Hour DESC""",
    "area_hour_heatmap": f"""{INCIDENTS}
SELECT Area_Name,
  {_HOUR_COLS},
  COUNT(DR_Number) AS Total_Collisions
FROM inc WHERE Area_Name IS NOT NULL GROUP BY Area_Name ORDER BY Total_Collisions DESC, Area_Name""",
    "hour_envelope": f"""{INCIDENTS}, {_CHART_CUBE},
areas AS (SELECT DISTINCT Area_Name FROM cube),
hours AS (SELECT DISTINCT Hour FROM cube),
grid AS (
  SELECT a.Area_Name, h.Hour, COALESCE(c.Collision_Count, 0) AS v
  FROM areas a CROSS JOIN hours h
  LEFT JOIN cube c ON c.Area_Name = a.Area_Name AND c.Hour = h.Hour
),
env AS (
  SELECT Hour, CAST(SUM(v) AS BIGINT) AS Total, AVG(CAST(v AS DOUBLE)) AS Mean, MAX(v) AS Max, MIN(v) AS Min
  FROM grid GROUP BY Hour
)
SELECT Hour, Total, Mean, Max, Min,
       CAST(Total AS DOUBLE) / CAST(MAX(Total) OVER () AS DOUBLE) * MAX(Mean) OVER () AS Total_Scaled
FROM env ORDER BY Hour""",
    "calendar_ordered_days": f"""{INCIDENTS}, {_DAY_PROFILE},
dd AS (SELECT * FROM (VALUES ('Monday', 0), ('Tuesday', 1), ('Wednesday', 2), ('Thursday', 3),
                             ('Friday', 4), ('Saturday', 5), ('Sunday', 6)) t(Day_of_Week, ord))
SELECT dd.Day_of_Week, dp.Total_Collisions, dp.Avg_Victim_Age
FROM dd LEFT JOIN dp ON dd.Day_of_Week = dp.Day_of_Week ORDER BY dd.ord""",
    "overall_peak_hour": f"""{INCIDENTS}
SELECT Hour, Time_of_Day, COUNT(DR_Number) AS Total_Collisions FROM inc
WHERE Hour IS NOT NULL AND Time_of_Day IS NOT NULL
GROUP BY Hour, Time_of_Day ORDER BY Total_Collisions DESC, Hour LIMIT 1""",
    "hour_labels": f"""{INCIDENTS},
hp AS (SELECT Hour, Time_of_Day, COUNT(DR_Number) AS n FROM inc
       WHERE Hour IS NOT NULL AND Time_of_Day IS NOT NULL GROUP BY Hour, Time_of_Day)
SELECT printf('%02d:00', Hour) AS Clock, format('{{:,}}', n) AS Count_Text,
       printf('%.1f%%', {_PCT.format(p='n', w='SUM(n) OVER ()')}) AS Share_Text,
       repeat('#', CAST(n // {BAR_UNIT} AS BIGINT)) AS Bar, lower(Time_of_Day) AS Band,
       Time_of_Day IN ('Morning Rush', 'Evening Rush') AS Is_Rush
FROM hp ORDER BY Clock""",
    "hour_profile": f"""{INCIDENTS}
SELECT Hour, Time_of_Day, COUNT(DR_Number) AS Total_Collisions FROM inc
WHERE Hour IS NOT NULL AND Time_of_Day IS NOT NULL
GROUP BY Hour, Time_of_Day ORDER BY Hour""",
}
