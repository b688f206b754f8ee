"""Column expressions that derive the calendar and time-band dimensions.

All of these are built-in Catalyst expressions (no Python on rows), so they
stay inside whole-stage codegen and can be pushed below joins and aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the published results; do not reorder):
#   hour bands, inclusive:  0-5 Late Night, 6-9 Morning Rush, 10-12 Mid Morning,
#                           13-16 Afternoon, 17-19 Evening Rush, 20-23 Night
#   seasons by month:       12,1,2 Winter; 3,4,5 Spring; 6,7,8 Summer; 9,10,11 Fall
#   weekend days:           Saturday, Sunday
#   day names:              Monday Tuesday Wednesday Thursday Friday Saturday Sunday
#   month labels:           Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec
# ---------------------------------------------------------------------------
HOUR_BANDS = [
    (0, 5, "Late Night"),
    (6, 9, "Morning Rush"),
    (10, 12, "Mid Morning"),
    (13, 16, "Afternoon"),
    (17, 19, "Evening Rush"),
    (20, 23, "Night"),
]
SEASON_MONTHS = [
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
    ("Fall", (9, 10, 11)),
]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_band(hour: str | Column) -> Column:
    """Time-of-day label for an hour 0-23; null or out-of-range hour gives null."""
    h = _col(hour)
    expr = None
    for lo, hi, label in HOUR_BANDS:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def season(month: str | Column) -> Column:
    """Season label for a month number; null or unknown month gives null."""
    m = _col(month)
    expr = None
    for label, months in SEASON_MONTHS:
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def day_name(date: str | Column) -> Column:
    """English full day name (Monday ... Sunday)."""
    return F.date_format(_col(date), "EEEE")


def is_weekend(date: str | Column) -> Column:
    """True on Saturday and Sunday. ``weekday`` is 0 = Monday ... 6 = Sunday."""
    return F.weekday(_col(date)) >= 5


def text_flag(c: str | Column) -> Column:
    """Normalise a Boolean written as text: True/true/TRUE -> true, false -> false,
    anything else (empty, junk, null) -> null. Booleans pass through unchanged."""
    s = F.lower(F.trim(_col(c).cast("string")))
    return F.when(s == "true", F.lit(True)).when(s == "false", F.lit(False))


def enrich(
    df: DataFrame,
    date_col: str = "Date_Occurred",
    hour_col: str = "Hour",
    overwrite: bool = False,
) -> DataFrame:
    """Add Day_of_Week, Is_Weekend, Year, Month, Season, Time_of_Day from a date and
    an hour column. Existing columns are kept unless ``overwrite``."""
    d = F.col(date_col)
    derived = {
        "Year": F.year(d),
        "Month": F.month(d),
        "Day_of_Week": day_name(d),
        "Is_Weekend": is_weekend(d),
        "Season": season(F.month(d)),
        "Time_of_Day": hour_band(F.col(hour_col)),
    }
    if not overwrite:
        derived = {k: v for k, v in derived.items() if k not in df.columns}
    return df.withColumns(derived) if derived else df


def enrich_from_timestamp(df: DataFrame, ts_col: str, overwrite: bool = False) -> DataFrame:
    """Split a timestamp into Date_Occurred and Hour, then :func:`enrich`."""
    ts = F.col(ts_col)
    base = {"Date_Occurred": F.to_date(ts), "Hour": F.hour(ts)}
    if not overwrite:
        base = {k: v for k, v in base.items() if k not in df.columns}
    return enrich(df.withColumns(base) if base else df, overwrite=overwrite)
