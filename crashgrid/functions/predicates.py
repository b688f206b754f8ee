"""Named row predicates.

Each returns a Column; a null input makes the predicate null, so ``filter``
drops the row (the same as the explicit not-null guards of the RDD form).
The two "morning rush" definitions are different questions and are kept apart.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive hour ranges used by the rush filters.
MORNING_RUSH = (6, 9)
EVENING_RUSH = (17, 19)
COMMUTE_MORNING = (7, 9)
COMMUTE_EVENING = (17, 19)


def hour_between(lo: int, hi: int, hour: str = "Hour") -> Column:
    return F.col(hour).between(lo, hi)


def morning_rush(hour: str = "Hour") -> Column:
    """6 <= hour <= 9 (the band label's range)."""
    return hour_between(*MORNING_RUSH, hour=hour)


def evening_rush(hour: str = "Hour") -> Column:
    """17 <= hour <= 19."""
    return hour_between(*EVENING_RUSH, hour=hour)


def commute_rush(hour: str = "Hour") -> Column:
    """7-9 or 17-19: the chart's rush definition."""
    return hour_between(*COMMUTE_MORNING, hour=hour) | hour_between(*COMMUTE_EVENING, hour=hour)


def equals(column: str, value) -> Column:
    return F.col(column) == F.lit(value)


def one_of(column: str, values: Iterable) -> Column:
    return F.col(column).isin(list(values))


def is_true(column: str) -> Column:
    """Typed Boolean flag; null counts as not true."""
    return F.coalesce(F.col(column), F.lit(False))


def not_null(*columns: str) -> Column:
    cond = None
    for c in columns:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return cond if cond is not None else F.lit(True)
