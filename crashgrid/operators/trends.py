"""Period-on-period direction, shares, percent of group, rescaling.

``direction`` uses a window without partitions and is meant for roll-ups whose
size is bounded by a dimension (years, seasons, hours). Shares and rescaling read
a total or maximum as a one-row subquery, so their rows stay where they are and
may be any number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Direction labels.
UP, DOWN, FLAT = "up", "down", "flat"


def pct(part: str | Column, whole: str | Column, digits: int = 1) -> Column:
    """``part / whole * 100`` rounded half-even; null (not an error) when whole is 0."""
    p = F.col(part) if isinstance(part, str) else part
    w = F.col(whole) if isinstance(whole, str) else whole
    return F.bround(F.try_divide(p.cast("double"), w.cast("double")) * F.lit(100.0), digits)


def ratio(num: str | Column, den: str | Column, digits: int = 1) -> Column:
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.bround(F.try_divide(n.cast("double"), d.cast("double")), digits)


def direction(df: DataFrame, order: str, value: str, prefix: str = "") -> DataFrame:
    """Add previous value, change and direction (first row and equal -> flat)."""
    w = Window.orderBy(F.col(order).asc_nulls_last())
    prev = F.lag(F.col(value)).over(w)
    return (
        df.withColumn(f"{prefix}Previous", prev)
        .withColumn(f"{prefix}Change", F.col(value) - F.col(f"{prefix}Previous"))
        .withColumn(
            f"{prefix}Direction",
            F.when(F.col(f"{prefix}Previous").isNull(), F.lit(FLAT))
            .when(F.col(value) > F.col(f"{prefix}Previous"), F.lit(UP))
            .when(F.col(value) < F.col(f"{prefix}Previous"), F.lit(DOWN))
            .otherwise(F.lit(FLAT)),
        )
    )


def share(df: DataFrame, value: str, alias: str = "Share_Pct", digits: int = 1) -> DataFrame:
    """Each row's percent of the column total."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(alias, pct(F.col(value), total, digits))


def rescale_to_max(df: DataFrame, value: str, target: str, alias: str) -> DataFrame:
    """``value / max(value) * max(target)`` over all rows."""
    most = df.select(F.struct(F.max(value).cast("double").alias("v"), F.max(target).alias("t"))).scalar()
    return df.withColumn(alias, F.try_divide(F.col(value).cast("double"), most.getField("v")) * most.getField("t"))
