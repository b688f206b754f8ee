"""Small ordered dimension frames (days, seasons, months).

Their size is fixed by the calendar (7, 4, 12 rows), so they are safe to
broadcast at any data volume. They are built from ``spark.range`` plus an
array literal, so nothing is shipped from the driver beyond the literal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .enrich import DAY_NAMES, MONTH_LABELS

# Fixed value: season order used by the share chart.
SEASON_ORDER = ["Spring", "Summer", "Fall", "Winter"]


def _labelled(spark: SparkSession, labels: list[str], name: str, pos: str) -> DataFrame:
    arr = F.array(*[F.lit(x) for x in labels])
    return (
        spark.range(len(labels))
        .select(
            F.element_at(arr, (F.col("id") + 1).cast("int")).alias(name),
            F.col("id").alias(pos),
        )
    )


def day_dim(spark: SparkSession) -> DataFrame:
    """Day_of_Week, Day_Order (0 = Monday)."""
    return _labelled(spark, DAY_NAMES, "Day_of_Week", "Day_Order")


def season_dim(spark: SparkSession) -> DataFrame:
    """Season, Season_Order (Spring first)."""
    return _labelled(spark, SEASON_ORDER, "Season", "Season_Order")


def month_dim(spark: SparkSession) -> DataFrame:
    """Month (1..12, int), MonthName."""
    arr = F.array(*[F.lit(x) for x in MONTH_LABELS])
    return spark.range(1, 13).select(
        F.col("id").cast("int").alias("Month"),
        F.element_at(arr, F.col("id").cast("int")).alias("MonthName"),
    )
