"""Pivots and the hour envelope across areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


#: Columns that a pivot over found values may make.
MOST_VALUES = 200


def found_values(cube: DataFrame, pivot_col: str, most: int = MOST_VALUES) -> tuple[DataFrame, list]:
    """(the cube, the distinct non-null values of ``pivot_col`` in order). The
    cube is checkpointed, so it is computed once for its values and its pivot;
    what comes to the driver is at most ``most`` values and one, and more than
    ``most`` is an error: such a column is no label."""
    checkpoint_dir(cube.sparkSession)
    cube = cube.checkpoint()
    values = [r[0] for r in cube.select(pivot_col).where(F.col(pivot_col).isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{pivot_col} has more than {most} values")
    return cube, sorted(values)


def pivot_sum(
    cube: DataFrame,
    row_key: str,
    pivot_col: str,
    values: Sequence,
    value: str,
    names: Sequence[str] | None = None,
    total: str | None = None,
) -> DataFrame:
    """Pivot an already aggregated cube: one column per given value holding the
    sum of ``value`` for it (0 when absent), plus an optional row total over all
    cells. The cube has one row per (row_key, pivot value), so this second
    aggregation is small whatever the size of the base table."""
    labels = list(names) if names else [str(v) for v in values]
    taken = [row_key, total or row_key]
    labels = [f"{x} ({pivot_col})" if x in taken else x for x in labels]
    aggs = [
        F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(value)).otherwise(F.lit(0))).alias(label)
        for v, label in zip(values, labels)
    ]
    if total:
        aggs.append(F.sum(value).alias(total))
    return cube.groupBy(row_key).agg(*aggs)


def envelope(cube: DataFrame, row_key: str, hour_col: str, value: str) -> DataFrame:
    """Per hour present in ``cube``: total, mean, max and min of ``value`` across
    all row keys of the cube, a key absent at that hour counting as 0.

    A key is counted at the first hour it has, so the number of keys is a sum
    over at most 24 rows; zero cells are accounted for, not built. No key list
    is gathered anywhere.
    """
    first = F.row_number().over(Window.partitionBy(row_key).orderBy(hour_col)) == 1
    per_hour = cube.withColumn("_first", first).groupBy(hour_col).agg(
        F.sum(value).alias("Total"),
        F.max(value).alias("_max"),
        F.min(value).alias("_min"),
        F.count(value).alias("_present"),
        F.count_if("_first").alias("_new"),
    )
    n_keys = F.sum("_new").over(Window.partitionBy())  # over one row per hour
    missing = F.col("_present") < F.col("_n_keys")
    return per_hour.withColumn("_n_keys", n_keys).select(
        hour_col,
        "Total",
        F.try_divide(F.col("Total").cast("double"), F.col("_n_keys").cast("double")).alias("Mean"),
        F.when(missing, F.greatest(F.col("_max"), F.lit(0).cast("bigint"))).otherwise(F.col("_max")).alias("Max"),
        F.when(missing, F.least(F.col("_min"), F.lit(0).cast("bigint"))).otherwise(F.col("_min")).alias("Min"),
    )
