"""Grouped counts and one-pass scenario counts.

Every roll-up is a ``groupBy`` with partial (map-side) aggregation, so a key
that holds a third of all rows is reduced to one row per input partition
before the shuffle; no group is ever collected into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import not_null
from ..session import checkpoint_dir

NULL_KEYS = ("keep", "drop")

# A "weighted" frame is a pre-aggregated cube: each row stands for many rows of
# the base table and carries these additive measures. Every helper below gives
# the same answer on the base table and on a cube of it.
W_ID = "_w_id"        # count of non-null ids
W_ROWS = "_w_rows"    # count of rows
W_SUM = "_w_sum"      # exact (decimal) sum of the measure
W_CNT = "_w_cnt"      # count of non-null measure values
WEIGHTS = (W_ID, W_ROWS, W_SUM, W_CNT)
# Distinct days of a cell, as exact bitmaps that add up by OR: a row of a cube
# with days stands for the days of one block of 32,768 (some 90 years), so its
# grain has the block as one more column.
W_DAYS = "_w_days"
W_BLOCK = "_w_day_block"


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_measure(id_col: str | None = "DR_Number") -> Column:
    """``count(id)`` counts non-null ids (the report rule); ``None`` counts rows."""
    return F.count(F.col(id_col)) if id_col else F.count(F.lit(1))


def is_weighted(df: DataFrame) -> bool:
    return W_ROWS in df.columns


def count_col(df: DataFrame, id_col: str | None = "DR_Number") -> Column:
    """``count(id)`` / row count on a base frame; the matching weight sum on a cube."""
    if is_weighted(df):
        return F.sum(W_ID if id_col else W_ROWS)
    return count_measure(id_col)


def count_if_col(df: DataFrame, cond: Column) -> Column:
    """Rows where ``cond`` holds (null counts as false)."""
    weight = F.col(W_ROWS) if is_weighted(df) else F.lit(1).cast("bigint")
    # A plain conditional sum (0 on empty input, like count_if): it canonicalises
    # identically wherever it appears, so repeated sub-plans are reused.
    return F.coalesce(
        F.sum(F.when(F.coalesce(cond, F.lit(False)), weight).otherwise(F.lit(0).cast("bigint"))),
        F.lit(0).cast("bigint"),
    )


def measured(col: str, scale: int | None = None) -> Column:
    """The values a mean is made of: nulls, NaN and infinities are missing. With
    ``scale`` they are decimals of that many digits, whose sum does not depend
    on the order rows are added in; without, they are as they come."""
    value = F.col(col)
    finite = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    return finite if scale is None else finite.try_cast(decimal_type(scale))


def sum_parts(df: DataFrame, measure: str, scale: int | None) -> tuple[Column, Column]:
    """(sum, count) of a measure, additive so they can be summed again."""
    if is_weighted(df):
        return F.sum(W_SUM), F.sum(W_CNT)
    return F.sum(measured(measure, scale)), F.count(measured(measure, scale))


def mean_col(df: DataFrame, measure: str, scale: int | None = None) -> Column:
    if is_weighted(df):
        total, cnt = sum_parts(df, measure, scale)
        return F.try_divide(total.cast("double"), cnt.cast("double"))
    return exact_mean(measure, scale)


def weighted_cube(
    df: DataFrame,
    grain: Sequence[str],
    id_col: str = "DR_Number",
    measure: str | None = "Victim_Age",
    scale: int | None = None,
) -> DataFrame:
    """Aggregate the base table once to ``grain`` with additive weights.

    The cube's size is bounded by the product of the grain's domains, not by
    the number of rows; every count, conditional count and exact mean over any
    subset of the grain can then be computed from it.
    """
    if is_weighted(df):  # re-aggregating a cube to a coarser grain
        sums = [F.sum(w).alias(w) for w in WEIGHTS if w in df.columns]
        if W_DAYS not in df.columns:
            return df.groupBy(*grain).agg(*sums)
        return df.groupBy(*grain, W_BLOCK).agg(*sums, F.bitmap_or_agg(W_DAYS).alias(W_DAYS))
    aggs = [count_measure(id_col).alias(W_ID), F.count(F.lit(1)).alias(W_ROWS)]
    if measure is not None:
        total, cnt = sum_parts(df, measure, scale)
        aggs += [total.alias(W_SUM), cnt.alias(W_CNT)]
    return df.groupBy(*grain).agg(*aggs)


def fold_days(cube: DataFrame, date_col: str = "Date_Occurred") -> DataFrame:
    """A cube whose grain has ``date_col`` without it: the days become bitmaps, so
    that distinct days add up like the other weights. A null date is no day. The
    cube is small already (dates x labels), which the sorted aggregation that
    bitmaps take needs."""
    grain = [c for c in cube.columns if c != date_col and c not in WEIGHTS]
    day = F.unix_date(date_col)
    return cube.groupBy(*grain, F.bitmap_bucket_number(day).alias(W_BLOCK)).agg(
        *[F.sum(w).alias(w) for w in WEIGHTS if w in cube.columns],
        F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias(W_DAYS),
    )


def count_and_days(
    df: DataFrame,
    keys: str | Sequence[str],
    alias: str = "Total_Collisions",
    days_alias: str = "Distinct_Days",
    date_col: str = "Date_Occurred",
    id_col: str | None = "DR_Number",
) -> DataFrame:
    """``keys -> count, exact distinct days``, from base rows, a cube with dates
    or a cube with days folded in: the same at every grain."""
    ks = _keys(keys)
    if W_DAYS not in df.columns:
        df = fold_days(weighted_cube(df, [*ks, date_col], id_col=id_col or date_col, measure=None), date_col)
    weight = F.sum(W_ID if id_col else W_ROWS)
    per_block = df.groupBy(*ks, W_BLOCK).agg(weight.alias("_n"), F.bitmap_or_agg(W_DAYS).alias(W_DAYS))
    return per_block.groupBy(*ks).agg(
        F.sum("_n").alias(alias), F.sum(F.bitmap_count(W_DAYS)).alias(days_alias)
    )


def cubes(df: DataFrame, grains: Sequence[Sequence[str]], id_col: str = "DR_Number", measure: str | None = "Victim_Age",
          scale: int | None = None) -> dict[tuple[str, ...], DataFrame]:
    """The cube of every grain from one pass over ``df``, a base or weighted frame.

    One ``groupingSets`` aggregation: each row meets all grains inside its task,
    is counted there, and only the tasks' partial cells are shuffled. The result,
    one table of all cells, is checkpointed, so that ``df`` is read once however
    many results read its cubes. A grain is any distinct set of columns.
    """
    chosen = list(dict.fromkeys(tuple(g) for g in grains))
    if len({frozenset(g) for g in chosen}) < len(chosen):
        raise ValueError("grains must differ in more than the order of their columns")
    columns = list(dict.fromkeys(c for g in chosen for c in g))
    if is_weighted(df):
        aggs = [F.sum(w).alias(w) for w in WEIGHTS if w in df.columns]
    else:
        total, cnt = sum_parts(df, measure, scale) if measure else (None, None)
        aggs = [count_measure(id_col).alias(W_ID), F.count(F.lit(1)).alias(W_ROWS)]
        aggs += [total.alias(W_SUM), cnt.alias(W_CNT)] if measure else []
    checkpoint_dir(df.sparkSession)
    cells = df.groupingSets([[F.col(c) for c in g] for g in chosen], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_w_grain"), *aggs
    ).checkpoint()
    out = {}
    for g in chosen:
        absent = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in g)
        out[g] = cells.where(F.col("_w_grain") == absent).select(*g, *[w for w in WEIGHTS if w in cells.columns])
    return out


def count_by(
    df: DataFrame,
    keys: str | Sequence[str],
    alias: str = "Total_Collisions",
    id_col: str | None = "DR_Number",
    null_keys: str = "keep",
    where: Column | None = None,
) -> DataFrame:
    """``keys -> count`` with an explicit null-key rule.

    ``null_keys="keep"`` keeps a null group (DataFrame ``groupBy`` rule);
    ``"drop"`` removes rows with a null in any key first (pair-RDD / pandas rule).
    """
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys must be one of {NULL_KEYS}")
    ks = _keys(keys)
    if where is not None:
        df = df.where(where)
    if null_keys == "drop":
        df = df.where(not_null(*ks))
    return df.groupBy(*ks).agg(count_col(df, id_col).alias(alias))


def decimal_type(scale: int) -> T.DecimalType:
    """Decimal for exact sums of a measure kept to ``scale`` digits."""
    if not 0 <= scale <= 12:
        raise ValueError("scale must be between 0 and 12")
    return T.DecimalType(38, scale)


def exact_mean(col: str, scale: int | None = None) -> Column:
    """Mean of the values ``measured`` keeps: their sum, divided once by their number."""
    value = measured(col, scale)
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def count_and_mean(
    df: DataFrame,
    keys: str | Sequence[str],
    measure: str,
    mean_alias: str,
    count_alias: str = "Total_Collisions",
    id_col: str | None = "DR_Number",
    scale: int | None = None,
) -> DataFrame:
    return df.groupBy(*_keys(keys)).agg(
        count_col(df, id_col).alias(count_alias),
        mean_col(df, measure, scale).alias(mean_alias),
    )


def scenario_counts(df: DataFrame, scenarios: Mapping[str, Column]) -> DataFrame:
    """One row, one column per named predicate: all counts in a single pass."""
    return df.agg(*[count_if_col(df, cond).alias(name) for name, cond in scenarios.items()])


def row_count(df: DataFrame) -> DataFrame:
    """One row: number of rows."""
    return df.agg(F.count(F.lit(1)).alias("Rows"))


def row_and_partition_counts(df: DataFrame) -> DataFrame:
    """One row: number of rows and of input partitions, empty ones included."""
    parts = df.rdd.getNumPartitions()  # known from the plan, no job
    return row_count(df).withColumn("Partitions", F.lit(parts).cast("long"))
