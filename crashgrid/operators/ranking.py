"""Arg-max per group with explicit tie rules, top-N with a full tiebreak, rank numbers."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

TIES = ("all", "first")


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def peak(
    df: DataFrame,
    group: str | Sequence[str],
    value: str,
    by: str,
    ties: str = "all",
) -> DataFrame:
    """Rows of ``df`` holding the highest ``value`` within each ``group``.

    ``ties="all"`` keeps every tied row (rank = 1); ``ties="first"`` keeps one row,
    the lowest ``by`` among the tied ones (never arrival order). The ``= 1``
    filter lets Spark insert a partial ``WindowGroupLimit`` before the shuffle,
    so each task forwards only its local leaders per group.
    """
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}")
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups)
    if ties == "all":
        rnk = F.rank().over(w.orderBy(F.col(value).desc()))
    else:
        rnk = F.row_number().over(w.orderBy(F.col(value).desc(), F.col(by).asc_nulls_last()))
    return df.withColumn("_peak_rank", rnk).where(F.col("_peak_rank") == 1).drop("_peak_rank")


def packed(value: str | Column, by: str | Column) -> Column:
    """``value`` (a count) and ``by`` (a whole number of 32 bits) as one number that
    is larger for a higher value, then for a lower ``by``; null if either is. Its
    maximum is an arg-max that adds up like any maximum: a hash aggregate on every
    partial result, with no sort and no window. See :func:`peak_value`."""
    value, by = (F.col(c) if isinstance(c, str) else c for c in (value, by))
    return value.cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + (F.lit((1 << 31) - 1) - by.cast("long")).cast("decimal(10,0)")


def peak_value(best: str | Column) -> Column:
    """The value in a maximum of :func:`packed`."""
    best, one = F.col(best) if isinstance(best, str) else best, F.lit(1 << 32).cast("decimal(10,0)")
    return ((best - F.pmod(best, one)) / one).cast("long")


def peak_by(best: str | Column) -> Column:
    """The ``by`` in a maximum of :func:`packed`: the lowest with the highest value."""
    best = F.col(best) if isinstance(best, str) else best
    return (F.lit((1 << 31) - 1) - F.pmod(best, F.lit(1 << 32).cast("decimal(10,0)")).cast("long")).cast("int")


def peak_single(df: DataFrame, group: str | Sequence[str], value: str, by: str) -> DataFrame:
    """``group, by, value`` of the highest ``value`` in each group, the lowest
    ``by`` on ties, by the mergeable maximum of :func:`packed`. Rows with a null
    value or ``by`` are no peak; a group with no other rows has none."""
    groups = [group] if isinstance(group, str) else list(group)
    best = df.groupBy(*groups).agg(F.max(packed(value, by)).alias("_best")).where(F.col("_best").isNotNull())
    return best.select(*groups, peak_by("_best").alias(by), peak_value("_best").alias(value))


def top_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows under a total order (caller passes the tiebreak keys).
    Planned as ``TakeOrderedAndProject``: each task keeps its own top n."""
    return df.orderBy(*_order(order)).limit(n)


def with_rank_number(df: DataFrame, order: Sequence[str | Column], alias: str = "Rank") -> DataFrame:
    """1..N position under ``order``. A window without partitioning runs in one
    task, so use it only on bounded results (after :func:`top_n` or on a roll-up
    of a fixed dimension)."""
    return df.withColumn(alias, F.row_number().over(Window.orderBy(*_order(order))))


def with_global_rank(
    df: DataFrame, order: Sequence[str | Column], alias: str = "Rank", within: Sequence[str] = (), total: str | None = None
) -> DataFrame:
    """1..N position under ``order``, for results of any size: the numbers that
    ``row_number`` would give, without one task that sees every row.

    Rows are dealt to partitions by range, sorted there and written to the
    checkpoint folder with their place, so ranges sampled once stay as they are.
    A row's number is its place in its partition plus the rows of the partitions
    before, of which there is one count each. With ``within``, positions start
    again in each group (null is a group); a group may span any number of
    partitions. ``total`` adds the group's size, or that of all rows. Equal rows
    are numbered in any order.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = [F.col(g).asc_nulls_first() for g in within] + _order(order)
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = (
        tied.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    )
    part, index = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_index": index}).drop("_place")
    runs = placed.groupBy("_part", *within).agg(F.count(F.lit(1)).alias("_n"), F.min("_index").alias("_first"))
    if within:
        group = Window.partitionBy(*within)
        before = F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
        runs = runs.select("_part", *within, "_first", before.alias("_before"), F.sum("_n").over(group).alias("_total"))
    else:  # one row per partition
        counted = sorted((r["_part"], r["_n"]) for r in runs.collect())
        ends = list(accumulate(n for _, n in counted))
        rows = [(p, 0, end - n, ends[-1]) for (p, n), end in zip(counted, ends)]
        runs = F.broadcast(spark.createDataFrame(rows, "_part int, _first long, _before long, _total long"))
    runs = runs.select("_first", "_before", "_total", F.col("_part").alias("_run"), *[F.col(g).alias(f"_run_{g}") for g in within])
    same = F.col("_part").cast("int") == F.col("_run").cast("int")
    for g in within:
        same &= F.col(g).eqNullSafe(F.col(f"_run_{g}"))
    number = (F.col("_before") + F.col("_index") - F.col("_first") + 1).alias(alias)
    sized = [F.col("_total").alias(total)] if total else []
    return placed.join(runs, same).select(*df.columns, number, *sized)


def overall_peak(df: DataFrame, value: str, by: str) -> DataFrame:
    """Single row with the highest ``value``, lowest ``by`` on ties."""
    return top_n(df, 1, [F.col(value).desc(), F.col(by).asc_nulls_last()])
