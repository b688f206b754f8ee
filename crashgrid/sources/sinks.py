"""Sinks: single-file CSV for small sorted reports, Parquet for anything large."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame

def write_csv(df: DataFrame, path: str, single_file: bool, is_sorted: bool = True) -> str:
    """Headered CSV, overwrite. The caller says whether the result is one file,
    which is for results bounded by construction (roll-ups over fixed
    dimensions), at whatever size. A sorted one is merged after its sort, which
    keeps the order; an unsorted one by a shuffle, so that the stage that makes
    it still runs on all tasks."""
    if single_file:
        df = df.coalesce(1) if is_sorted else df.repartition(1)
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_catalogue(
    frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
    root: str,
    fmt: str = "csv",
    single_file: Collection[str] = (),
    unsorted: Collection[str] = (),
) -> dict[str, str]:
    """Write each named result once under ``root/<name>``; returns name -> path.
    CSV results named in ``single_file`` are one file each, all others many."""
    written = {}
    for name, frame in frames.items():
        df = frame() if callable(frame) else frame
        path = f"{root.rstrip('/')}/{name}"
        written[name] = write_csv(df, path, name in single_file, name not in unsorted) if fmt == "csv" else write_parquet(df, path)
    return written
