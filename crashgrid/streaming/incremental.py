"""The count reports maintained incrementally over arriving files.

The original reports have no streaming; this module adds no operator. It runs the
same ``count_by`` roll-up on a Structured Streaming source, so a folder that
keeps receiving collision files has its counts kept current instead of
recounted. State is one row per group, so use it for keys with bounded
domains (area, hour, band, day, season...); for unbounded keys (addresses)
run the batch report instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.enrich import enrich
from ..operators.rollups import count_by
from ..sources.readers import normalise


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Typed collision rows from files landing in ``path`` (explicit schema:
    streaming sources never infer). Missing calendar labels are derived."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return enrich(normalise(reader.load(path)))


def running_counts(
    stream: DataFrame,
    keys: str | Sequence[str],
    alias: str = "Total_Collisions",
    id_col: str | None = "DR_Number",
    null_keys: str = "keep",
) -> DataFrame:
    """Same roll-up as the batch report, on a stream."""
    return count_by(stream, keys, alias, id_col=id_col, null_keys=null_keys)


def start(
    counts: DataFrame,
    checkpoint_location: str,
    sink: str = "parquet",
    path: str | None = None,
    query_name: str | None = None,
    output_mode: str = "complete",
) -> StreamingQuery:
    """Start the query. ``checkpoint_location`` must be on shared storage so the
    query resumes after a driver or executor loss with its state intact."""
    writer = counts.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    if sink == "parquet":
        # the full result of a micro-batch goes to a folder of its own, so readers
        # never meet a half-written one; a repeated batch rewrites only its own
        def _write(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

        return writer.foreachBatch(_write).start()
    writer = writer.format(sink)
    return writer.start(path) if path else writer.start()


def current(spark: SparkSession, path: str) -> DataFrame:
    """The counts of the last micro-batch that :func:`start` has finished writing."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/epoch=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    folders = [f.getPath().getParent() for f in found or []]
    if not folders:
        raise FileNotFoundError(f"no finished batch under {path}")
    return spark.read.parquet(max(folders, key=lambda p: int(p.getName().split("=")[1])).toString())
