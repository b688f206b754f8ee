"""Tables in the shared folder, and batches of bounded size inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Spark's own setting (4.1): an execution's shuffle files are removed as it ends,
# not when the driver comes to collect its garbage. Unknown elsewhere, and ignored.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate tables of one operator call, written as Parquet under the
    folder the cluster names in ``spark.checkpoint.dir``.

    A written table cuts the lineage, survives lost executors and is read by
    every executor. ``drop`` removes one that no later step reads. With
    ``free_shuffles`` the shuffle files that a table was made through go once it
    is written, since nothing reads them again.
    """

    def __init__(self, spark: SparkSession, name: str, free_shuffles: bool = False):
        self.spark = spark
        self.free_shuffles = free_shuffles
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        given = self.spark.conf.get(SHUFFLE_CLEANUP, None)
        if self.free_shuffles:
            self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            writer.parquet(self.path(name))
        finally:
            if self.free_shuffles:
                self.spark.conf.unset(SHUFFLE_CLEANUP) if given is None else self.spark.conf.set(SHUFFLE_CLEANUP, given)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop_all(self) -> None:
        """Remove all tables of the call, once what was made from them is written."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def byte_chunks(batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``limit`` bytes at
    most; a longer text is a slice of its own. Bounds a task's memory by the
    longest text, not by the rows of a batch."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(array: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null as empty."""
    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]


def row_key(id_col: str, text_col: str) -> Column:
    """A digest of id and text: rows that share it are copies in both. Never null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), text).cast("binary"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
