"""Cubes of a growing folder of collision files, kept up to date.

Cubes are additive: counts, exact sums and day bitmaps of new files are added to
those stored, and no counted file is read again. A store is a folder:

    <root>/attempts/<id>/cube-0, cube-1, ...   one weighted cube per grain
    <root>/attempts/<id>/files                 the files they count
    <root>/commits/<n>                         the id of the n-th state

An update writes a whole new state under an id of its own and then creates the
next commit, one small file that only one writer can create. A state is read
only through its commit, so an update that dies leaves what was there, and the
next one counts its files once. Nothing is kept on the driver between calls.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollups
from ..sources import readers
from . import batch, runner

FILE_SCHEMA = "path string, length bigint, modified timestamp"
DATE = "Date_Occurred"


class ChangedFiles(ValueError):
    """Files that are counted have changed or are gone: the cubes cannot follow."""


class MaintainedCubes:
    """``grains``: the columns of each cube; ``Date_Occurred`` among them makes
    distinct days. ``read`` turns paths into a collision table, by default
    the CSV or Parquet reader. Sums are exact with a ``scale``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        grains: Iterable[Sequence[str]],
        scale: int | None = None,
        read: Callable[[SparkSession, Sequence[str]], DataFrame] | None = None,
    ):
        self.spark, self.root, self.scale = spark, root.rstrip("/"), scale
        self.grains = [tuple(g) for g in grains]
        self.read = read or read_files

    # -- the store
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _commits(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/commits")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(p)) if fs.exists(p) else []

    def _commit(self, n: int, attempt: str) -> None:
        """Fails if another writer has made commit ``n``."""
        fs, p = self._fs(f"{self.root}/commits/{n}")
        out = fs.create(p, False)
        try:
            out.writeBytes(attempt)
        finally:
            out.close()

    def _attempt(self, n: int) -> str:
        line = self.spark.read.text(f"{self.root}/commits/{n}").first()
        if line is None:
            raise ValueError(f"commit {n} of {self.root} is empty: delete it and update again")
        return f"{self.root}/attempts/{line[0]}"

    def version(self) -> int:
        """The number of the last state; 0 before the first update."""
        return max(self._commits(), default=0)

    def files(self) -> DataFrame:
        """The files counted so far: path, length, time of modification."""
        n = self.version()
        if not n:
            return self.spark.createDataFrame([], FILE_SCHEMA)
        return self.spark.read.schema(FILE_SCHEMA).parquet(f"{self._attempt(n)}/files")

    def cubes(self) -> dict[tuple[str, ...], DataFrame]:
        """grain (without dates) -> its cube."""
        n = self.version()
        if not n:
            raise ValueError(f"no state under {self.root}: update first")
        at = self._attempt(n)
        return {self._kept(g): self.spark.read.parquet(f"{at}/cube-{i}") for i, g in enumerate(self.grains)}

    @staticmethod
    def _kept(grain: tuple[str, ...]) -> tuple[str, ...]:
        return tuple(c for c in grain if c != DATE)

    # -- updates
    def update(self, path: str | Sequence[str]) -> int:
        """Count the files under ``path`` that are not counted yet; returns how
        many. Raises :class:`ChangedFiles` if one counted before is not as it was."""
        listed = (
            self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", "length", F.col("modificationTime").alias("modified"))
        )
        counted = self.files()
        now = listed.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
        same = (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
        stale = counted.join(now, "path", "left").where(~F.coalesce(same, F.lit(False))).select("path").limit(4).collect()
        if stale:
            raise ChangedFiles("counted files have changed or are gone: " + ", ".join(r[0] for r in stale))
        new = listed.where("length > 0").join(counted, "path", "left_anti")
        paths = sorted(r[0] for r in new.select("path").collect())
        if not paths:
            return 0
        n, attempt = self.version(), uuid.uuid4().hex
        at = f"{self.root}/attempts/{attempt}"
        rows = self.read(self.spark, paths)
        added = rollups.cubes(rows, self.grains, measure="Victim_Age", scale=self.scale)
        before = self.cubes() if n else {}
        for i, grain in enumerate(self.grains):
            cube, kept = added[grain], self._kept(grain)
            cube = rollups.fold_days(cube) if DATE in grain else cube
            if n:
                cube = rollups.weighted_cube(before[kept].unionByName(cube), kept)
            cube.write.parquet(f"{at}/cube-{i}")
        counted.unionByName(new).write.parquet(f"{at}/files")
        self._commit(n + 1, attempt)
        return len(paths)

    def rebuild(self, path: str | Sequence[str]) -> int:
        """Count all files under ``path`` anew, as after :class:`ChangedFiles`."""
        other = MaintainedCubes(self.spark, f"{self.root}/rebuild-{uuid.uuid4().hex}", self.grains, self.scale, self.read)
        counted = other.update(path)
        if counted:
            attempt = uuid.uuid4().hex
            at, source = f"{self.root}/attempts/{attempt}", other._attempt(1)
            for name in [*(f"cube-{i}" for i in range(len(self.grains))), "files"]:
                self.spark.read.parquet(f"{source}/{name}").write.parquet(f"{at}/{name}")
            self._commit(self.version() + 1, attempt)
        fs, p = other._fs(other.root)
        fs.delete(p, True)
        return counted

    def drop_old(self, keep: int = 2) -> None:
        """Delete all states but the last ``keep``, and what dead updates left.
        Call it when no update is under way."""
        commits = self._commits()
        live = {self._attempt(n).rsplit("/", 1)[1] for n in commits[-keep:]}
        for n in commits[:-keep]:
            fs, p = self._fs(f"{self.root}/commits/{n}")
            fs.delete(p, False)
        fs, p = self._fs(f"{self.root}/attempts")
        for f in fs.listStatus(p) if fs.exists(p) else []:
            if f.getPath().getName() not in live:
                fs.delete(f.getPath(), True)


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files by their name, all others as CSV, each by its own header."""
    parquet = [p for p in paths if p.lower().endswith(".parquet")]
    text = [p for p in paths if p not in set(parquet)]
    found = [readers.read_collisions_parquet(spark, parquet)] if parquet else []
    found += [readers.read_collisions_csv(spark, text, keep_corrupt=False, infer_extra=False)] if text else []
    whole = found[0]
    for df in found[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole


def report_grains(names: Iterable[str] | None = None) -> dict[tuple[str, ...], list[str]]:
    """The grains that answer the chosen results (all that a cube can answer)."""
    queries = {n: batch.catalogue.QUERIES[runner.RESULTS[n][0]] for n in (names or runner.RESULTS)}
    wanted = {n: ("table", set(q.columns) - batch.WEIGHT_COLUMNS) for n, q in queries.items() if not batch.needs_rows(q)}
    return {grain: group for (_, grain), group in batch.by_grain(wanted).items()}


def reports(store: MaintainedCubes, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """name -> result from the stored cubes, for a store with :func:`report_grains`."""
    cubes = store.cubes()
    chosen = {n: grain for grain, group in report_grains().items() for n in group}
    return {n: runner.report(n, cubes[store._kept(chosen[n])]) for n in (names or chosen)}
