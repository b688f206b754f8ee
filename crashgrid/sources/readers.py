"""Readers for the collision table (CSV or Parquet, any Hadoop-compatible path).

The columns of the contract need no inference pass: each file's header line is
read to learn which columns it has and in what order, files with the same header
are read together, every column as text, and then turned into its type. A number
such as ``3.0`` is a whole number. Rows with text that does not fit are kept,
with null for the value; ``_corrupt_record`` says what did not fit, so they can
be counted.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.enrich import text_flag
from .schema import COLUMN_TYPES, OPTIONAL_COLUMNS, REQUIRED_COLUMNS, SchemaError, validate

CORRUPT_COL = "_corrupt_record"
FLAG_COLUMNS = ["Is_Weekend", "Is_Hotspot"]


# Files whose header lines are read at once; reading one waits for storage only.
HEADER_READERS = 16


def data_files(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv") -> list[str]:
    """The files that Spark reads for ``path``: names only, none is opened."""
    reader = spark.read.schema("value string")
    return sorted((reader.text(path) if fmt == "csv" else reader.parquet(path)).inputFiles())


def _first_line(spark: SparkSession, file: str) -> str:
    """A file's first line, through the file system Spark would use, unpacked by
    the codec its name tells."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec is not None else stream, "UTF-8")
        return (jvm.java.io.BufferedReader(text).readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def headers(spark: SparkSession, files: Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """header -> the files that begin with it. Empty files, which have none, are
    left out. One line of each file is read, by a few threads of the driver."""

    def columns(file: str) -> tuple[str, ...]:
        line = _first_line(spark, file)
        return tuple(next(csv.reader([line], delimiter=sep))) if line else ()

    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        for file, header in zip(files, pool.map(columns, files)):
            if header:
                found.setdefault(header, []).append(file)
    return found


def check_headers(found: Mapping[tuple[str, ...], Sequence[str]], required: Sequence[str] = tuple(REQUIRED_COLUMNS)) -> None:
    """Each file has every required column, and none twice; one error names the
    files that do not, a few of each kind, and what they lack."""
    problems = []
    for header, files in found.items():
        missing = [c for c in required if c not in header]
        twice = sorted({c for c in header if header.count(c) > 1})
        what = ["missing columns: " + ", ".join(missing)] * bool(missing) + ["repeated columns: " + ", ".join(twice)] * bool(twice)
        if what:
            more = f" and {len(files) - 3} more files" if len(files) > 3 else ""
            problems.append("; ".join(what) + " in " + ", ".join(files[:3]) + more)
    if problems:
        raise SchemaError(" | ".join(problems))


def read_collisions_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    keep_corrupt: bool = True,
    infer_extra: bool = True,
) -> DataFrame:
    """Headered CSV files -> typed collision table.

    * Every file is read by its own header: files with the same columns in another
      order give the same rows, an extra column is null where a file lacks it.
    * A file without a required column raises one :class:`SchemaError` that names
      it and all other problems.
    * ``Victim_Age`` is optional: added as a null double when absent.
    * Boolean flags are text (True/true/FALSE/empty); anything else does not fit.
    * Columns beyond the contract get the narrowest type that all their values
      fit, of int, bigint, double, boolean, date and timestamp, from one more
      pass over these columns (``infer_extra``); else they stay text.
    * With ``keep_corrupt``, ``_corrupt_record`` holds the values that do not fit
      their type, or the raw line if it has too many or too few values, and
      null for a sound row (see :func:`bad_row_count`).
    """
    found = headers(spark, data_files(spark, path), sep)
    check_headers(found or {(): [str(path)]})
    extra = sorted({c for header in found for c in header if c not in COLUMN_TYPES and c != CORRUPT_COL})
    shared = [c for c in COLUMN_TYPES if any(c in header for header in found)]
    whole = None
    for header, files in found.items():
        names = ["_corrupt_text" if c == CORRUPT_COL else c for c in header]
        fields = [T.StructField(name, T.StringType(), True) for name in [*names, CORRUPT_COL]]
        text = (
            spark.read.schema(T.StructType(fields)).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
            .option("enforceSchema", True).option("columnNameOfCorruptRecord", CORRUPT_COL).csv(files)
        )
        absent = [F.lit(None).cast("string").alias(c) for c in [*shared, *extra] if c not in header]
        part = text.select("*", *absent).select(*shared, *extra, CORRUPT_COL)
        whole = part if whole is None else whole.unionByName(part)
    typed = {c: typed_text(c) for c in shared}
    misfits = [
        F.when((F.trim(c) != "") & v.isNull(), F.concat(F.lit(f"{c}="), F.col(c)))
        for c, v in typed.items()
        if not isinstance(COLUMN_TYPES[c], T.StringType)
    ]
    typed |= extra_types(whole, extra) if infer_extra and extra else {}
    corrupt = F.coalesce(F.col(CORRUPT_COL), F.nullif(F.concat_ws(", ", *misfits), F.lit("")))
    kept = [corrupt.alias(CORRUPT_COL)] if keep_corrupt else []
    return normalise(whole.select(*[typed.get(c, F.col(c)).alias(c) for c in [*shared, *extra]], *kept))


# What a column beyond the contract may be, narrowest first.
EXTRA_TYPES = ("int", "bigint", "double", "boolean", "date", "timestamp")


def extra_types(text: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Each text column as the first of ``EXTRA_TYPES`` that all its values fit;
    one without values, or with values of no one type, stays text. One pass that
    reads these columns only and adds up one count per column and type."""
    value = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in columns}
    fits = lambda c, t: value[c].isNull() | (value[c].rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") if t == "date" else F.lit(True)) & value[c].try_cast(t).isNotNull()
    misfits = text.agg(*[
        F.struct(F.count(value[c]).alias("n"), *[F.count_if(~fits(c, t)).alias(t) for t in EXTRA_TYPES]).alias(c) for c in columns
    ]).first()
    out = {}
    for c in columns:
        kind = next((t for t in EXTRA_TYPES if misfits[c]["n"] and not misfits[c][t]), None)
        if kind:
            out[c] = value[c].try_cast(kind)
    return out


def typed_text(name: str) -> Column:
    """A contract column read from text; null where the text does not fit."""
    dtype, text = COLUMN_TYPES[name], F.trim(name)
    if name in FLAG_COLUMNS:
        return text_flag(name)
    if isinstance(dtype, T.IntegerType):
        number = text.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    if isinstance(dtype, T.StringType):
        return F.col(name)
    return text.try_cast(dtype)


def read_collisions_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet -> typed collision table (contract and types checked from the footer)."""
    return normalise(validate(spark.read.parquet(*([path] if isinstance(path, str) else path))))


def normalise(df: DataFrame) -> DataFrame:
    """Cast contract columns to their types, normalise text flags, add optional
    columns. Pure projection: no job runs."""
    exprs = {}
    for name in FLAG_COLUMNS:
        if name in df.columns and not isinstance(df.schema[name].dataType, T.BooleanType):
            exprs[name] = text_flag(name)
    for name, dtype in COLUMN_TYPES.items():
        if name in df.columns and name not in exprs and name not in FLAG_COLUMNS:
            if df.schema[name].dataType != dtype:
                exprs[name] = F.col(name).cast(dtype)
    for name in OPTIONAL_COLUMNS:
        if name not in df.columns:
            exprs[name] = F.lit(None).cast(COLUMN_TYPES[name])
    return df.withColumns(exprs) if exprs else df


def bad_row_count(df: DataFrame) -> int:
    """Number of rows with text that does not fit the contract (0 without the column)."""
    if CORRUPT_COL not in df.columns:
        return 0
    return int(df.agg(F.count_if(F.col(CORRUPT_COL).isNotNull())).first()[0])
