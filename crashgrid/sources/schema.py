"""The collision table's schema and the column contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The required column contract, in the published order.
REQUIRED_COLUMNS = [
    "DR_Number", "Date_Occurred", "Hour", "Area_Name",
    "Day_of_Week", "Time_of_Day", "Season", "Is_Weekend",
    "Year", "Month", "Collision_Severity", "Road_Type",
    "Is_Hotspot", "Congestion_Index", "Address",
    "Latitude", "Longitude",
]
OPTIONAL_COLUMNS = ["Victim_Age"]

COLUMN_TYPES: dict[str, T.DataType] = {
    "DR_Number": T.StringType(),  # only counted and listed: any text is an id
    "Date_Occurred": T.DateType(),
    "Hour": T.IntegerType(),
    "Area_Name": T.StringType(),
    "Day_of_Week": T.StringType(),
    "Time_of_Day": T.StringType(),
    "Season": T.StringType(),
    "Is_Weekend": T.BooleanType(),
    "Year": T.IntegerType(),
    "Month": T.IntegerType(),
    "Collision_Severity": T.StringType(),
    "Road_Type": T.StringType(),
    "Is_Hotspot": T.BooleanType(),
    "Congestion_Index": T.StringType(),
    "Address": T.StringType(),
    "Latitude": T.DoubleType(),
    "Longitude": T.DoubleType(),
    "Victim_Age": T.DoubleType(),
}

# Numeric types a column may arrive as and still be accepted (widened on read).
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = _INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType)


class SchemaError(ValueError):
    """Raised once, naming every missing or mistyped column."""


def collision_schema() -> T.StructType:
    """The contract as a read schema, for sources that need one (streams)."""
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in COLUMN_TYPES.items()])


def _compatible(expected: T.DataType, actual: T.DataType) -> bool:
    if type(expected) is type(actual):
        return True
    if isinstance(expected, T.StringType) and isinstance(actual, _INTEGRAL):
        return True
    if isinstance(expected, _INTEGRAL) and isinstance(actual, _INTEGRAL):
        return True
    if isinstance(expected, T.DoubleType) and isinstance(actual, _NUMERIC):
        return True
    if isinstance(expected, T.DateType) and isinstance(actual, (T.TimestampType, T.TimestampNTZType)):
        return True
    return False


def validate(df: DataFrame, required: list[str] | None = None, check_types: bool = True) -> DataFrame:
    """Check the column contract; raise one :class:`SchemaError` naming all problems.

    Only the schema is inspected (no job runs). Returns ``df`` unchanged so it can
    be used with ``df.transform(validate)``.
    """
    required = REQUIRED_COLUMNS if required is None else required
    fields = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in required if c not in fields]
    mistyped = []
    if check_types:
        for c in required + OPTIONAL_COLUMNS:
            if c in fields and c in COLUMN_TYPES and not _compatible(COLUMN_TYPES[c], fields[c]):
                mistyped.append(f"{c} ({fields[c].simpleString()}, expected {COLUMN_TYPES[c].simpleString()})")
    if missing or mistyped:
        parts = []
        if missing:
            parts.append("missing columns: " + ", ".join(missing))
        if mistyped:
            parts.append("mistyped columns: " + ", ".join(mistyped))
        raise SchemaError("; ".join(parts))
    return df
