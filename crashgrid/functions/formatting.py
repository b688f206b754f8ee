"""Text labels built with built-in string functions (no Python on rows)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_text(hour: str | Column) -> Column:
    """Zero-padded clock text, e.g. 7 -> '07:00'."""
    return F.format_string("%02d:00", _col(hour))


def area_hour_label(area: str | Column, hour: str | Column) -> Column:
    """'<area>  [HH:00]' label for an (area, hour) pair."""
    return F.format_string("%s  [%02d:00]", _col(area), _col(hour))


def first_word(text: str | Column) -> Column:
    return F.split_part(_col(text), F.lit(" "), F.lit(1))


def hour_band_label(hour: str | Column, band: str | Column) -> Column:
    """'HH:00 (<first word of band>)', e.g. '17:00 (Evening)'."""
    return F.format_string("%02d:00 (%s)", _col(hour), first_word(band))


def thousands(n: str | Column) -> Column:
    """Integer with thousands separators, e.g. 94062 -> '94,062'."""
    return F.format_number(_col(n), 0)


def percent_text(pct: str | Column) -> Column:
    """'12.3%' for a percentage value."""
    return F.format_string("%.1f%%", _col(pct))


def count_bar(n: str | Column, unit: int = 3000, glyph: str = "#") -> Column:
    """Text bar with one glyph per ``unit`` (integer division)."""
    return F.repeat(F.lit(glyph), F.floor(_col(n) / unit).cast("int"))
