"""Column helpers made of built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[ \\t-\\r]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a non-null text: runs of anything but space and tab to carriage return."""
    return let(
        F.trim(text, F.lit(BLANKS)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_RUN)),
    )


def lines_of(text: Column) -> Column:
    """Lines of a non-null text that hold a word, as they stand."""
    return F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != "")


def matches_of(text: Column, pattern: str, keep: Callable[[Column, Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as an array of
    (start, end), code points, end exclusive.

    The text between matches and the matches themselves alternate, so their
    lengths add up to positions. Sums over blocks keep a text with m matches
    at m * sqrt(m) steps. ``keep(match, group 2)`` drops matches; it is given
    the group only if the pattern has one.
    """
    none = F.array().cast("array<struct<start:int,end:int>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(m: Column, gaps: Column, sizes: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda a, b: a + b)
        total = lambda part: F.aggregate(part, F.lit(0), lambda acc, x: acc + x)

        def of(s: Column) -> Column:
            block = F.ceil(F.sqrt(F.size(s))).cast("int")

            def placed(b: Column) -> Column:
                blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / b).cast("int")), lambda q: total(F.slice(s, q * b + 1, b)))
                return let(
                    blocks,
                    lambda t: F.transform(
                        s,
                        lambda x, k: let(
                            total(F.slice(t, F.lit(1), F.floor(k / b).cast("int"))) + total(F.slice(s, F.floor(k / b).cast("int") * b + 1, k % b + 1)),
                            lambda e: F.struct((e - F.get(sizes, k)).alias("start"), e.alias("end")),
                        ),
                    ),
                )

            return let(block, placed)

        return let(steps, of)

    def located(m: Column) -> Column:
        gaps = F.transform(F.split(text, pattern), lambda g: F.length(g))
        sizes = F.transform(m, lambda g: F.length(g))
        every = let(gaps, lambda g: let(sizes, lambda z: spans(m, g, z)))
        if keep is None:
            return every
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        return let(
            value,
            lambda v: let(every, lambda e: F.filter(e, lambda x, k: keep(F.get(m, k), F.get(v, k)))),
        )

    return F.when(text.rlike(pattern), let(found, located)).otherwise(none)
