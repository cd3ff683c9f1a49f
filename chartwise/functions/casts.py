"""Typed views of text columns. Spark runs with ANSI on, so plain casts raise
on bad input; every cast here is a try-cast that yields NULL instead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartwise.functions.text import strip_ws

# ISO dates, alone or followed by a time of day (with or without seconds,
# fraction and zone).
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"

# Letters that Java's number parser knows and chart text does not: type
# suffixes, hexadecimal, NaN and Infinity. What is left is a plain decimal,
# with or without an exponent.
NOT_A_NUMBER = "[dDfFxXnNiI]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns added (or replaced) that are worked out once a row.

    Filters and further columns on a plain derived column get the expression
    copied into them by the optimiser, so a parse would run once for each use.
    ``inline`` of a one-element array is a row-to-row step that predicates
    don't move through."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    order = [*df.columns, *[c for c in columns if c not in df.columns]]
    parsed = df.select(*kept, F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))))
    return parsed.select(*[F.col(f"`{c}`") for c in order])


def to_long_lenient(c) -> Column:
    """Integer text exactly; decimal text such as ``100.0`` (written by tools
    that hold the column as float) truncated toward zero; anything else NULL.

    One decimal parse does for both: it is exact for every BIGINT, and knows
    neither type suffixes nor hexadecimal."""
    return _col(c).try_cast("decimal(38,18)").try_cast("bigint")


def to_int_lenient(c) -> Column:
    """As ``to_long_lenient`` for INT."""
    return _col(c).try_cast("decimal(38,18)").try_cast("int")


def to_chart_date(c) -> Column:
    """ISO date or date-time text, padded or not, to DATE; other text is NULL,
    not an error."""
    s = strip_ws(c)
    return F.when(s.rlike(DATE_PATTERN), F.substring(s, 1, 10).try_cast("date"))


def coerce_numeric(c) -> Column:
    """Any text to DOUBLE, bad values NULL (the result-file reader's rule)."""
    s = _col(c).cast("string")
    return F.when(~s.rlike(NOT_A_NUMBER), s.try_cast("double"))
