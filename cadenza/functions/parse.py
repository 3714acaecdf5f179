"""Column functions for turning delimited text into typed values.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen and Catalyst can prune/push around them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line: ColumnOrName, sep: str = ",", fields: int | None = None) -> Column:
    """Split a line into an ``array<string>``; with ``fields``, only that many
    are cut and one last element holds the rest of the line.

    Unlike a JVM ``String.split``, trailing empty fields are kept, so a
    missing last value stays visible as an empty string (null after
    :func:`field`).
    """
    return F.split(_c(line), _regex_literal(sep), -1 if fields is None else fields + 1)


def _regex_literal(sep: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in sep)


def field(arr: ColumnOrName, i: int) -> Column:
    """Element ``i`` (0-based) of an array, null when out of range."""
    return F.get(_c(arr), i)


def to_double(c: ColumnOrName, strict: bool = True) -> Column:
    """Parse a string as double. ``strict`` raises on bad input (ANSI cast);
    otherwise bad input becomes null (``try_cast``)."""
    c = _c(c)
    return c.cast("double") if strict else c.try_cast("double")


def to_int_truncated(c: ColumnOrName, strict: bool = True) -> Column:
    """Parse a numeric string and truncate toward zero to ``int``
    (``"2001.0"`` -> 2001, ``"-3.7"`` -> -3)."""
    d = to_double(c, strict)
    return d.cast("int") if strict else d.try_cast("int")


def to_double_array(arr: ColumnOrName, strict: bool = True) -> Column:
    """``array<string>`` -> ``array<double>`` in one cast."""
    arr = _c(arr)
    return arr.cast("array<double>") if strict else arr.try_cast("array<double>")


def strip_quotes(c: ColumnOrName, quote: str = '"') -> Column:
    """Remove every quote character from a string."""
    return F.regexp_replace(_c(c), _regex_literal(quote), "")


def nan_to_zero(c: ColumnOrName) -> Column:
    """NaN -> 0.0; nulls stay null (``na.fill`` would also fill nulls)."""
    return F.nanvl(_c(c), F.lit(0.0))
