"""Tolerant casts: malformed input becomes NULL in both ANSI and legacy mode.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; there is no Python on the row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_int(col: Column | str) -> Column:
    """String -> int the way a legacy (non-ANSI) cast reads numbers.

    ``'23'`` -> 23, ``'23.0'`` / ``'23.9'`` -> 23 (truncation), junk -> NULL.
    A plain ``try_cast('23.0' as int)`` would give NULL, so text is read
    again without its fraction, however many digits that has.
    """
    c = _c(col)
    whole = F.regexp_replace(F.trim(c.cast("string")), r"\.[0-9]*$", "")
    return F.coalesce(c.try_cast("int"), whole.try_cast("int"))


def to_double(col: Column | str) -> Column:
    return _c(col).try_cast("double")


def to_timestamp(col: Column | str) -> Column:
    """ISO-8601 text or an existing timestamp -> timestamp; malformed -> NULL."""
    return _c(col).try_cast("timestamp")
