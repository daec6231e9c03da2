"""Derived measures used by silver and gold.

Every helper returns a Column of built-in expressions (codegen, no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_pct(numerator: Column | str, denominator: Column | str) -> Column:
    """``round(n / d * 100, 2)`` when ``d > 0``, else 0.0.

    A NULL or zero denominator gives 0.0; a NULL numerator with ``d > 0``
    stays NULL.
    """
    n, d = _c(numerator), _c(denominator)
    return F.when(d > 0, F.round(n / d * 100, 2)).otherwise(F.lit(0.0))


def yield_pct(actual: Column | str, defect: Column | str) -> Column:
    """Batch yield ``round((actual - defect) / actual * 100, 2)``.

    ``actual = 0`` (or NULL) gives NULL instead of an error, so ``avg`` skips it.
    """
    a, d = _c(actual), _c(defect)
    return F.round(F.try_divide(a - d, a) * 100, 2)


def count_when(condition: Column) -> Column:
    """Number of rows where ``condition`` is true (``sum(when(c,1).otherwise(0))``).

    ``count_if`` is the same under ``groupBy`` and returns bigint.
    """
    return F.count_if(condition)
