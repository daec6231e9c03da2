"""Join helpers.

A dimension join is a plain equi-join: AQE reads the real size of the shuffled
dimension and broadcasts it only within the session's threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Up to so many keys are sent to every task; beyond, rows are dealt by key.
MOST_KEYS = 1_000_000


def join_dim(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Inner equi-join on ``key`` keeping ``columns`` of the dimension.

    USING-style: the result has one ``key`` column. Rows whose key is NULL or
    missing from the dimension are dropped. Building the join runs no job.
    """
    return fact.join(dim if columns is None else dim.select(key, *columns), key)


def anti_join_null_safe(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose ``key`` is not present in ``right``.

    NULL matches NULL (``<=>``), so a NULL key already present in ``right``
    is not returned again; a plain ``=`` anti join would return it forever.
    Only the key column of ``right`` is read.
    """
    r = right.select(F.col(key).alias("__anti_key"))
    return left.join(r, left[key].eqNullSafe(r["__anti_key"]), "left_anti")


def semi_join_null_safe(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose ``key`` is present in ``right``; NULL matches NULL."""
    r = right.select(F.col(key).alias("__semi_key"))
    return left.join(r, left[key].eqNullSafe(r["__semi_key"]), "left_semi")
