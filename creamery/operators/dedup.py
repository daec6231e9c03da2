"""Deterministic duplicate removal.

``dropDuplicates([key])`` keeps an arbitrary row per key, so two runs (or a
retried task) may keep different rows. Here the survivor is fixed: rows are
ranked within the key by the caller's order, then by every remaining column
ascending, and rank 1 is kept. NULL keys form one group, as with
``dropDuplicates``.

Physical plan: ``row_number() ... = 1`` is planned as a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it, so each map
task forwards at most one row per key. A hot key (even a third of all rows)
therefore reaches its reducer as at most one row per map task: the skew is
absorbed map-side, like a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creamery.operators.joins import MOST_KEYS, anti_join_null_safe, semi_join_null_safe

_RANK = "__dedup_rank"


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    order_columns: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per ``keys``.

    ``order`` are sort expressions that decide the survivor (first wins);
    ``order_columns`` names the columns they use, so that the tie-break over
    "every remaining column" does not repeat them.
    """
    keys = list(keys)
    used = set(keys) | set(order_columns)
    tie_break = [F.col(c).asc_nulls_first() for c in df.columns if c not in used]
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order, *tie_break)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_long_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), order_columns: Sequence[str] = (), most: int = MOST_KEYS
) -> DataFrame:
    """``dedup_by_key`` on one key, for stored rows that hold long texts: the same rows, and few texts shuffled.

    A first job over the key column alone finds the keys that stand in more
    than one row. Only their rows are ranked; the others pass where they lie.
    With more than ``most`` such keys all rows are ranked.
    """
    (key,) = keys
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    if repeated.count() > most:
        return dedup_by_key(df, keys, order, order_columns)
    repeated = F.broadcast(repeated)
    ranked = dedup_by_key(semi_join_null_safe(df, repeated, key), keys, order, order_columns)
    return anti_join_null_safe(df, repeated, key).unionByName(ranked)
