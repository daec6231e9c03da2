"""Connected components of an edge table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamery.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step; ``edges`` holds (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(low, "u")
    moved = joined.where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(low.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id of ``edges`` (a, b): root is the smallest id reachable.

    Each round writes its edges to the shared folder, so a lost executor
    replays one round. Nothing but a row count and a hash reaches the driver.
    An empty edge table gives an empty result; loops and repeats are ignored.
    """
    star = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc"
    )
    seen = None
    while True:
        star = stored(_star(_star(star, True), False), "cc")
        mark = star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
    return star.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        star.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )
