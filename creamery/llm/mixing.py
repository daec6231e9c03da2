"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creamery.llm.common import stored, table, words

BINS = 1 << 16


def water_fill(sizes: list[int], weights: list[float], budget: float, max_epochs: float) -> list[float]:
    """Targets that share ``budget`` by weight, none above ``max_epochs`` times its size."""
    caps = [max_epochs * s for s in sizes]
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), min(budget, float(sum(caps)))
    while free:
        total = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / total > caps[i]}
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = caps[i]
        left -= sum(caps[i] for i in over)
        free -= over
    return out


def mix(docs: DataFrame, size: Column, weights: tuple = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17) -> DataFrame:
    """``docs`` plus _size, _source_size, _target and _epochs (whole copies to take).

    Every document is taken floor(target / source size) times; a seeded hash
    order of the rows decides which get one more, up to the target. The sizes
    and hashes are stored once and hash bins are summed before the one bin on
    the border is ordered, so no task sorts a whole source. Equal rows have
    one place in the order; as many of them are taken as the target still
    holds. One row per source reaches the driver, which fills the targets.
    Size 0 takes none of the budget. Null sources are one source, the last.
    Null, empty and long texts are mixed as their sizes say; an empty table
    gives no rows. Columns of ``docs`` with the names above or "_u", "_bin",
    "_src", "_whole", "_rest", "_edge", "_edge_bin", "_edge_more", "_more" are
    replaced or dropped.
    """
    spark, own = docs.sparkSession, ["_size", "_source_size", "_target", "_epochs", "_u", "_bin", "_src", "_whole", "_rest", "_edge", "_edge_bin", "_edge_more", "_more"]
    docs = docs.drop(*own)
    names = docs.columns
    # the order depends on a row's own values only, so reruns agree; the hash skips nulls
    whole = F.xxhash64(F.lit(seed), *[x for c in names for x in (F.col(c), F.col(c).isNull())])
    d = docs.withColumns({"_u": whole, "_src": F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s"))})
    slim = stored(d.select("_src", "_u", size.cast("long").alias("_size")), "sizes").withColumn("_bin", F.pmod("_u", F.lit(BINS)))
    bins = stored(slim.groupBy("_src", "_bin").agg(F.sum("_size").alias("b")), "bins")
    sizes = sorted((r["_src"]["n"], r["_src"]["s"], r["t"]) for r in bins.groupBy("_src").agg(F.sum("b").alias("t")).collect())
    targets = water_fill([s[2] for s in sizes], [float(weights[i % len(weights)]) for i in range(len(sizes))], share * sum(s[2] for s in sizes), max_epochs)
    rows = []
    for (null, name, total), target in zip(sizes, targets):
        times = int(target // total) if total else 0
        rows.append(((null, name), total, float(target), times, float(target - times * total)))
    plan = _local(spark, rows, f"_src {_SOURCE}, _source_size long, _target double, _whole int, _rest double")
    before = Window.partitionBy("_src").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    edge = bins.withColumn("_before", F.coalesce(F.sum("b").over(before), F.lit(0))).join(plan.select("_src", "_rest"), "_src")
    edge = edge.where("_before <= _rest AND _before + b > _rest").groupBy("_src").agg(F.min("_bin").alias("_bin"), F.min("_before").alias("_before"), F.min("_rest").alias("_rest"))
    # in the border bin: rows of one hash as one, with their number
    same = slim.join(_sent(edge, len(rows)), ["_src", "_bin"]).groupBy("_src", "_bin", "_before", "_rest", "_u").agg(F.sum("_size").alias("b"), F.count("*").alias("m"))
    order = Window.partitionBy("_src").orderBy("_u").rowsBetween(Window.unboundedPreceding, -1)
    last = same.withColumn("_room", F.col("_rest") - F.col("_before") - F.coalesce(F.sum("b").over(order), F.lit(0))).where("_room < b AND _room >= 0")
    last = last.select("_src", "_bin", "_u", F.floor(F.col("_room") * F.col("m") / F.col("b")).alias("more"))
    border = {tuple(r["_src"]): (r["_bin"], r["_u"], r["more"]) for r in last.collect()}
    plan = _local(spark, [(*r, *border.get(r[0], (None, None, None))) for r in rows], f"_src {_SOURCE}, _source_size long, _target double, _whole int, _rest double, _edge_bin long, _edge long, _edge_more long")
    d = d.withColumn("_bin", F.pmod("_u", F.lit(BINS))).join(plan, "_src")
    before_edge = F.col("_edge").isNull() | (F.col("_bin") < F.col("_edge_bin")) | (F.col("_bin") == F.col("_edge_bin")) & (F.col("_u") < F.col("_edge"))
    first = (F.col("_rest") > 0) & before_edge  # nothing left to share: not even texts without a word get one more
    at_edge = F.coalesce(F.col("_u") == F.col("_edge"), F.lit(False))
    clear = d.where(~at_edge).withColumn("_more", F.coalesce(first, F.lit(False)).cast("int"))
    # the equal rows on the border are counted, and come out again with so many of them taken
    tied = d.where(at_edge).groupBy(d.columns).agg(F.count("*").alias("_more"))
    tied = tied.withColumn("_more", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_more")))).withColumn("_more", (F.col("_more") <= F.col("_edge_more")).cast("int"))
    out = clear.unionByName(tied).withColumns({"_size": size.cast("long"), "_epochs": F.col("_whole") + F.col("_more")})
    return out.select(*names, "_size", "_source_size", "_target", "_epochs")


_SOURCE = "struct<n:boolean,s:string>"
#: Up to so many sources, their rows are sent to every task; beyond, they are joined by a shuffle.
MOST_SENT = 100_000


def _local(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return _sent(spark.createDataFrame(rows, schema), len(rows))


def _sent(df: DataFrame, n: int) -> DataFrame:
    """``df``, of a row per source at most: never does the other side of its join go to every task instead."""
    return F.broadcast(df) if n <= MOST_SENT else df.hint("merge")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mix(docs, F.size(words(F.col("text"))))
    return out.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_epochs")).alias("taken"),
    )
