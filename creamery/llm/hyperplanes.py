"""Embedding near-dedup: random-hyperplane tables, exact cosine, components."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import stored, table
from creamery.llm.components import connected_components


ORACLE = """
WITH RECURSIVE ok AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding, label) AS id, vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
pair AS (
  SELECT x.id AS a, y.id AS b FROM ok x JOIN ok y ON x.label = y.label AND x.id <> y.id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
reach AS (SELECT id, id AS other FROM ok UNION SELECT r.id, p.b FROM reach r JOIN pair p ON r.other = p.a),
low AS (SELECT r.id, min(o.vec_id) AS component_id FROM reach r JOIN ok o ON r.other = o.id GROUP BY r.id),
linked AS (
  SELECT ok.vec_id, (SELECT count(*) FROM pair p WHERE p.a = ok.id) AS n_links, low.component_id FROM ok JOIN low USING (id)),
other AS (
  SELECT vec_id, CAST(0 AS BIGINT) AS n_links, vec_id AS component_id FROM embeddings
  WHERE label IS NULL OR embedding IS NULL OR len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) > 0
    OR len([x FOR x IN embedding IF x <> 0]) = 0)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM (SELECT * FROM linked UNION ALL SELECT * FROM other)
"""


def _rows(column: pa.Array) -> np.ndarray:
    """The vectors (of one length) as rows, each divided by the power of two above its largest component: products stay finite."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


_ID = "struct<a:long,b:long>"


def _with_keys(reps: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``reps`` plus keys: for each table the sides of its hyperplanes on which the vector lies."""
    names = reps.columns

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        power = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            sizes = np.diff(b["embedding"].offsets.to_numpy())
            keys = np.zeros((b.num_rows, tables), np.int64)
            for dim in np.unique(sizes).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))
                at = np.flatnonzero(sizes == dim)
                sign = (_rows(b["embedding"].take(pa.array(at))) @ planes[dim] > 0).reshape(-1, tables, bits)
                keys[at] = (sign * power).sum(axis=2)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * tables, pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*names, "keys"])

    return reps.mapInArrow(run, reps.withColumn("keys", F.array(F.lit(0).cast("long"))).schema)


def _first_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first table in which the keys of each pair of rows agree."""
    return (x == y).argmax(axis=1)


def _pair_links(members: DataFrame, reps: DataFrame, tables: int, cosine: float) -> DataFrame:
    """(a, b, ma, mb): the linked pairs of small buckets, but those that a large bucket counts."""

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            x, y = _rows(b["ea"]), _rows(b["eb"])
            cos = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
            ka, kb = (b[c].flatten().to_numpy().reshape(-1, tables) for c in ("ka", "kb"))
            large = np.zeros((b.num_rows, tables), bool)
            offsets = b["large"].offsets.to_numpy()
            large[np.repeat(np.arange(b.num_rows), np.diff(offsets)), b["large"].flatten().to_numpy()] = True
            use = (cos >= cosine) & ~large[np.arange(b.num_rows), _first_shared(ka, kb)]
            yield b.select(["a", "b", "ma", "mb"]).filter(pa.array(use))

    pairs = members.alias("x").join(members.alias("y"), F.expr("x.label = y.label AND x.dim = y.dim AND x.t = y.t AND x.k = y.k AND x.id < y.id"))
    pairs = pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), "x.dim").distinct()
    side = lambda s, *more: reps.select(F.col("id").alias(s), F.col("m").alias("m" + s), F.col("embedding").alias("e" + s), F.col("keys").alias("k" + s), *more)
    rows = pairs.join(side("a", "large"), "a").join(side("b"), "b")
    # vectors of one length in a batch: sorted by it, and cut where it changes
    rows = rows.sortWithinPartitions("dim").select("a", "b", "ma", "mb", "ea", "eb", "ka", "kb", "large")

    def by_length(batches):
        for b in batches:
            sizes = np.diff(b["ea"].offsets.to_numpy())
            cuts = np.flatnonzero(np.diff(sizes)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                yield from run([pa.RecordBatch.from_arrays([c.take(pa.array(np.arange(lo, hi))) for c in b.columns], b.schema.names)])

    return rows.mapInArrow(by_length, f"a {_ID}, b {_ID}, ma long, mb long")


def _components(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each of ``n`` rows by the pairs (p, q)."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, p, low[q])
        np.minimum.at(low, q, low[p])
        low = low[low]
        if (low == before).all():
            return low


def _block_links(members: DataFrame, reps: DataFrame, tables: int, cosine: float, block: int) -> DataFrame:
    """(id, far, root) of vectors in large buckets: linked rows counted, and one row of the same component.

    A bucket is dealt in blocks, and each two of its blocks meet in one group,
    so that no group holds more than two blocks and none gives more rows than
    it holds. A pair is counted in the first table whose bucket it shares.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = members.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select("id", "label", "dim", "t", "k", "own", F.least("own", "other").alias("u"), F.greatest("own", "other").alias("v"))
    rows = met.join(reps.select("id", "m", "embedding", "keys"), "id").select(F.col("id.a").alias("a"), F.col("id.b").alias("b"), "label", "dim", "t", "k", "own", "u", "v", "m", "embedding", "keys")

    def run(pdf):
        x = np.stack(pdf["embedding"].to_list()).astype(np.float64)
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        keys, m, t = np.stack(pdf["keys"].to_list()), pdf["m"].to_numpy(), int(pdf["t"].iloc[0])
        left = np.flatnonzero(pdf["own"].to_numpy() == pdf["u"].iloc[0])
        same = pdf["u"].iloc[0] == pdf["v"].iloc[0]
        right = left if same else np.flatnonzero(pdf["own"].to_numpy() == pdf["v"].iloc[0])
        found = []
        for lo in range(0, len(left), 64):  # bounded memory for the keys of the pairs
            rows = left[lo : lo + 64]
            p, q = np.nonzero(x[rows] @ x[right].T >= cosine)
            p, q = rows[p], right[q]
            use = (p < q) if same else np.ones(len(p), bool)
            p, q = p[use], q[use]
            use = _first_shared(keys[p], keys[q]) == t
            found.append((p[use], q[use]))
        p, q = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, int), np.empty(0, int))
        far = np.zeros(len(x), np.int64)
        np.add.at(far, p, m[q])
        np.add.at(far, q, m[p])
        low = _components(len(x), p, q)
        out = pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "far": far, "ra": pdf["a"].to_numpy()[low], "rb": pdf["b"].to_numpy()[low]})
        return out[far > 0]

    told = rows.groupBy("label", "dim", "t", "k", "u", "v").applyInPandas(run, "a long, b long, far long, ra long, rb long")
    return told.select(F.struct("a", "b").alias("id"), "far", F.struct(F.col("ra").alias("a"), F.col("rb").alias("b")).alias("root"))


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.93, miss: float = 1e-4, seed: int = 11, small: int = 64, block: int = 512) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``vectors`` (vec_id, embedding, label).

    Equal vectors of one label collapse first and count as linked; a vector is
    known by two hashes over label and components. Bits per table follow the
    largest label's size, and so many tables are made that a pair at the limit
    is missed with probability ``miss`` at most; candidates are verified in
    double precision. Pairs of buckets up to ``small`` vectors are rows;
    larger buckets are compared in blocks and give a count and a component
    row per vector, so a group of near copies makes no row per pair. Labels must be equal. Rows that share a vec_id are
    different vectors, each with its own links. Rows whose label is null or
    whose vector is null, empty, zero or holds null or non-finite components
    link with nothing, as do vectors of different lengths. An empty table
    gives no rows; other columns are not read.
    """
    fine = F.col("label").isNotNull() & F.col("embedding").isNotNull()
    fine &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    hashes = F.struct(F.xxhash64("label", "embedding").alias("a"), F.xxhash64(F.lit(1), "label", "embedding").alias("b"))
    keyed = v.withColumn("id", F.when(F.coalesce(fine, F.lit(False)), hashes))
    reps = stored(
        keyed.where("id IS NOT NULL").groupBy("id").agg(F.min("vec_id").alias("low"), F.count("*").alias("m"), F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding")),
        "vectors",
    )
    agree = 1 - math.acos(cosine) / math.pi
    most = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits = min(40, max(4, math.ceil(math.log2(most + 1))))
    tables = math.ceil(math.log(miss) / math.log1p(-(agree**bits)))
    keyed_reps = stored(_with_keys(reps, bits, tables, seed), "keys")
    members = keyed_reps.select("id", "label", F.size("embedding").alias("dim"), F.posexplode("keys").alias("t", "k"))
    bucket = ["label", "dim", "t", "k"]
    sizes = stored(members.groupBy(*bucket).agg(F.count("*").alias("size")).where(F.col("size") > small), "large")
    crowded = members.join(sizes, bucket)
    large = crowded.groupBy("id").agg(F.collect_set("t").alias("large"))
    told = keyed_reps.join(large, "id", "left").withColumn("large", F.coalesce("large", F.array().cast("array<int>")))
    told = stored(told, "vectors")
    edges = stored(_pair_links(members.join(sizes, bucket, "left_anti"), told, tables, cosine), "links")
    counts = stored(_block_links(crowded, told, tables, cosine, block), "links")
    roots = connected_components(edges.select("a", "b").unionByName(counts.select(F.col("id").alias("a"), F.col("root").alias("b"))))
    far = edges.select(F.col("a").alias("id"), F.col("mb").alias("m")).unionByName(edges.select(F.col("b").alias("id"), F.col("ma").alias("m")))
    far = far.unionByName(counts.select("id", F.col("far").alias("m"))).groupBy("id").agg(F.sum("m").alias("far"))
    classes = reps.select("id", "low", "m").join(far, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = classes.join(lowest, "root").select("id", (F.coalesce("far", F.lit(0)) + F.col("m") - 1).alias("n"), "component_id")
    out = keyed.select("vec_id", "id").join(classes, "id", "left").select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.expr("vec_id <=> component_id"))


def op8_hyperplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
