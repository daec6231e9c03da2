"""Vector code compression: product codes found by equal-average search."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import stored, table

#: Components become floor(SCALE * x).
SCALE = 256
_MOST = 2**63 - 1


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each row of ``parts``; ties go to the lower index.

    Entries are sorted by component sum. Each part starts between the two sums
    that enclose its own and walks outward, the smaller gap first. No entry
    whose squared gap over the dimension exceeds the best distance can be
    nearer, nor can any beyond it; one that equals it may still tie.
    """
    n, width = parts.shape
    k = len(entries)
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, want = sums[order], parts.sum(axis=1)
    right = np.searchsorted(sums, want)
    left = right - 1
    best, pick = np.full(n, -1, np.int64), np.full(n, k, np.int64)
    live = np.arange(n)
    far = np.iinfo(np.int64).max
    while len(live):
        lo, hi, w = left[live], right[live], want[live]
        below = np.where(lo >= 0, w - sums[np.maximum(lo, 0)], far)
        above = np.where(hi < k, sums[np.minimum(hi, k - 1)] - w, far)
        gap = np.minimum(below, above)
        there = gap < far
        gap = np.where(there, gap, 0)
        go = there & ((best[live] < 0) | (gap * gap <= best[live] * width))
        live, down = live[go], (below <= above)[go]
        entry = order[np.where(down, left[live], right[live])]
        left[live[down]] -= 1
        right[live[~down]] += 1
        d = ((parts[live] - entries[entry]) ** 2).sum(axis=1)
        better = (best[live] < 0) | (d < best[live]) | (d == best[live]) & (entry < pick[live])
        best[live[better]], pick[live[better]] = d[better], entry[better]
    return pick, best


def usable(vectors: DataFrame, parts: int = 16) -> DataFrame:
    """The rows of ``vectors`` that can be coded; embedding as array<double>.

    Rows whose vector is null or holds null or non-finite components go, as do
    those that cannot be cut into ``parts`` equal non-empty parts, and those of
    another length than the most frequent one (ties: the shorter).
    """
    v = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("embedding").isNotNull() & fine & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    common = v.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return v.where(F.size("embedding") == (common["size"] if common else 0))


def _integers(column: pa.Array, parts: int) -> np.ndarray:
    """(rows, parts, width) integers; clamped so that squared sums of a part stay within 64 bits."""
    x = column.flatten().to_numpy(zero_copy_only=False)
    x = x.reshape(len(column), parts, -1)
    bound = (1 << 30) // max(x.shape[2], 1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * x), -bound, bound).astype(np.int64)


def train(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """Codebooks (parts, entries, width) of usable ``vectors`` (vec_id, embedding).

    The first ones are the parts of the ``entries`` smallest vec_ids (null
    last; equal ids by vector). Each round assigns all parts and replaces each
    entry by its parts' componentwise floor(sum / count); unused ones stay.
    Tasks add up their own parts, so only one row per entry and task is
    shuffled and one per entry reaches the driver.
    """
    v = vectors.select("vec_id", "embedding")
    first = v.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    if not first:
        return np.empty((parts, 0, 0), np.int64)
    books = _integers(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), parts).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _replaced(v, books)
    return books


def _replaced(v: DataFrame, books: np.ndarray) -> np.ndarray:
    parts, k, width = books.shape
    names = ["part", "entry", "n", *(f"s{j}" for j in range(width))]

    def add(batches):
        total, n = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for b in batches:
            x = _integers(b["embedding"], parts)
            for p in range(parts if len(x) else 0):
                pick, _ = nearest(x[:, p], books[p])
                np.add.at(total[p], pick, x[:, p])
                n[p] += np.bincount(pick, minlength=k)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (p, e, n[p, e], *total[p, e].T)], names)

    sums = v.select("embedding").mapInArrow(add, ", ".join(f"{c} long" for c in names)).groupBy("part", "entry")
    out = books.copy()
    for r in sums.agg(*(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in names[2:])).collect():
        out[r["part"], r["entry"]] = [int(r[c]) // int(r["n"]) for c in names[3:]]
    return out


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of each usable row: two hex digits per part, and the squared distance of all parts."""
    parts = len(books)
    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            x = _integers(b["embedding"], parts)
            found = [nearest(x[:, p], books[p]) for p in range(parts)]
            text = np.stack([f[0] for f in found], axis=1).astype(np.uint8).tobytes().hex()
            code = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            error = [min(sum(e), _MOST) for e in zip(*(f[1].tolist() for f in found))]
            yield pa.RecordBatch.from_arrays([b["vec_id"], b["label"], pa.array(code), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, f"{kinds}, code string, error long")


def code_vectors(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks) of ``vectors`` (vec_id, embedding, label); see ``usable``, ``train`` and ``encode``.

    ``entries`` is at most 256. Fewer usable rows than that make shorter
    codebooks; an empty table has empty ones and no codes. Repeated rows each
    get a code. Components beyond 2^30 / width in size, after scaling, count as
    that limit, and a distance beyond 64 bits as the largest long. Codebooks
    are parts * entries * width integers, whatever the number of vectors.
    Other columns are not read.
    """
    v = usable(vectors.select("vec_id", "label", "embedding"), parts)
    books = train(v, parts, entries, rounds)
    return encode(v, books), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op12_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = code_vectors(table(spark, sf_dir, "embeddings"))
    codes = stored(codes, "codes")
    # a label's sum beyond 64 bits is the largest long, as a single error is
    by_label = codes.groupBy("label").agg(F.coalesce(F.try_sum("error"), F.lit(_MOST)).alias("label_error"))
    out = codes.alias("c").join(by_label.alias("l"), F.expr("c.label <=> l.label"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _nearest_sql(n: int) -> str:
    """SQL of the assignment to codebooks ``book{n}`` and of the ones that follow."""
    return f"""
near{n} AS (
  SELECT id, p, a, arg_min(k, d * 64 + k) AS k, min(d) AS d
  FROM (SELECT id, p, a, k, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(a, b)]) AS d
        FROM parts JOIN book{n} USING (p))
  GROUP BY id, p, a),
mean{n} AS (
  SELECT p, k, list(s ORDER BY i) AS b
  FROM (SELECT p, k, i, CAST(floor(sum(a[i]) / count(*)) AS BIGINT) AS s FROM near{n}, unnest(range(1, len(a) + 1)) u(i) GROUP BY p, k, i)
  GROUP BY p, k),
book{n + 1} AS (SELECT o.p, o.k, coalesce(m.b, o.b) AS b FROM book{n} o LEFT JOIN mean{n} m ON o.p = m.p AND o.k = m.k)"""


ORACLE = f"""
WITH x AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
         [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (SELECT id, p, e[p * (len(e) // 16) + 1 : (p + 1) * (len(e) // 16)] AS a FROM x, unnest(range(16)) u(p)),
book0 AS (SELECT p, id - 1 AS k, a AS b FROM parts WHERE id <= 64),
{_nearest_sql(0)},
{_nearest_sql(1)},
{_nearest_sql(2)},
digest AS (
  SELECT sha256(string_agg(CAST(b[i] AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256
  FROM book2, unnest(range(1, len(b) + 1)) u(i)),
coded AS (SELECT id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY id)
SELECT x.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY x.label) AS BIGINT) AS label_error, codebooks_sha256
FROM x JOIN coded USING (id), digest
"""
