"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import held_out, table

DIM = 1 << 16
_TERM = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of the whole text with damped counts."""
    c = Counter(_TERM.findall((text or "").lower()))
    f = Counter()
    for w, n in c.items():
        f[zlib.crc32(w.encode()) % DIM] += n
    return np.fromiter(f.keys(), np.int32, len(f)), np.log1p(np.fromiter(f.values(), np.float32, len(f)))


def _sample(docs: DataFrame, most: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of at most ``most`` distinct rows of ``docs`` (doc_id, text), the first ones in a hash order.

    A hash limit taken from the row count lets about twice as many rows leave
    the scan; only their features are ordered and reach the driver.
    """

    def run(batches):
        for b in batches:
            fs = [features(t.as_py()) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["u"], *(pa.array([f[k].tobytes() for f in fs], pa.binary()) for k in (0, 1))], ["u", "i", "v"])

    keyed = docs.select("text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("u"))
    n = keyed.agg(F.approx_count_distinct("u")).first()[0]
    some = keyed.where(F.pmod("u", F.lit(1 << 32)) < int(min(1.0, 2 * most / max(n, 1)) * (1 << 32))).dropDuplicates(["u"])
    rows = some.select("u", "text").mapInArrow(run, "u long, i binary, v binary").orderBy("u").limit(most).collect()
    return [(np.frombuffer(r["i"], np.int32), np.frombuffer(r["v"], np.float32)) for r in rows]


def risk(z: np.ndarray, is_p: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk of scores ``z`` under the logistic loss, and the descent direction's derivative by ``z``.

    Risk: prior * R_p+ + max(0, R_u- - prior * R_p-). Where the second part is
    negative, the direction is that part's alone, with its sign turned.
    """
    n_p, n_u = is_p.sum(), (~is_p).sum()
    s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    negative = np.logaddexp(0, z[~is_p]).mean() - prior * np.logaddexp(0, z[is_p]).mean()
    g = np.zeros(len(z))
    if negative >= 0:
        g[is_p] = prior * (s[is_p] - 1) / n_p - prior * s[is_p] / n_p
        g[~is_p] = s[~is_p] / n_u
    else:
        g[is_p] = prior * s[is_p] / n_p
        g[~is_p] = -s[~is_p] / n_u
    return prior * np.logaddexp(0, -z[is_p]).mean() + max(0.0, negative), g


def fit(positive: list, unlabelled: list, prior: float, epochs: int = 300, rate: float = 0.1, decay: float = 1e-4, prior_df: float = 20.0) -> dict:
    """A linear classifier under ``risk``, by Adam steps over all rows.

    A term's feature is damped by n / (n + prior_df), n being the positive rows
    that hold it: what few documents say about a word counts less, but counts.
    """
    rows = positive + unlabelled
    w, bias = np.zeros(DIM), -1.0
    if not positive or not unlabelled:
        return {"w": w, "bias": -20.0}
    df = np.bincount(np.concatenate([r[0] for r in rows]), minlength=DIM)
    df_p = np.bincount(np.concatenate([r[0] for r in positive]), minlength=DIM)
    scale = (np.log((1 + len(rows)) / (1 + df)) * df_p / (df_p + prior_df)).astype(np.float32)
    idx = np.concatenate([r[0] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    use = scale[idx] > 0
    val = np.concatenate([r[1] for r in rows])[use] * scale[idx[use]]
    idx, row = idx[use], row[use]
    is_p = np.arange(len(rows)) < len(positive)
    m, s = np.zeros(DIM + 1), np.zeros(DIM + 1)
    for step in range(1, epochs + 1):
        z = np.bincount(row, weights=w[idx] * val, minlength=len(rows)) + bias
        _, g = risk(z, is_p, prior)
        grad = np.append(np.bincount(idx, weights=val * g[row], minlength=DIM) + decay * w, g.sum())
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return {"w": w * scale, "bias": float(bias)}


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 2000, max_unlabelled: int = 8000) -> dict:
    """Fit on confirmed toxic rows of ``docs`` (doc_id, text) and unlabelled text, each a bounded sample in a hash order.

    The class prior is the toxic share of the labelled rows (doc_id, toxic)
    given; labels of 0 serve for nothing else. An id labelled twice is toxic
    if one label says so. Equal rows count once, null texts are not learned
    from, texts are read whole. Without toxic rows, or without text, every
    score is near 0.
    """
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share, n = known.agg(F.avg("toxic"), F.count_if(F.col("toxic") == 1)).first()
    some = docs.where("text IS NOT NULL").select("doc_id", "text")
    order = F.xxhash64(F.lit(5), "doc_id")
    limit = int(min(1.0, 4 * max_positive / max(n, 1)) * (1 << 32))
    ids = known.where("toxic = 1").where(F.pmod(order, F.lit(1 << 32)) < limit).orderBy(order, "doc_id").limit(2 * max_positive)
    # at most 2 * max_positive ids are sent to the tasks, so that no text moves for the join
    toxic = some.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    return fit(_sample(toxic, max_positive, 1), _sample(some, max_unlabelled, 2), min(max(share or 0.0, 1e-3), 0.5))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` plus toxic_score (0 to 1) of each whole text; null and empty texts score by the bias.

    A column named toxic_score in ``docs`` is replaced; others pass through.
    """
    docs = docs.drop("toxic_score")
    sent, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def run(batches):
        w, bias = sent.value["w"], sent.value["bias"]
        for b in batches:
            out = []
            for t in b["text"]:
                i, v = features(t.as_py())
                out.append(1 / (1 + np.exp(-np.clip(float(w[i] @ v) + bias, -30, 30))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*names, "toxic_score"])

    return docs.mapInArrow(run, docs.withColumn("toxic_score", F.lit(0.0)).schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = ~held_out(F.col("doc_id"))
    model = train(docs.where(learn), table(spark, sf_dir, "labels").where(learn).select("doc_id", "toxic"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
