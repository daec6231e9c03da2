"""Exact dedup by composable polynomial fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import let, stored, table

#: Two primes below 2^31, each with its base.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
KEY = ["n_bytes", "p", "q"]

ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


class Polynomial:
    """h(x) = sum of (byte + 1) * base^place mod prime, places counted from the end.

    Hashes of neighbouring chunks combine: h(ab) = h(a) * base^len(b) + h(b).
    """

    def __init__(self, prime: int, base: int, chunk: int):
        self.prime, self.base, self.size = prime, base % prime, chunk
        powers = [1]
        for _ in range(chunk - 1):
            powers.append(powers[-1] * self.base % prime)
        self.powers = np.array(powers[::-1], np.int64)
        self.step = pow(self.base, chunk, prime)

    def chunk(self, x: np.ndarray) -> int:
        """Hash of at most one chunk of bytes; the sum stays below 2^63 for chunks up to 2^23 bytes."""
        return int((x.astype(np.int64) + 1) @ self.powers[self.size - len(x) :]) % self.prime

    def shifted(self, h: int, after: int) -> int:
        """What a chunk's hash adds to the whole when ``after`` bytes follow it."""
        return h * pow(self.base, after, self.prime) % self.prime

    def whole(self, x: np.ndarray) -> int:
        out = 0
        for at in range(0, len(x), self.size):
            part = x[at : at + self.size]
            out = (out * (self.step if len(part) == self.size else pow(self.base, len(part), self.prime)) + self.chunk(part)) % self.prime
        return out


def _bytes(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer() or b"", np.uint8)


def fingerprints(docs: DataFrame, chunk_bytes: int, huge_bytes: int, primes: tuple, with_text: bool) -> DataFrame:
    """(doc_id, n_bytes, p, q) and the text, if asked for, of each row of ``docs`` (doc_id, text not null).

    A text of up to ``huge_bytes`` is hashed where it lies. Longer ones are
    cut into chunks that are dealt over all tasks, hashed there, shifted by
    the number of bytes after them and summed per document.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    chosen = ["doc_id", "text"] if with_text else ["doc_id"]

    def small(batches):
        sums = [Polynomial(p, b, chunk_bytes) for p, b in zip(primes, BASES)]
        for b in batches:
            xs = [_bytes(t) for t in b["text"]]
            out = [pa.array([s.whole(x) for x in xs], pa.int64()) for s in sums]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in chosen), b["n_bytes"], *out], [*chosen, *KEY])

    def pieces(batches):
        sums = [Polynomial(p, b, chunk_bytes) for p, b in zip(primes, BASES)]
        for b in batches:
            after = [max(n - (at + 1) * chunk_bytes, 0) for n, at in zip(b["n_bytes"].to_pylist(), b["at"].to_pylist())]
            xs = [_bytes(x) for x in b["piece"]]
            out = [pa.array([s.shifted(s.chunk(x), n) for x, n in zip(xs, after)], pa.int64()) for s in sums]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in named), *out], [*named, "p", "q"])

    named = ["doc_id", "a", "b", "n_bytes", "at"]
    text = ", text string" if with_text else ""
    near = d.where(F.col("n_bytes") <= huge_bytes).select("doc_id", "text", "n_bytes").mapInArrow(small, f"doc_id {kind}{text}, n_bytes long, p long, q long")
    far = d.where(F.col("n_bytes") > huge_bytes).withColumns({"a": F.xxhash64("text"), "b": F.xxhash64(F.lit(1), "text")})
    cut = let(F.col("text").cast("binary"), lambda raw: F.transform(_places(chunk_bytes), lambda i: F.struct(i.alias("at"), F.substr(raw, i * chunk_bytes + 1, F.lit(chunk_bytes)).alias("piece"))))
    sums = far.select("doc_id", "a", "b", "n_bytes", F.inline(cut)).repartition("doc_id", "a", "b", "at").mapInArrow(pieces, f"doc_id {kind}, a long, b long, n_bytes long, at int, p long, q long")
    once = sums.groupBy(*named).agg(F.min("p").alias("p"), F.min("q").alias("q"))  # repeated rows give their chunks again
    whole = once.groupBy("doc_id", "a", "b", "n_bytes").agg((F.sum("p") % primes[0]).alias("p"), (F.sum("q") % primes[1]).alias("q"))
    joined = far.alias("f").join(whole.alias("w"), F.expr("f.doc_id <=> w.doc_id AND f.a = w.a AND f.b = w.b AND f.n_bytes = w.n_bytes"))
    return near.unionByName(joined.select(*(F.col(f"f.{c}") for c in [*chosen, "n_bytes"]), "w.p", "w.q"))


def _places(chunk_bytes: int) -> Column:
    """Numbers of the chunks of a text of n_bytes bytes (an empty one has one empty chunk)."""
    return F.sequence(F.lit(0), F.floor(F.greatest(F.col("n_bytes") - 1, F.lit(0)) / chunk_bytes).cast("int"))


def _same(chunk_bytes: int) -> Column:
    """Whether ``text`` and ``other``, of n_bytes bytes each, agree in chunk after chunk; stops at the first that differs."""
    piece = lambda x, i: F.substr(x, i * chunk_bytes + 1, F.lit(chunk_bytes))
    both = F.struct(F.col("text").cast("binary").alias("x"), F.col("other").cast("binary").alias("y"))
    return let(both, lambda s: F.forall(_places(chunk_bytes), lambda i: piece(s["x"], i) == piece(s["y"], i)))


def exact_duplicates(docs: DataFrame, chunk_bytes: int = 1 << 16, huge_bytes: int = 1 << 20, primes: tuple = PRIMES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row of ``docs`` (doc_id, text).

    Rows of equal length and fingerprints are compared chunk by chunk with the
    text of the group's largest doc_id; rows that differ from it (a collision)
    form the next round's groups, so no verdict rests on a hash. A group's
    text is one row of the join, whose other side may be split, so a text that
    a third of the rows share is no single task's work. A null text is empty;
    a null doc_id is the smallest; repeated rows count each and share their
    verdict; an empty table gives no rows. Other columns are not read.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    groups = fingerprints(d, chunk_bytes, huge_bytes, primes, False).groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("top")).where("n > 1")
    marked = fingerprints(d, chunk_bytes, huge_bytes, primes, True).join(groups, KEY, "left")
    # one pass over the texts: only those of a group are kept for the comparison
    rows = stored(marked.select("doc_id", *KEY, F.sha2("text", 256).alias("sha"), "n", "top", F.when(F.col("n").isNotNull(), F.col("text")).alias("text")), "exact")
    out = rows.where("n IS NULL").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    rest = rows.where("n IS NOT NULL")
    while not rest.isEmpty():
        other = rest.where("doc_id <=> top").groupBy(*KEY).agg(F.max("text").alias("other"))
        told = rest.join(other, KEY).withColumn("same", _same(chunk_bytes))
        told = stored(told.select("doc_id", *KEY, "sha", "n", "top", "same", F.when(~F.col("same"), F.col("text")).alias("text")), "exact")
        equal, rest = told.where("same"), told.where("NOT same").drop("n", "top")
        if not rest.isEmpty():
            again = rest.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
            rest = rest.join(again, KEY)
            equal = equal.join(again.select(*KEY, F.col("n").alias("off")), KEY, "left").withColumn("n", F.col("n") - F.coalesce("off", F.lit(0)))
        out = out.unionByName(equal.select("doc_id", F.col("top").alias("keep_id"), F.col("n").alias("group_size"), "sha"))
    return out.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.col("sha").alias("text_sha256"))


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))
