"""SimHash near-dedup by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import WORD, stored, table
from creamery.llm.components import connected_components

_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the shingles' XXH64 (seed 42); 0 for a text without words."""
    ws = WORD.findall((text or "").translate(_AZ))
    if not ws:
        return 0
    n = max(1, len(ws) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 8192):  # bounded memory for very long texts
        hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + shingle]), 42) for i in range(at, min(n, at + 8192))]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """fp, the signed 64-bit fingerprint of each whole text, beside the other columns of ``docs``."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b["text"]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b[c] for c in others), pa.array(fp)], [*others, "fp"])

    return docs.mapInArrow(run, docs.select(*others, F.lit(0).cast("long").alias("fp")).schema)


def _field(lo: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << width) - 1))


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints at one or two differing bits.

    The fingerprint has two 32-bit segments. Two differing bits leave three
    cases, each looked up exactly: one segment equal, and then one of three
    fields of the other equal too; or one bit differs in each segment, found
    by flipping each set bit of the left segment (one of the two partners has
    it set) beside an equal half of the right one. Keys hold 42 bits or more,
    so tables stay thin, and every match is checked on all 64 bits. Both
    lookups are dealt by key at every size: Spark takes a table after an
    explode to be as small as before it, and would send it whole.
    """
    left, right = _field(32, 32), _field(0, 32)
    same = [(f"r{i}", right, 32 + lo, w) for i, (lo, w) in enumerate([(0, 11), (11, 11), (22, 10)])]
    same += [(f"l{i}", left, lo, w) for i, (lo, w) in enumerate([(0, 11), (11, 11), (22, 10)])]
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.shiftleft(seg, 11).bitwiseOR(_field(lo, w)).alias("k")) for t, seg, lo, w in same])
    tab = fps.select("fp", F.inline(keys))
    eq = tab.alias("x").join(tab.alias("y").hint("merge"), F.expr("x.t = y.t AND x.k = y.k AND x.fp < y.fp"))
    near = F.array(*[F.struct(F.lit(i).alias("t"), F.shiftleft(left, 16).bitwiseOR(_field(16 * i, 16)).alias("k")) for i in (0, 1)])
    home = fps.select("fp", F.inline(near))
    probe = home.withColumn("bit", F.explode(F.sequence(F.lit(16), F.lit(47)))).withColumn("flip", F.expr("shiftleft(1L, bit)"))
    probe = probe.where(F.col("k").bitwiseAND(F.col("flip")) != 0).withColumn("k", F.col("k").bitwiseXOR(F.col("flip")))
    ball = probe.alias("x").join(home.alias("y").hint("merge"), F.expr("x.t = y.t AND x.k = y.k"))
    pairs = eq.select("x.fp", F.col("y.fp").alias("fp2")).unionByName(ball.select("x.fp", F.col("y.fp").alias("fp2")))
    pairs = pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= 2)
    return pairs.select(F.least("fp", "fp2").alias("a"), F.greatest("fp", "fp2").alias("b")).distinct()


def _rooted(reps: DataFrame) -> DataFrame:
    """``reps`` (one row per fp) plus root, the same for all fingerprints of a component."""
    roots = connected_components(links(reps.select("fp"))).withColumnRenamed("id", "fp")
    # dealt by fingerprint: the size of the roots' files says little of their rows in memory
    return reps.join(roots.hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text).

    Fingerprints link at two or fewer differing bits; component_id is the
    smallest doc_id reachable. Equal fingerprints collapse before the search.
    Null and wordless texts share fingerprint 0; a null doc_id never names a
    component unless no other id is in it.
    """
    fps = stored(fingerprints(docs.select("doc_id", "text"), shingle), "simhash")
    grouped = _rooted(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    best = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    return fps.join(grouped.join(best, "root").select("fp", "component_id").hint("merge"), "fp")


def one_per_component(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row of ``docs`` (doc_id, text, others) per near-duplicate component.

    The first row by doc_id (null last), text hash and hash of all columns
    stays, so neither a missing nor a repeated id decides which texts are
    copies. Rows equal in every column are one row; equality is decided by
    doc_id and two 64-bit hashes.
    """
    names = docs.columns
    whole = F.xxhash64(*[x for c in names for x in (F.col(c), F.col(c).isNull())])  # the hash skips nulls
    d = docs.withColumns({"_text": F.xxhash64("text"), "_all": whole})
    fps = stored(fingerprints(d.select("doc_id", "text", "_text", "_all"), shingle), "simhash")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text", "_all")
    best = _rooted(fps.groupBy("fp").agg(F.min(place).alias("first"))).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    kept = d.alias("d").join(best.alias("b"), F.expr("d.doc_id <=> b.doc_id AND d._text = b._text AND d._all = b._all"), "left_semi")
    return kept.dropDuplicates(["doc_id", "_text", "_all"]).select(names)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
