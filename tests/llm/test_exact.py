"""Exact dedup against brute force, collisions and huge texts included."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from creamery.llm import exact
from creamery.llm.common import table

TEXTS = [None, "", "", "a", "a", "b", "ab", "ba", "aé", "\x00", "\x00\x00", " a", "A", "x" * 1000, "x" * 1000, "x" * 999 + "y", "long text " * 500, "long text " * 500]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "a"), (3, "z"), (None, "a"), (None, "null id"), (None, "null id"), (40, "x" * 1000), (40, "x" * 999 + "y")]


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for d, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((d, keep, len(g), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk, huge, primes", [(1 << 16, 1 << 20, exact.PRIMES), (7, 20, exact.PRIMES), (7, 20, (3, 5)), (64, 1 << 20, (2, 2))])
def test_exact_duplicates(spark, chunk, huge, primes):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id long, text string, top string, n int")
    got = exact.exact_duplicates(df, chunk, huge, primes).collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)


def test_empty_and_whole_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_duplicates(df).collect() == []
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, exact.op13_exact(spark, "/root/testdata/sf0.001").collect()), key=repr) == brute(rows)


def test_chunk_hashes_combine():
    rng = np.random.default_rng(1)
    poly = exact.Polynomial(exact.PRIMES[0], exact.BASES[0], 16)
    for n in (0, 1, 15, 16, 17, 64, 1000):
        x = rng.integers(0, 256, n).astype(np.uint8)
        want = sum((int(b) + 1) * pow(poly.base, n - 1 - i, poly.prime) for i, b in enumerate(x)) % poly.prime
        parts = sum(poly.shifted(poly.chunk(x[at : at + 16]), max(n - at - 16, 0)) for at in range(0, n, 16)) % poly.prime
        assert poly.whole(x) == want == parts
