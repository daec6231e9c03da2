"""Product codes against an exhaustive search in plain Python."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from creamery.llm import codebooks


@pytest.mark.parametrize("width, top", [(1, 3), (2, 4), (4, 40), (4, 100_000), (5, 2)])
def test_nearest_is_exhaustive(width, top):
    rng = np.random.default_rng(width * top)
    for k in (1, 2, 7, 64):
        entries, parts = rng.integers(-top, top, (k, width)), rng.integers(-top, top, (300, width))
        d = ((parts[:, None] - entries) ** 2).sum(axis=2)
        pick, best = codebooks.nearest(parts, entries)
        assert (best == d.min(axis=1)).all() and (pick == d.argmin(axis=1)).all()


def brute(rows, parts=16, entries=64, rounds=2):
    """vec_id -> (code, error, label_error), and the digest."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    length = min(Counter(len(v) for _, v, _ in kept).items(), key=lambda c: (-c[1], c[0]))[0]
    kept = sorted((r for r in kept if len(r[1]) == length), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = length // parts
    cut = [[tuple(v[p * w : p * w + w]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by = Counter()
    for (_, _, lab), e in zip(kept, errors):
        by[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), e, by[r[2]], digest) for r, f, e in zip(kept, found, errors)), key=repr)


def test_op12_query(spark, tmp_path):
    rng = np.random.default_rng(12)
    vec = lambda n=32: [float(np.float32(x)) for x in rng.normal(0, 0.2, n)]
    data = [(i, vec(), [None, 0, 1][i % 3]) for i in range(200)]
    data += [(500, None, 0), (501, [], 0), (502, [float("nan")] * 32, 0), (503, [float("inf")] + [0.0] * 31, 1), (504, [None] * 32, 1)]
    data += [(505, vec(16), 0), (506, vec(33), 0), (3, data[3][1], 0), (3, vec(), 1), (None, vec(), 1), (507, [0.0] * 32, None), (508, [1000.0] * 32, 2)]
    df = spark.createDataFrame([(*r, 1, "x") for r in data], "vec_id long, embedding array<float>, label int, code int, part string")
    df.repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = codebooks.op12_codebooks(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(data)


def test_few_vectors_empty_tables_and_huge_components(spark):
    schema = "vec_id long, embedding array<double>, label string"
    few = [(1, [0.5] * 16, "a"), (2, [1e300] * 16, "a"), (3, [-1e300] * 16, None)]
    codes, books = codebooks.code_vectors(spark.createDataFrame(few, schema))
    assert books.shape == (16, 3, 1)
    assert {r["vec_id"]: (r["code"], r["error"]) for r in codes.collect()} == {1: ("00" * 16, 0), 2: ("01" * 16, 0), 3: ("02" * 16, 0)}
    codes, books = codebooks.code_vectors(spark.createDataFrame([], schema))
    assert codes.collect() == [] and books.size == 0
