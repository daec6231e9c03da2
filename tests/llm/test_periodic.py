"""Runs against a search over all periods in plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from creamery.llm import periodic
from creamery.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(ws, min_length=24, min_exponent=3):
    found, n = {}, len(ws)
    for q in range(1, n // min_exponent + 1):
        same = np.array([ws[i] == ws[i + q] for i in range(n - q)], dtype=np.int8)
        edge = np.flatnonzero(np.diff(np.r_[0, same, 0]))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e + q - s >= max(min_length, min_exponent * q):
                found.setdefault((s, e + q - s), q)  # a smaller period comes first
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("min_length, min_exponent", [(24, 3), (6, 3), (4, 2), (1, 2), (12, 4)])
def test_runs(min_length, min_exponent):
    rng = np.random.default_rng(min_length)
    texts = [list(map(str, rng.integers(0, k, n))) for k in (1, 2, 3, 50) for n in (0, 1, 7, 60, 200)]
    fib = ["a", "ab"]
    for _ in range(9):
        fib.append(fib[-1] + fib[-2])
    texts += [list(fib[-1]), list("ab" * 40 + "a" * 30 + "abc" * 30 + "ab" * 30), list(("abcde" * 7 + "x") * 6), list("ab" * 20 + "abc" + "ab" * 20)]
    for _ in range(30):
        unit = list(map(str, rng.integers(0, 3, rng.integers(1, 30))))
        texts.append(list(map(str, rng.integers(0, 3, rng.integers(0, 20)))) + unit * int(rng.integers(2, 9)) + unit[: len(unit) // 2] + ["end"])
    some = 0
    for ws in texts:
        want = brute(ws, min_length, min_exponent)
        some += len(want)
        assert periodic.find_runs(ws, min_length, min_exponent) == want
    assert some > 20


def test_access_gives_last_ends():
    ids = np.random.default_rng(4).integers(0, 2, 80).tolist()
    length, link, prefix = periodic.suffix_automaton(ids)
    paths = periodic.LinkCutPaths(length, link)
    for end, state in enumerate(prefix):
        got = dict(paths.access(state, end))
        for n in range(1, end + 1):
            word = ids[end - n + 1 : end + 1]
            last = max((e for e in range(n - 1, end) if ids[e - n + 1 : e + 1] == word), default=None)
            if last is not None:
                assert got[last] >= n


def plant(doc_id, ws):
    h, n = zlib.crc32(str(doc_id).encode()), len(ws)
    if doc_id is None or h % 10 or not n:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def want(doc_id, text):
    ws = plant(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute(ws)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


def test_op11_query_on_awkward_rows(spark, tmp_path):
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(map(str, rng.integers(0, 400, 300)))) for i in planted]
    rows += [(i, " ".join(f"w{k % (i + 1)}" for k in range(90))) for i in range(0, 40)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (None, "a " * 50), (503, "x  y\nx y " * 9), (503, "x  y\nx y " * 9), (planted[0], None), (planted[1], ""), (planted[2], "one")]
    rows += [(600, "la " * 5000), (601, " ".join(f"v{k % 3000}" for k in range(9500)))]
    spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, runs int, top string").write.parquet(str(tmp_path / "documents.parquet"))
    got = periodic.op11_periodic(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((want(*r) for r in rows), key=repr)


def test_op11_query_on_the_test_table_and_an_empty_one(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    got = periodic.op11_periodic(spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((want(*r) for r in docs.collect()), key=repr)
    assert sum(r["n_runs"] for r in got) > 0
    assert periodic.collapse_runs(docs.limit(0)).collect() == []
