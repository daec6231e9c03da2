"""Periodic run detection: suffix automaton with link-cut access."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import WORD, let, table, words

_MIX = np.uint64(0x9E3779B97F4A7C15)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, top struct<start:long,length:long,period:long>, collapsed string"


def suffix_automaton(ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length of each state's longest string, suffix links, state of each prefix)."""
    moves, link, length, prefix = [{}], [-1], [0], []
    last = 0
    for c in ids:
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(moves)
                moves.append(moves[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
        prefix.append(cur)
        last = cur
    return length, link, prefix


class LinkCutPaths:
    """The suffix-link tree as paths of states that ended last at the same place.

    Each path is a splay tree by depth and has one colour, the last end, kept
    at its root. ``access`` makes the path from the tree's root to a state one
    path; every path it cuts through gives one segment.
    """

    def __init__(self, length: list[int], link: list[int]):
        n = len(length)
        self.length, self.parent = length, link[:]
        self.left, self.right, self.colour = [-1] * n, [-1] * n, [-1] * n

    def _rotate(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        p = parent[x]
        g = parent[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner >= 0:
            parent[inner] = p
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        parent[x], parent[p] = g, x
        self.colour[x] = self.colour[p]  # the last rotation takes it from the root

    def _splay(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        while True:
            p = parent[x]
            if p < 0 or left[p] != x and right[p] != x:
                return
            g = parent[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """(previous end, length of the longest string that ended there) of each segment; recolours the path."""
        found, below, x = [], -1, state
        while x >= 0:
            self._splay(x)
            c, deeper = self.colour[x], self.right[x]
            if c >= 0 and self.length[x]:
                found.append((c, self.length[x]))
            if deeper >= 0:
                self.colour[deeper] = c
            self.right[x] = below
            below, x = x, self.parent[x]
        self._splay(state)
        self.colour[state] = end
        return found


def runs_of(ids: list[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``ids``.

    When the word at ``end`` is appended, a suffix of length n whose last end
    was q words ago makes the last n + q words a stretch of period q. If n is
    (min_exponent - 1) * q or more, q is the smallest period, and the stretch
    cannot grow to the left; the next words extend it to the right.
    """
    length, link, prefix = suffix_automaton(ids)
    paths, ends = LinkCutPaths(length, link), {}
    for end, state in enumerate(prefix):
        for before, n in paths.access(state, end):
            q = end - before
            if n >= (min_exponent - 1) * q:
                ends[end - n - q + 1, q] = end
    return [(s, e - s + 1, q) for (s, q), e in ends.items() if e - s + 1 >= max(min_length, min_exponent * q)]


def stretches(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """(start, end) of the parts of ``ids`` outside of which no run can have a word.

    Let w = min_length * (1 - 2 / min_exponent). In a run, every window of w
    words stands again one period before or after, within the run. So a run
    lies where all such windows stand at least twice in the document. Hash
    collisions only make a part longer.
    """
    w = min_length * (min_exponent - 2) // min_exponent
    if len(ids) < min_length:
        return []
    if w < 1:
        return [(0, len(ids))]
    n = len(ids) - w + 1
    h, x = np.zeros(n, np.uint64), ids.astype(np.uint64) * _MIX
    for j in range(w):
        h = (h ^ (h >> np.uint64(29))) * _MIX + x[j : j + n]
    _, at, count = np.unique(h, return_inverse=True, return_counts=True)
    edge = np.flatnonzero(np.diff(np.r_[0, (count[at] > 1).astype(np.int8), 0]))
    return [(int(s), int(e) + w - 1) for s, e in zip(edge[::2], edge[1::2]) if e + w - 1 - s >= min_length]


def find_runs(ws: list[str], min_length: int = 24, min_exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``ws``, by start, then period.

    A run is a stretch with smallest period ``period`` that no neighbouring
    word extends, of at least ``min_length`` words and ``min_exponent`` (2 or
    more) periods.
    """
    if len(ws) < min_length:
        return []
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int64, len(ws))
    return sorted((s + at, n, q) for s, e in stretches(ids, min_length, min_exponent) for at, n, q in runs_of(ids[s:e].tolist(), min_length, min_exponent))


def collapse_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """(doc_id, n_words, runs, top, collapsed) of each row of ``docs`` (doc_id, text).

    ``runs`` holds all runs by start, then period (see ``find_runs``); ``top``
    is the one of greatest length / period (ties: smallest start, then
    period), null without any; ``collapsed`` joins by one space the words that
    no run holds after its first period. Words are compared as they are. Null
    and empty texts have no words and an empty ``collapsed``; each of several
    equal rows gets the same result; a long text needs memory in proportion to
    the parts of it that repeat; an empty table gives no rows. Other columns
    are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def one(text: str | None):
        ws = WORD.findall(text or "")
        runs = find_runs(ws, min_length, min_exponent)
        if not runs:
            return len(ws), [], None, " ".join(ws)
        steps = np.zeros(len(ws) + 1, np.int64)
        for s, n, q in runs:
            steps[s + q] += 1
            steps[s + n] -= 1
        gone = np.cumsum(steps[:-1]) > 0
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        return len(ws), runs, top, " ".join(w for w, g in zip(ws, gone.tolist()) if not g)

    def run(batches):
        struct = lambda r: dict(zip(("start", "length", "period"), r))
        for b in batches:
            out = [one(t.as_py()) for t in b["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"], pa.array([o[0] for o in out], pa.int64()), pa.array([[struct(r) for r in o[1]] for o in out], pa.list_(_RUN)),
                    pa.array([o[2] and struct(o[2]) for o in out], _RUN), pa.array([o[3] for o in out], pa.string()),
                ],
                ["doc_id", "n_words", "runs", "top", "collapsed"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def planted(doc_id: Column, text: Column) -> Column:
    """The contract's texts: with h = crc32(doc_id) and h % 10 = 0, words from place a on repeat with period p. A null id plants nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        return let(F.struct((g % n).alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8))).alias("p")), lambda x: F.transform(ws, lambda w, i: F.when(i >= x["a"], F.get(ws, (x["a"] + (i - x["a"]) % x["p"]).cast("int"))).otherwise(w)))

    return F.when((h % 10 == 0) & (F.size(words(text)) > 0), F.array_join(let(words(text), repeat), " ")).otherwise(text)


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return collapse_runs(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
