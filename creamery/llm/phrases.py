"""Substring dedup: repeated-phrase automata."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import stored, table
from creamery.session import scratch_dir

_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = -(1 << 63)
#: Words of one shard at most, so that each distinct word can be a letter (code points end at 0x110000).
SHARD_WORDS = 1_000_000

ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS phrase FROM w, unnest(range(1, len(ws) - 18)) u(i) WHERE len(ws) >= 20),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, unnest(range(20)) u(j)),
word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
kept AS (
  SELECT word.doc_id, count(gone.i) AS n_removed, string_agg(x, ' ' ORDER BY word.i) FILTER (WHERE gone.i IS NULL) AS kept
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class _Letters(dict):
    def __missing__(self, word):
        # code points from 1, past the surrogates
        c = self[word] = chr(1 + len(self) + (2048 if len(self) >= 0xD7FF else 0))
        return c


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive entries (doubling, then joining powers of two)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, piece, step, factor = None, 0, h, 1, _MIX
    with np.errstate(over="ignore"):
        while True:
            if width & step:
                out = piece[:n] if out is None else out * factor + piece[done : done + n]
                done += step
            if done == width:
                return _mix(out)
            piece = piece[:-step] * factor + piece[step:]
            factor, step = factor * factor, step * 2


def anchors(h: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hashes by place, and for each window the place of its smallest anchor."""
    a = rolling(h, anchor)
    n = len(h) - window + 1
    if n <= 0:
        return a, np.empty(0, np.int64)
    # smallest of 2, 4, 8 ... neighbours, then of two such spans that cover the window; ties go to the left
    low, at, span, width = a, np.arange(len(a)), window - anchor + 1, 1
    while width < span:
        step = min(width, span - width)
        less = low[step:] < low[:-step]
        low, at = np.where(less, low[step:], low[:-step]), np.where(less, at[step:], at[:-step])
        width += step
    return a, at


def _words(text: pa.Scalar) -> list[bytes]:
    """The words of a text in UTF-8: bytes are split at ASCII white space only."""
    return text.as_buffer().to_pybytes().split()


def _word_hashes(words: list[bytes], known: _Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _id(a: str, b: str, text: str) -> list:
    return [F.xxhash64(text).alias(a), F.xxhash64(F.lit(1), text).alias(b)]


def distinct_texts(docs: DataFrame, table_name: str) -> DataFrame:
    """(a, b, low, text) of each distinct text of ``docs`` (key, text): two hashes and the smallest key that has it.

    Copies collapse before they are shuffled. Stored as a table bucketed by
    (a, b), so that what later steps find out about a text is joined to it
    without moving the text again.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("key", "text", *_id("a", "b", "text")).groupBy("a", "b").agg(F.min("key").alias("low"), F.any_value("text").alias("text"))
    texts.write.bucketBy(n, "a", "b").option("path", scratch_dir(spark, "texts")).saveAsTable(table_name)
    return spark.table(table_name)


def _anchor_rows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """(h, low, n): the anchors of each text, and how often each stands in it."""

    def run(batches):
        known = _Hashes()
        for b in batches:
            hs, lows, ns = [], [], []
            for low, text in zip(b["low"].to_pylist(), b["text"]):
                ws = _words(text)
                if len(ws) >= window:
                    a, at = anchors(_word_hashes(ws, known), window, anchor)
                    h, n = np.unique(a[np.unique(at)], return_counts=True)
                    hs.append(h)
                    ns.append(n)
                    lows.append(np.full(len(h), low, np.int64))
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(lows)), pa.array(np.concatenate(ns).astype(np.int32))], ["h", "low", "n"])

    return texts.select("low", "text").mapInArrow(run, "h long, low long, n int")


def _segment_rows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """(a, b, low, start, h, seg): the words under the windows of each recurring anchor (column hs) of each text."""

    def run(batches):
        known = _Hashes()
        for b in batches:
            out = [[], [], [], [], [], []]
            for x, y, low, text, hs in zip(b["a"].to_pylist(), b["b"].to_pylist(), b["low"].to_pylist(), b["text"], b["hs"]):
                ws = _words(text)
                if len(ws) < window:
                    continue
                a, at = anchors(_word_hashes(ws, known), window, anchor)
                wanted = hs.values.to_numpy().view(np.uint64)
                first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])  # windows of one anchor lie side by side
                last = np.r_[first[1:], len(at)] - 1
                use = np.flatnonzero(np.isin(a[at[first]], wanted))
                keys = a[at[first[use]]].view(np.int64).tolist()
                for i, j, h in zip(first[use].tolist(), last[use].tolist(), keys):
                    for column, value in zip(out, (x, y, low, i, h, b" ".join(ws[i : j + window]))):
                        column.append(value)
            if out[0]:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["a", "b", "low", "start", "h", "seg"])

    return texts.select("a", "b", "low", "text", "hs").mapInArrow(run, "a long, b long, low long, start int, h long, seg string")


def _single_windows(segments: DataFrame, window: int) -> DataFrame:
    """Each window of ``segments`` as a segment of its own, known by the hash of its words."""
    ws = F.split("seg", " ")
    each = F.transform(F.sequence(F.lit(1), F.size(ws) - (window - 1)), lambda i: F.struct((i - 1).alias("at"), F.array_join(F.slice(ws, i, window), " ").alias("seg")))
    out = segments.select("a", "b", "low", "start", F.inline(each))
    return out.select("a", "b", "low", (F.col("start") + F.col("at")).alias("start"), F.xxhash64("seg").alias("h"), "seg")


def located(shard: list[tuple], window: int) -> Iterator[tuple]:
    """(segment's place in ``shard``, first window, windows, first document, its first window) of each recurring phrase.

    ``shard`` holds (words, document, start, times) of segments, with the
    first place each stands at. Windows that stand twice or more are
    confirmed by their words and compiled into one automaton, which all
    segments then stream through; windows side by side that come from the
    same place in the same order make one phrase.
    """
    import ahocorasick

    letters, lines, seen = _Letters(), [], {}
    for text, doc, start, times in shard:
        line = "".join(map(letters.__getitem__, text.split(" ")))
        lines.append(line)
        for j in range(len(line) - window + 1):
            w = line[j : j + window]
            had = seen.get(w)
            if had is None:
                seen[w] = (times, (doc, start + j))
            else:
                seen[w] = (had[0] + times, min(had[1], (doc, start + j)))
    machine = ahocorasick.Automaton()
    for w, (times, place) in seen.items():
        if times > 1:
            machine.add_word(w, place)
    if not len(machine):
        return
    machine.make_automaton()
    for k, line in enumerate(lines):
        run = None
        for end, (doc, start) in machine.iter(line):
            j = end - window + 1
            if run and run[1] + run[2] == j and run[3] == doc and run[4] + run[2] == start:
                run[2] += 1
                continue
            if run:
                yield tuple(run)
            run = [k, j, 1, doc, start]
        if run:
            yield tuple(run)


def _phrases(segments: DataFrame, window: int, anchor: int, shard_words: int) -> DataFrame:
    """(p, q, j, m, doc, at): in the segment of hashes (p, q), the m windows from j on first stand in ``doc`` from ``at`` on.

    Equal segments are one row with their first place, so a passage that a
    third of the documents share is compared once. All segments of one anchor
    meet in one shard of an automaton.
    """
    grouped = segments.groupBy("h", "seg").agg(F.min(F.struct("low", "start")).alias("first"), F.count("*").alias("times"))
    longest = 2 * window - anchor
    most = max(shard_words // (3 * longest), 1)

    def run(batches):
        held, key = [], None
        for b in batches:
            first = b["first"]
            for h, p, q, seg, low, start, n in zip(*(b[c].to_pylist() for c in ("h", "p", "q")), b["seg"].to_pylist(), first.field("low").to_pylist(), first.field("start").to_pylist(), b["times"].to_pylist()):
                if len(held) >= most and h != key:
                    yield told(held)
                    held = []
                held.append((p, q, (seg, low, start, n)))
                key = h
        if held:
            yield told(held)

    def told(held):
        rows = [(*held[k][:2], *x) for k, *x in located([r[2] for r in held], window)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["p", "q", "j", "m", "doc", "at"])

    dealt = grouped.select("h", "seg", "first", "times", *_id("p", "q", "seg")).repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "p long, q long, j int, m int, doc long, at int")


def repeated_spans(texts: DataFrame, window: int, anchor: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(a, b, spans): the stretches [s, e) of each text's words under a window that starts earlier elsewhere.

    A window's anchor is the smallest hash among the ``anchor``-word runs in
    it, so equal windows have equal anchors and only windows over a recurring
    anchor can recur. The words under the windows of one such anchor are a
    segment. An anchor with more distinct segments than a shard holds has its
    windows dealt out one by one, by their own words.
    """
    found = stored(_anchor_rows(texts, window, anchor), "anchors")
    recurring = found.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    per_key = found.select("h", "low").join(recurring, "h").groupBy("low").agg(F.collect_set("h").alias("hs"))
    # a key may have several texts: each then looks for the anchors of all of them
    ids = texts.select("a", "b", "low").join(per_key, "low").select("a", "b", "hs")
    segments = stored(_segment_rows(texts.join(ids, ["a", "b"]), window, anchor), "segments")
    limit = 2 * max(shard_words // (3 * (2 * window - anchor)), 1)
    hot = stored(segments.groupBy("h", "seg").agg(F.count("*")).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("h"), "hot")
    if not hot.isEmpty():
        apart = _single_windows(segments.join(hot, "h", "left_semi"), window)
        segments = stored(segments.join(hot, "h", "left_anti").select(apart.columns).unionByName(apart), "segments")
    phrases = stored(_phrases(segments, window, anchor, shard_words), "phrases")
    hits = segments.select("a", "b", "low", "start", *_id("p", "q", "seg")).join(phrases, ["p", "q"])
    hits = hits.where("doc < low OR (doc = low AND at < start + j)")
    span = F.struct((F.col("start") + F.col("j")).alias("s"), (F.col("start") + F.col("j") + F.col("m") + F.lit(window - 1)).alias("e"))
    return hits.groupBy("a", "b").agg(F.collect_set(span).alias("spans"))


def _cut(texts: DataFrame) -> DataFrame:
    """(a, b, low, n_words, n_removed, kept) of each text without the words of its spans."""

    def run(batches):
        for b in batches:
            n, gone, kept = [], [], []
            for text, spans in zip(b["text"], b["spans"]):
                ws = _words(text)
                n.append(len(ws))
                if not spans.is_valid:
                    gone.append(0)
                    kept.append(b" ".join(ws))
                    continue
                steps = np.zeros(len(ws) + 1, np.int64)
                np.add.at(steps, spans.values.field("s").to_numpy(), 1)
                np.add.at(steps, spans.values.field("e").to_numpy(), -1)
                out = np.cumsum(steps[:-1]) > 0
                gone.append(int(out.sum()))
                kept.append(b" ".join([w for w, g in zip(ws, out.tolist()) if not g]))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], b["low"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["a", "b", "low", "n_words", "n_removed", "kept"])

    return texts.select("a", "b", "low", "text", "spans").mapInArrow(run, "a long, b long, low long, n_words long, n_removed long, kept string")


def dedup_phrases(docs: DataFrame, window: int = 20, anchor: int = 8, shard_words: int = SHARD_WORDS, pick: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each row of ``docs`` (doc_id, text).

    Removes each word under a ``window``-word passage that also starts earlier
    (smaller doc_id, or the same document at an earlier word); the earliest
    one stays. Passages are judged on the input, and compared word by word;
    whole texts and segments by two 64-bit hashes. Exact copies are settled
    first: a later one of ``window`` words or more loses all its words. Null
    and empty texts have no words; a null doc_id comes first; rows of one
    doc_id count as one document, so equal rows leave each other alone; a long
    text may have any number of distinct words; an empty table gives no rows;
    other columns are not read. ``pick`` may replace the kept text (column
    ``kept``) by something smaller before it is joined to the rows.
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.coalesce("doc_id", F.lit(_NONE).cast("long")))
    name = f"default.phrase_texts_{uuid.uuid4().hex}"
    texts = distinct_texts(keyed, name)
    cut = _cut(texts.join(repeated_spans(texts, window, anchor, shard_words), ["a", "b"], "left"))
    cut = stored(pick(cut) if pick else cut, "kept")
    spark.sql(f"DROP TABLE {name}")
    rows = keyed.select("doc_id", "key", *_id("a", "b", "text")).join(cut, ["a", "b"])
    copy = (F.col("key") > F.col("low")) & (F.col("n_words") >= window)
    nothing = F.lit("") if pick is None else pick(spark.range(1).select(F.lit("").alias("kept"))).select("kept").first()[0]
    return rows.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"), F.when(copy, nothing).otherwise(F.col("kept")).alias("kept"))


def op1_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda df: df.withColumn("kept", F.sha2("kept", 256))
    return dedup_phrases(table(spark, sf_dir, "documents"), pick=digest).withColumnRenamed("kept", "kept_sha256")
