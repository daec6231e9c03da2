"""Quality rules: cross-document line frequency (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import SPACE, let, stored, table, words


ORACLE = r"""
WITH w AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
line AS (
  SELECT doc_id, source, i, ls[i] AS x, trim(regexp_replace(lower(ls[i]), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
  FROM w, unnest(range(1, len(ls) + 1)) u(i)),
often AS (SELECT source, norm FROM line WHERE norm <> '' GROUP BY source, norm HAVING count(DISTINCT doc_id) > 50),
cut AS (
  SELECT l.doc_id, string_agg(x, chr(10) ORDER BY i) FILTER (WHERE o.norm IS NULL) AS rest, count(o.norm) AS n_gone,
         count(*) FILTER (WHERE l.norm <> '') - count(DISTINCT x) FILTER (WHERE l.norm <> '') AS n_dup_lines
  FROM line l LEFT JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.norm = o.norm GROUP BY l.doc_id),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS n FROM w, unnest(range(1, len(ws) - 6)) u(i) WHERE len(ws) >= 8),
again AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM win, unnest(range(8)) u(j) WHERE n > 1 GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         CASE WHEN text IS NULL OR n_gone = 0 THEN text ELSE coalesce(rest, '') END AS text
  FROM w JOIN cut ON w.doc_id = cut.doc_id LEFT JOIN again ON w.doc_id = again.doc_id),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND 2 * len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) >= n_words AS kept FROM judged
"""


def _repeat_words(ws: Column, width: int) -> Column:
    """Words inside ``width``-word windows that occur at least twice in the array."""

    def windows(h: Column, n: int) -> Column:
        """``h``: hashes of all runs of ``n`` words. Two runs, apart or overlapping, hash to one of up to twice the length."""
        if n == width:
            return covered(h)
        k = min(n, width - n)
        longer = F.transform(F.slice(h, 1, F.size(h) - k), lambda x, i: F.xxhash64(x, F.get(h, i + k)))
        return let(longer, lambda h: windows(h, n + k))

    def covered(h: Column) -> Column:
        # most texts repeat no window: only the others are sorted
        found = let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), ends)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(found)

    def ends(s: Column) -> Column:
        same = F.filter(
            s,
            lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
        )
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), total)

    def total(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(width)), F.lit(width)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) > width, let(hashes, lambda h: windows(h, 1))).otherwise(F.lit(0).cast("long"))


def base_metrics(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, text) plus the word and line figures of each whole text.

    Null and empty texts count zero everywhere. Equality of windows inside one
    text is decided by 64-bit hashes.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.withColumn("_ws", words(F.col("text")))
        .withColumn("n_words", F.size("_ws").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_ws", "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("n_dup_lines", let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .withColumn("n_repeat_words", _repeat_words(F.col("_ws"), 8))
        .withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
        .drop("_ws")
    )


def _normal(line: Column) -> Column:
    """Lower-cased, white space collapsed: what makes two lines the same."""
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def strip_lines(docs: DataFrame, max_docs: int = 50) -> DataFrame:
    """``docs`` (doc_id, source, text, others) with doc_key, and ``text`` without the lines above the limit.

    A line (lower-cased, white space collapsed) that more than ``max_docs``
    distinct documents of one host (``source``, null is a host) carry goes
    wherever it stands in them. Rows of equal id, host and text are one
    document and count once. Lines without a word stay; a null text stays null.
    """
    d = docs.withColumn("doc_key", doc_key())
    norm = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), _normal)
    hashes = F.transform(F.array_distinct(F.filter(norm, lambda x: x != "")), lambda x: F.xxhash64(x))
    lines = d.select("doc_key", "source", F.explode(hashes).alias("h"))
    # rows bound documents from above: only lines in enough rows are counted by document
    rows = lines.groupBy("source", "h").agg(F.count("*").alias("c")).where(F.col("c") > max_docs)
    same = F.expr("l.source <=> o.source AND l.h = o.h")
    hit = stored(lines.alias("l").join(rows.alias("o"), same, "left_semi").distinct(), "lines")
    often = hit.groupBy("source", "h").agg(F.count("*").alias("c")).where(F.col("c") > max_docs)
    gone = hit.alias("l").join(often.alias("o"), same, "left_semi").groupBy("doc_key").agg(F.collect_set("h").alias("_gone"))
    left = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_gone", F.xxhash64(_normal(x))))
    text = F.when(F.col("_gone").isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    # dealt by document at every size: sent whole, the list of gone lines would grow with the corpus
    return d.join(gone.hint("merge"), "doc_key", "left").withColumn("text", text).drop("_gone")


def doc_key() -> Column:
    return F.xxhash64("doc_id", "source", "text").alias("doc_key")


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each whole text, the text without the lines above the limit, and whether enough of it is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = strip_lines(base_metrics(docs))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (2 * F.size(words(F.col("text"))) >= F.col("n_words"))).alias("kept"), "text",
    )
