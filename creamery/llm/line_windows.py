"""Line dedup over overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import let, table

ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
w AS (
  SELECT doc_id, i, line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c,
         lead(i) OVER d AS i2, lead(i, 2) OVER d AS i3
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS k FROM w WHERE c IS NOT NULL),
x AS (
  SELECT doc_id, unnest([i, i2, i3]) AS i FROM r WHERE k > 1),
cov AS (SELECT DISTINCT doc_id, i FROM x)
SELECT l.doc_id, count(*) AS n_lines, count(cov.i) AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE cov.i IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN cov ON l.doc_id = cov.doc_id AND l.i = cov.i
GROUP BY l.doc_id
"""


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` plus _n_lines, _n_removed and _kept (the text without repeated passages).

    Three consecutive lines that hold a word (lines without one are passed
    over and always stay) are a window. Each window that also starts earlier
    (smaller doc_id, or an earlier line) is repeated, and every line that a
    repeated window covers goes. Windows are judged on the input and compared
    by two 64-bit hashes. Windows are dealt by hash and texts by document at
    every size: Spark takes the windows to be no larger than the compressed
    texts, and the lists of lines to be a fraction of what they hold, and would
    send them whole. Rows of equal id and text are one document and are
    treated alike; a null id comes first; a null text keeps null, zero lines
    removed. Other columns pass through.
    """
    text = F.coalesce("text", F.lit(""))
    d = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    solid = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))

    def wins(s):
        return F.transform(
            F.sequence(F.lit(1), F.size(s) - 2),
            lambda k: let(
                F.slice(s, k, 3),
                lambda t: F.struct(
                    F.xxhash64(t[0]["x"], t[1]["x"], t[2]["x"]).alias("h"),
                    F.xxhash64(F.lit(1), t[0]["x"], t[1]["x"], t[2]["x"]).alias("g"),
                    t["i"].alias("at"),
                ),
            ),
        )

    windows = d.select("doc_id", "_key", F.inline(let(solid, lambda s: F.when(F.size(s) >= 3, wins(s)))))
    place = F.struct("doc_id", "_key", F.col("at")[0].alias("at"))
    first = windows.groupBy("h", "g").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    later = windows.join(first.hint("merge"), ["h", "g"]).where(place > F.col("first"))
    covered = later.groupBy("_key").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("_cov"))

    def keep(lines):
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_cov"))
        return F.concat_ws("\n", F.transform(left, lambda i: F.get(lines, i)))

    return (
        d.join(covered.hint("merge"), "_key", "left")
        .withColumn("_n_lines", F.size(F.split(text, "\n")).cast("long"))
        .withColumn("_n_removed", F.coalesce(F.size("_cov"), F.lit(0)).cast("long"))
        .withColumn("_kept", F.when(F.col("_cov").isNull(), F.col("text")).otherwise(let(F.split(text, "\n"), keep)))
        .drop("_key", "_cov")
    )


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("_kept", F.lit("")), 256).alias("kept_sha256"),
    )
