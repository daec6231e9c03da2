"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm import bpe, line_windows, mixing, ppm, simhash
from creamery.llm.common import held_out, stored, table, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter go. ``lang`` becomes the predicted one."""
    known = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = ppm.train(known.where(~held_out(F.col("doc_id"))))
    out = ppm.predict(docs.select(COLUMNS), model)
    return out.where("lang_pred <> 'und'").withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line passages leave the texts; a document left without a word goes."""
    out = line_windows.dedup_lines(docs.select(COLUMNS))
    out = out.withColumn("text", F.col("_kept")).where(F.size(words(F.col("text"))) > 0)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the first by doc_id (null last), then by text hash."""
    return simhash.one_per_component(docs.select(COLUMNS)).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the source weights take it."""
    out = mixing.mix(docs.select(COLUMNS), F.size(words(F.col("text"))))
    return out.select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), F.col("_epochs"))).alias("_copy")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and the decoded text of each row."""
    return bpe.encode_digests(docs, bpe.word_bpe_path())


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_dedup", near_duplicates), ("mixing", mix), ("bpe", encode)]

#: SQL cannot express the PPM, SimHash and BPE stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
