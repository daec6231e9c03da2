"""Helpers that several operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.session import scratch_dir

#: Fixed value of the contracts: a word is a run without ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of ``text`` as an array (null text: empty)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def held_out(doc_id: Column) -> Column:
    """The contracts' test fold; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
