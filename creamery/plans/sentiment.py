"""Incremental audit-note scoring: each audit is scored once.

Plan: target keys --(null-safe left anti join)--> new audits --> scorer -->
staged rows of this run --> commit. The anti join runs *before* the scorer, so
the scorer (possibly an expensive model) sees only new rows, and only the key
column of the target is read. It joins keys: the notes, which are long, move
only where new and stored audits must be told apart. The commit is short: under
the target's lock the staged rows whose audit is still not in the target are
appended. So of two
runs at the same time the later commit leaves out what the earlier one
stored, and a run that is tried again under its ``run_id`` neither asks the
model again for what it staged nor stores an audit twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.config import LakeConfig
from creamery.functions.sentiment import with_sentiment
from creamery.operators.dedup import dedup_by_key
from creamery.operators.joins import MOST_KEYS, anti_join_null_safe, semi_join_null_safe
from creamery.schemas import AUDIT_SENTIMENT_COLS, AUDIT_SENTIMENT_DDL, SENTIMENT_ERRORS_DDL
from creamery.sinks.tables import append_rows, create_table_if_missing, delete_path, file_options, path_exists, path_lock, table_location

AUDIT_COLS = ["audit_id", "batch_id", "audit_outcome", "audit_notes"]


def pending_audits(audits: DataFrame, scored: DataFrame) -> DataFrame:
    """Audits whose audit_id is not yet in ``scored`` (NULL matches NULL)."""
    return anti_join_null_safe(audits.select(*AUDIT_COLS), scored, "audit_id")


def score_audits(audits: DataFrame, scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    return with_sentiment(audits.select(*AUDIT_COLS), "audit_notes", scorer).select(*AUDIT_SENTIMENT_COLS)


def _staged(spark: SparkSession, rows: Callable[[], DataFrame], place: str) -> DataFrame:
    """The scored rows of one run, written once: a complete earlier attempt of the same run is taken as it is."""
    if not path_exists(spark, f"{place}/_SUCCESS"):
        rows().write.mode("overwrite").options(**file_options("parquet")).parquet(place)
    return spark.read.parquet(place)


def _fresh(audits: DataFrame, scored: DataFrame) -> DataFrame:
    """``pending_audits``; with audits already scored, the ids are joined first, so that few new ones move no other notes."""
    if scored.isEmpty():
        return pending_audits(audits, scored)
    ids = anti_join_null_safe(audits.select("audit_id").distinct(), scored, "audit_id")
    if ids.count() <= MOST_KEYS:
        ids = F.broadcast(ids)
    return semi_join_null_safe(audits.select(*AUDIT_COLS), ids, "audit_id")


def _append_unstored(done: DataFrame, target: str) -> None:
    """Append one row of each audit of ``done`` that ``target`` does not hold.

    Which these are is told by the ids alone: if all rows go in, they are
    copied as they lie, and if none does, nothing is read.
    """
    held, total = done.sparkSession.table(target), done.count()
    ids = anti_join_null_safe(done.groupBy("audit_id").agg(F.count("*").alias("n")), held, "audit_id")
    found = ids.agg(F.count("*").alias("ids"), F.sum("n").alias("rows")).first()
    if not found["ids"]:
        return
    if found["rows"] > found["ids"]:
        done = dedup_by_key(done, ["audit_id"])
    if found["rows"] < total:
        done = anti_join_null_safe(done, held, "audit_id")
    append_rows(done, target)


def run_sentiment(
    spark: SparkSession,
    cfg: LakeConfig,
    scorer: Callable[[Column], Column] | None = None,
    audits: DataFrame | None = None,
    target: str | None = None,
    location: str | None = None,
    run_id: str | None = None,
) -> str:
    """Create the target if missing, then append scores for audits not yet in it; returns the run's id.

    ``audits`` defaults to the silver audit fact. A run that failed can be
    repeated with its ``run_id``. Rows that the scorer reports an error for
    stay pending: they go to ``<target>_errors`` (run, audit, error) and are
    scored by the next run. An audit_id (NULL included) is stored once, also
    when ``audits`` holds it more than once.
    """
    target = target or cfg.table("gold", "d_audit_sentiment")
    if audits is None:
        audits = spark.table(cfg.table("silver", "fact_quality_audits"))
    run_id = run_id or uuid.uuid4().hex
    create_table_if_missing(spark, target, AUDIT_SENTIMENT_DDL, cfg.table_format, location)
    home = table_location(spark, target)

    def rows() -> DataFrame:
        fresh = _fresh(audits, spark.table(target))
        return with_sentiment(fresh, "audit_notes", scorer).select(*AUDIT_SENTIMENT_COLS, "scoring_error")

    place = f"{home}__runs/{run_id}"
    staged = _staged(spark, rows, place)
    failed = staged.where(F.col("scoring_error").isNotNull()).select(F.lit(run_id).alias("run_id"), "audit_id", F.col("scoring_error").alias("error"))
    if not failed.isEmpty():
        create_table_if_missing(spark, f"{target}_errors", SENTIMENT_ERRORS_DDL, cfg.table_format, f"{location}__errors" if location else None)
    with path_lock(spark, f"{home}__commit.lock", run_id):
        spark.catalog.refreshTable(target)  # another session may have appended
        done = staged.where(F.col("scoring_error").isNull()).select(*AUDIT_SENTIMENT_COLS)
        _append_unstored(done, target)
        if not failed.isEmpty():
            logged = spark.table(f"{target}_errors").where(F.col("run_id") == run_id)
            append_rows(anti_join_null_safe(failed, logged, "audit_id"), f"{target}_errors")
    delete_path(spark, place)
    return run_id
