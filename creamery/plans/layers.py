"""Layer runs: bronze -> silver -> gold -> sentiment, as plain function calls.

Each layer reads the tables the previous layer stored and stores its own, so
each stage plans against files (lineage is cut at every layer, shared inputs
such as the batch fact are scanned from storage instead of recomputed), and a
failed run can be resumed from the last stored layer.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creamery.config import LakeConfig
from creamery.operators.dedup import dedup_long_rows
from creamery.operators.quality import BRONZE_RULES, apply_expectations
from creamery.plans import consumer, gold, silver
from creamery.plans.sentiment import run_sentiment
from creamery.schemas import SENSOR_SCHEMA
from creamery.sinks.tables import append_rows, create_table_if_missing, save_table
from creamery.sources.files import CSV_SCANS, sensor_snapshot
from creamery.streaming.sensor import MicroBatch, missing_batches, run_sensor_stream

SILVER_PLAN: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "silver_dim_plants": (silver.silver_dim_plants, ["dim_plants"]),
    "silver_dim_lines": (silver.silver_dim_lines, ["dim_lines"]),
    "silver_dim_sku_catalog": (silver.silver_dim_sku_catalog, ["dim_sku_catalog"]),
    "silver_dim_retail_customers": (silver.silver_dim_retail_customers, ["dim_retail_customers"]),
    "fact_production_batches": (silver.fact_production_batches, ["historical_production_batches"]),
    "fact_shipments": (silver.fact_shipments, ["historical_shipments"]),
    "fact_quality_audits": (partial(silver.fact_quality_audits, dedup=dedup_long_rows), ["historical_quality_audit_logs"]),
    "fact_sensor_readings": (silver.fact_sensor_readings, ["sensor_readings", "sensor_readings_stream"]),
}

GOLD_PLAN: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "d_production_summary": (
        gold.d_production_summary,
        ["fact_production_batches", "silver_dim_plants", "silver_dim_lines"],
    ),
    "d_retailer_360": (gold.d_retailer_360, ["fact_shipments", "silver_dim_retail_customers"]),
    "d_quality_audit_summary": (
        gold.d_quality_audit_summary,
        ["fact_quality_audits", "fact_production_batches", "silver_dim_plants"],
    ),
    "d_sensor_health_summary": (gold.d_sensor_health_summary, ["fact_sensor_readings", "silver_dim_lines"]),
}

# Consumer results stored in gold; inputs are (layer, table).
CONSUMER_PLAN: dict[str, tuple[Callable[..., DataFrame], list[tuple[str, str]]]] = {
    "cq_plant_ranking": (
        consumer.plant_ranking, [("silver", "fact_production_batches"), ("silver", "silver_dim_plants")]
    ),
    "cq_exec_kpis": (
        consumer.exec_kpis,
        [("silver", "fact_production_batches"), ("silver", "fact_shipments"), ("gold", "d_audit_sentiment")],
    ),
    "cq_worst_lines": (consumer.worst_lines, [("gold", "d_production_summary")]),
    "cq_late_customers": (consumer.late_customers, [("gold", "d_retailer_360")]),
    "cq_health_by_source": (consumer.health_by_source, [("silver", "fact_sensor_readings")]),
    "cq_outcome_by_sentiment": (consumer.outcome_by_sentiment, [("gold", "d_audit_sentiment")]),
}

# Tables stored bucketed on a key that is unique after silver dedup (so no
# bucket can be skewed): the audit summary joins audits to batches on batch_id
# and reads the batch fact without shuffling it.
BUCKETING = {"fact_production_batches": ["batch_id"]}

STREAM_TABLE = "sensor_readings_stream"
STREAM_DDL = ", ".join(
    f"{f.name} {'TIMESTAMP' if f.name == 'event_timestamp' else f.dataType.simpleString().upper()}"
    for f in SENSOR_SCHEMA.fields
)


def run_concurrently(tasks: Iterable[Callable[[], None]], workers: int) -> None:
    """Run independent table writes as concurrent Spark jobs; re-raise the first failure."""
    tasks = list(tasks)
    if workers <= 1 or len(tasks) <= 1:
        for task in tasks:
            task()
        return
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for future in [pool.submit(task) for task in tasks]:
            future.result()


def create_databases(spark: SparkSession, cfg: LakeConfig) -> None:
    for layer in ("bronze", "silver", "gold"):
        db = cfg.database(layer)
        where = f" LOCATION '{cfg.db_root.rstrip('/')}/{db}'" if cfg.db_root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")


def drop_databases(spark: SparkSession, cfg: LakeConfig) -> None:
    """Forget the three databases. Refreshed tables are external: their files stay until their folder is cleaned."""
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {cfg.database(layer)} CASCADE")


EXPECTATIONS_LOG = "expectations_log"
EXPECTATIONS_LOG_DDL = (
    "run_ts TIMESTAMP, table_name STRING, rule_name STRING, action STRING, "
    "total_records BIGINT, failed_records BIGINT, passed_records BIGINT"
)


def log_expectations(spark: SparkSession, cfg: LakeConfig, counts: dict[str, dict[str, int]]) -> None:
    """Append this run's rule counts (by table) to ``bronze.expectations_log`` (the DQ history of the runs).

    One row per rule per run: the counts were already computed by the
    writing jobs (``observe``), so this only writes a handful of rows.
    """
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for table, metrics in counts.items():
        for rule in BRONZE_RULES.get(table, ()):
            failed = int(metrics[rule.name])
            rows.append((now, table, rule.name, rule.action, int(metrics["records"]), failed,
                         int(metrics["records"]) - failed))
    if not rows:
        return
    target = cfg.table("bronze", EXPECTATIONS_LOG)
    create_table_if_missing(spark, target, EXPECTATIONS_LOG_DDL, cfg.table_format)
    append_rows(spark.createDataFrame(rows, EXPECTATIONS_LOG_DDL), target)


def run_bronze(
    spark: SparkSession, cfg: LakeConfig, inputs: dict[str, DataFrame] | None = None
) -> dict[str, Observation]:
    """Scan raw inputs (or use ``inputs``), apply expectations, store bronze tables.

    Returns the expectation observations; ``obs.get`` holds the counts once
    the table is written (no extra pass over the data). A snapshot in which a
    field has no value at all fails the run, and its old table stays.
    """
    create_databases(spark, cfg)
    checks: dict[str, Callable[[], None]] = {}
    if inputs is None:
        inputs = {name: scan(spark, cfg) for name, scan in CSV_SCANS.items()}
        inputs["sensor_readings"], checks["sensor_readings"] = sensor_snapshot(spark, cfg, cfg.snapshot_nullable)
    observations: dict[str, Observation] = {}
    tasks = []
    for name, df in inputs.items():
        rules = BRONZE_RULES.get(name, ())
        obs = Observation(f"{name}_dq") if rules else None
        out = apply_expectations(df, rules, obs)
        tasks.append(lambda out=out, name=name: save_table(out, cfg.table("bronze", name), cfg.table_format, check=checks.get(name)))
        if obs is not None:
            observations[name] = obs
    run_concurrently(tasks, cfg.concurrent_writes)
    log_expectations(spark, cfg, {name: obs.get for name, obs in observations.items()})
    # The live table exists even before the first stream run, so silver can read it.
    create_table_if_missing(spark, cfg.table("bronze", STREAM_TABLE), STREAM_DDL, cfg.table_format)
    return observations


STREAM_LOG = "stream_expectations_log"
STREAM_LOG_DDL = (
    "run_id STRING, batch_id BIGINT, batch_ts TIMESTAMP, table_name STRING, rule_name STRING, action STRING, "
    "total_records BIGINT, failed_records BIGINT, passed_records BIGINT"
)


def log_micro_batches(spark: SparkSession, cfg: LakeConfig, run_id: str, history: list[MicroBatch]) -> list[int]:
    """Append one row per rule and micro-batch to ``bronze.stream_expectations_log``.

    Returns the numbers of micro-batches that no report came for, in this run
    or between it and the last one logged.
    """
    target = cfg.table("bronze", STREAM_LOG)
    create_table_if_missing(spark, target, STREAM_LOG_DDL, cfg.table_format)
    last = spark.table(target).where(F.col("table_name") == STREAM_TABLE).orderBy(F.desc("batch_ts"), F.desc("batch_id")).select("batch_id").first()
    rows = []
    for batch in history:
        when = dt.datetime.fromisoformat(batch.timestamp.replace("Z", "+00:00")).astimezone(dt.timezone.utc).replace(tzinfo=None)
        for rule in BRONZE_RULES[STREAM_TABLE]:
            total, failed = int(batch.counts["records"]), int(batch.counts[rule.name])
            rows.append((run_id, batch.batch_id, when, STREAM_TABLE, rule.name, rule.action, total, failed, total - failed))
    if rows:
        append_rows(spark.createDataFrame(rows, STREAM_LOG_DDL), target)
    return missing_batches(history, last["batch_id"] if last else None)


def run_stream(spark: SparkSession, cfg: LakeConfig) -> dict[str, int]:
    """Append the messages that are there to the live table; log its rules.

    ``bronze.expectations_log`` gets the sums of the run,
    ``bronze.stream_expectations_log`` the counts of each micro-batch. Returns
    the sums (rules, records, payload health; all zero without new messages).
    They are logged also when a micro-batch fails. A micro-batch whose report
    never came makes the run fail after its data and the other counts are stored.
    """
    create_databases(spark, cfg)
    counts = {"records": 0, **{rule.name: 0 for rule in BRONZE_RULES[STREAM_TABLE]}}
    history: list[MicroBatch] = []
    if cfg.stream_dedup:
        create_table_if_missing(spark, cfg.table("bronze", STREAM_TABLE), STREAM_DDL, cfg.table_format)
    try:
        run_sensor_stream(spark, cfg, cfg.table("bronze", STREAM_TABLE), counts=counts, history=history)
    finally:
        log_expectations(spark, cfg, {STREAM_TABLE: counts})
        missing = log_micro_batches(spark, cfg, uuid.uuid4().hex, history)
    if missing:
        raise RuntimeError(f"no rule counts of micro-batches {missing[:10]} ({len(missing)} in all) of {STREAM_TABLE}")
    return counts


def _run_layer(spark: SparkSession, cfg: LakeConfig, plan: dict, src_layer: str, dst_layer: str) -> None:
    create_databases(spark, cfg)

    def write(name, fn, inputs):
        frames = [spark.table(cfg.table(src_layer, i)) for i in inputs]
        save_table(
            fn(*frames), cfg.table(dst_layer, name), cfg.table_format,
            bucket_by=BUCKETING.get(name), buckets=cfg.bucket_count,
        )

    run_concurrently(
        [lambda n=name, f=fn, i=inputs: write(n, f, i) for name, (fn, inputs) in plan.items()],
        cfg.concurrent_writes,
    )


def run_silver(spark: SparkSession, cfg: LakeConfig) -> None:
    _run_layer(spark, cfg, SILVER_PLAN, "bronze", "silver")


def run_gold(spark: SparkSession, cfg: LakeConfig) -> None:
    _run_layer(spark, cfg, GOLD_PLAN, "silver", "gold")


def run_consumer(spark: SparkSession, cfg: LakeConfig) -> None:
    """Dashboard tables in gold, computed from the stored silver and gold tables."""

    def write(name, fn, inputs):
        frames = [spark.table(cfg.table(layer, t)) for layer, t in inputs]
        save_table(fn(*frames), cfg.table("gold", name), cfg.table_format)

    run_concurrently(
        [lambda n=name, f=fn, i=inputs: write(n, f, i) for name, (fn, inputs) in CONSUMER_PLAN.items()],
        cfg.concurrent_writes,
    )


def run_all(spark: SparkSession, cfg: LakeConfig, bronze_inputs: dict[str, DataFrame] | None = None,
            with_stream: bool = False, scorer=None) -> dict[str, Observation]:
    observations = run_bronze(spark, cfg, bronze_inputs)
    if with_stream:
        run_stream(spark, cfg)
    run_silver(spark, cfg)
    run_gold(spark, cfg)
    run_sentiment(spark, cfg, scorer=scorer)
    run_consumer(spark, cfg)
    return observations
