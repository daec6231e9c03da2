"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over whole test tables.

They compose exactly the library functions a deployment runs (silver, gold,
expectations, stream parsing, scoring); only the bronze inputs come from the
shared test tables through :class:`~creamery.sources.DriverTables` instead of
raw landing files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.config import SOURCE_BATCH, SOURCE_STREAM, LakeConfig
from creamery.functions.casts import to_int
from creamery.functions.measures import count_when, yield_pct
from creamery.functions.sentiment import Rule, model_scorer, rules_scorer, with_prompt
from creamery.operators.harmonise import harmonise_sensor, union_sources
from creamery.operators.quality import BRONZE_RULES, expectations_report
from creamery.plans import consumer, gold, silver
from creamery.plans.incremental import merged_sensor_health, refresh_health_state, refresh_sensor_fact
from creamery.plans.layers import EXPECTATIONS_LOG, SILVER_PLAN, STREAM_LOG, drop_databases, run_all, run_concurrently, run_stream
from creamery.plans.sentiment import pending_audits, run_sentiment, score_audits
from creamery.session import scratch_dir
from creamery.sinks.tables import save_table, stored_rows, table_location
from creamery.sources import files
from creamery.sources.driver_tables import DriverTables
from creamery.sources.landing import write_csv_input, write_landing, write_payload_files
from creamery.streaming.sensor import bronze_sensor_stream, parse_sensor_payload, run_sensor_stream


# Phrases that occur in the shared test documents; the library's own rules stay its default.
TEST_RULES = (
    Rule("keit", "Negative", "Volume"),
    Rule("ement", "Negative", "Packaging"),
    Rule("que", "Negative", "Microbial"),
    Rule("tion", "Positive"),
)
SCORER = rules_scorer(TEST_RULES)


def _t(spark: SparkSession, sf_dir: str) -> DriverTables:
    return DriverTables(spark, sf_dir)


# ---- silver -------------------------------------------------------------------

def q_silver_dim_plants(spark, sf_dir):
    return silver.silver_dim_plants(_t(spark, sf_dir).dim_plants())


def q_silver_dim_lines(spark, sf_dir):
    return silver.silver_dim_lines(_t(spark, sf_dir).dim_lines())


def q_silver_dim_sku_catalog(spark, sf_dir):
    return silver.silver_dim_sku_catalog(_t(spark, sf_dir).dim_sku_catalog())


def q_silver_dim_retail_customers(spark, sf_dir):
    return silver.silver_dim_retail_customers(_t(spark, sf_dir).dim_retail_customers())


def q_fact_production_batches(spark, sf_dir):
    return silver.fact_production_batches(_t(spark, sf_dir).historical_production_batches())


def q_fact_shipments(spark, sf_dir):
    return silver.fact_shipments(_t(spark, sf_dir).historical_shipments())


def q_fact_quality_audits(spark, sf_dir):
    return silver.fact_quality_audits(_t(spark, sf_dir).historical_quality_audit_logs())


def _sensor_fact(t: DriverTables) -> DataFrame:
    stream_rows = bronze_sensor_stream(t.sensor_payloads())
    return silver.fact_sensor_readings(t.sensor_readings(), stream_rows)


def q_fact_sensor_readings(spark, sf_dir):
    return _sensor_fact(_t(spark, sf_dir))


# ---- gold ---------------------------------------------------------------------

def q_d_production_summary(spark, sf_dir):
    t = _t(spark, sf_dir)
    return gold.d_production_summary(
        silver.fact_production_batches(t.historical_production_batches()),
        silver.silver_dim_plants(t.dim_plants()),
        silver.silver_dim_lines(t.dim_lines()),
    )


def q_d_retailer_360(spark, sf_dir):
    t = _t(spark, sf_dir)
    return gold.d_retailer_360(
        silver.fact_shipments(t.historical_shipments()),
        silver.silver_dim_retail_customers(t.dim_retail_customers()),
    )


def q_d_quality_audit_summary(spark, sf_dir):
    t = _t(spark, sf_dir)
    return gold.d_quality_audit_summary(
        silver.fact_quality_audits(t.historical_quality_audit_logs()),
        silver.fact_production_batches(t.historical_production_batches()),
        silver.silver_dim_plants(t.dim_plants()),
    )


def q_d_sensor_health_summary(spark, sf_dir):
    t = _t(spark, sf_dir)
    return gold.d_sensor_health_summary(_sensor_fact(t), silver.silver_dim_lines(t.dim_lines()))


# ---- operators on their own ---------------------------------------------------

def q_yield_pct(spark, sf_dir):
    """FN-10 per bronze batch row (before dedup)."""
    b = _t(spark, sf_dir).historical_production_batches()
    typed = b.select("batch_id", to_int("actual_qty_units").alias("actual_qty_units"),
                     to_int("defect_units").alias("defect_units"))
    return typed.withColumn("yield_pct", yield_pct("actual_qty_units", "defect_units"))


def q_conditional_counts(spark, sf_dir):
    """AGG-09: batches per status and line."""
    b = silver.fact_production_batches(_t(spark, sf_dir).historical_production_batches())
    return b.groupBy("line_id").agg(
        count_when(F.col("batch_status") == "Completed").alias("completed_batches"),
        count_when(F.col("batch_status") == "Reworked").alias("reworked_batches"),
        count_when(F.col("batch_status") == "Scrapped").alias("scrapped_batches"),
    )


def q_sensor_union_by_name(spark, sf_dir):
    """SET-01: stored and live readings, harmonised, before dedup."""
    t = _t(spark, sf_dir)
    return union_sources(
        harmonise_sensor(t.sensor_readings(), SOURCE_BATCH),
        harmonise_sensor(bronze_sensor_stream(t.sensor_payloads()), SOURCE_STREAM),
    )


def q_stream_bronze_valid(spark, sf_dir):
    """STR-01 logic in batch: parse every message, drop implausible temperatures."""
    return bronze_sensor_stream(_t(spark, sf_dir).sensor_payloads())


def q_stream_parse(spark, sf_dir):
    """FN-01/02/03, PRJ-01/02: every message parsed, nothing dropped."""
    return parse_sensor_payload(_t(spark, sf_dir).sensor_payloads())


def q_expectations_report(spark, sf_dir):
    """DQ-05: passed / failed per rule for the three bronze tables that carry rules."""
    t = _t(spark, sf_dir)
    parts = [
        expectations_report(t.dim_plants(), "dim_plants", BRONZE_RULES["dim_plants"]),
        expectations_report(
            t.historical_production_batches(), "historical_production_batches",
            BRONZE_RULES["historical_production_batches"],
        ),
        expectations_report(
            parse_sensor_payload(t.sensor_payloads()), "sensor_readings_stream",
            BRONZE_RULES["sensor_readings_stream"],
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_audit_pending_anti_join(spark, sf_dir):
    """JN-07: audits not yet scored (already scored = the labelled ones)."""
    t = _t(spark, sf_dir)
    audits = silver.fact_quality_audits(t.historical_quality_audit_logs())
    return pending_audits(audits, t.scored_audit_ids())


def q_d_audit_sentiment(spark, sf_dir):
    """GLD-05 rows one incremental run appends: pending audits, scored."""
    t = _t(spark, sf_dir)
    audits = silver.fact_quality_audits(t.historical_quality_audit_logs())
    return score_audits(pending_audits(audits, t.scored_audit_ids()), SCORER)


def q_audit_prompt(spark, sf_dir):
    """FN-11: the instruction joined with each note."""
    audits = silver.fact_quality_audits(_t(spark, sf_dir).historical_quality_audit_logs())
    return audits.select("audit_id", with_prompt(F.col("audit_notes")).alias("prompt"))


def _audit_fact(spark, sf_dir):
    """The silver audits as stored rows: the runs over them read files, as over the silver table."""
    return stored_rows(silver.fact_quality_audits(_t(spark, sf_dir).historical_quality_audit_logs()), "audits")


def _sentiment_target(spark):
    """A target table of its own below the shared scratch folder: (name, location)."""
    return f"default.audit_sentiment_{uuid.uuid4().hex[:10]}", scratch_dir(spark, "sentiment")


def _files_of(spark, table: str) -> DataFrame:
    """The rows of a scratch table; its catalog entry goes, its files stay until the folder is cleaned."""
    place, schema = table_location(spark, table), spark.table(table).schema
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(schema).parquet(place)


def q_sentiment_incremental_run(spark, sf_dir):
    """UDF-02 / SNK-03 / SNK-04 for real: create, append twice, re-run; every audit scored once."""
    t = _t(spark, sf_dir)
    target, root = _sentiment_target(spark)
    cfg = LakeConfig()
    audits = _audit_fact(spark, sf_dir)
    labelled = audits.join(t.scored_audit_ids(), "audit_id", "left_semi")
    run_sentiment(spark, cfg, SCORER, audits=labelled, target=target, location=root)  # first run: labelled audits
    run_sentiment(spark, cfg, SCORER, audits=audits, target=target, location=root)    # second run: only the rest
    run_sentiment(spark, cfg, SCORER, audits=audits, target=target, location=root)    # third run: nothing new
    return _files_of(spark, target)


def q_sentiment_concurrent_runs(spark, sf_dir):
    """SNK-04 / UDF-02: two runs over all audits at the same time, and one tried again; every audit stored once."""
    audits = _audit_fact(spark, sf_dir)
    target, root = _sentiment_target(spark)
    run = lambda run_id: run_sentiment(spark, LakeConfig(), SCORER, audits=audits, target=target, location=root, run_id=run_id)
    run_concurrently([lambda: run("first"), lambda: run("second")], 2)
    run("first")
    return _files_of(spark, target)


def _answers(notes: list[str]) -> list[tuple[str, str | None]]:
    """A stand-in model: labels by text length, and fails on a batch with a text it has no answer to."""
    if any(len(x) % 7 == 0 for x in notes):
        raise ValueError("no answer")
    return [(("Negative", "Neutral", "Positive")[len(x) % 3], None) for x in notes]


def q_sentiment_model_run(spark, sf_dir):
    """UDF-01 / FN-12: a model that fails on some notes; these stay pending with their error, the others are stored."""
    audits = _audit_fact(spark, sf_dir)
    target, root = _sentiment_target(spark)
    run_id = run_sentiment(spark, LakeConfig(), model_scorer(_answers, isolate=True), audits=audits, target=target, location=root)
    errors = _files_of(spark, f"{target}_errors").where(F.col("run_id") == run_id).select(F.col("audit_id").alias("_id"), "error")
    scored = _files_of(spark, target).select(F.col("audit_id").alias("_scored"), "sentiment")
    out = audits.join(scored, F.expr("audit_id <=> _scored"), "left").join(errors, F.expr("audit_id <=> _id"), "left")
    return out.select("audit_id", "audit_outcome", "sentiment", "error")


def q_csv_roundtrip_scan(spark, sf_dir):
    """SRC-06: a header CSV landing file read back by name, all columns string."""
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "landing")
    write_csv_input(t, "historical_shipments", root)
    return files.historical_shipments(spark, LakeConfig(base_path=root))


def q_audit_csv_scan(spark, sf_dir):
    """SRC-07: notes over several lines in a CSV with a record separator of its own, which tasks can split."""
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "landing")
    write_csv_input(t, "historical_quality_audit_logs", root, RECORD_SEPARATORS["historical_quality_audit_logs"])
    return files.historical_quality_audit_logs(spark, LakeConfig(base_path=root, csv_record_separators=RECORD_SEPARATORS))


def q_json_snapshot_scan(spark, sf_dir):
    """SRC-08: the JSON-lines sensor snapshot read once, by declared types; missing fields fail the run."""
    t = _t(spark, sf_dir)
    root, table = scratch_dir(spark, "landing"), f"default.snapshot_{uuid.uuid4().hex[:10]}"
    t.sensor_readings().write.json(f"{root}/streaming/")
    rows, check = files.sensor_snapshot(spark, LakeConfig(base_path=root))
    save_table(rows, table, path=f"{root}/stored", check=check)
    return _files_of(spark, table)


def _live(spark, sf_dir, message_files: int | None = None, **options):
    """(config, output folder) of a live run over the messages of all events."""
    root = scratch_dir(spark, "stream")
    write_payload_files(_t(spark, sf_dir), f"{root}/in", message_files)
    return LakeConfig(stream_format="text", stream_path=f"{root}/in", checkpoint_root=f"{root}/ckpt", **options), f"{root}/out"


def q_stream_bronze_run(spark, sf_dir):
    """STR-01/02, SNK-02: message files -> availableNow stream -> append-only sink."""
    cfg, out = _live(spark, sf_dir)
    run_sensor_stream(spark, cfg, out, to_path=True)
    run_sensor_stream(spark, cfg, out, to_path=True)  # re-run: nothing new to append
    return spark.read.parquet(out)


def q_stream_multi_batch_run(spark, sf_dir):
    """STR-01 / SRC-09: a backlog of 12 files taken three files at a time, and the number of micro-batches."""
    cfg, out = _live(spark, sf_dir, 12, max_files_per_trigger=3)
    history = []
    run_sensor_stream(spark, cfg, out, to_path=True, history=history)
    return spark.read.parquet(out).withColumn("micro_batches", F.lit(len(history)))


def q_stream_replay_run(spark, sf_dir):
    """STR-03 / DD-08: all messages sent again, in part within one micro-batch; none is stored twice."""
    cfg, out = _live(spark, sf_dir, 3, max_files_per_trigger=2, stream_dedup=True)
    bronze_sensor_stream(_t(spark, sf_dir).sensor_payloads()).limit(0).write.parquet(out)  # the live table exists first
    run_sensor_stream(spark, cfg, out, to_path=True)
    write_payload_files(_t(spark, sf_dir), cfg.stream_path, 5)
    run_sensor_stream(spark, cfg, out, to_path=True)
    return spark.read.parquet(out)


def q_stream_expectations_log(spark, sf_dir):
    """DQ-03/DQ-04: the logged counts of 104 micro-batches, summed by rule."""
    cfg, _ = _live(spark, sf_dir, 104, max_files_per_trigger=1)
    tag = uuid.uuid4().hex[:8]
    cfg = replace(cfg, bronze_db=f"bronze_{tag}", silver_db=f"silver_{tag}", gold_db=f"gold_{tag}", db_root=scratch_dir(spark, "lake"))
    run_stream(spark, cfg)
    log = spark.table(cfg.table("bronze", STREAM_LOG))
    out = log.groupBy("table_name", "rule_name", "action").agg(
        F.countDistinct("batch_id").cast("int").alias("micro_batches"),
        *[F.sum(c).alias(c) for c in ("total_records", "failed_records", "passed_records")],
    )
    kept = scratch_dir(spark, "log")
    out.write.parquet(kept)  # the log is a managed table and goes with its database
    drop_databases(spark, cfg)
    return spark.read.schema(out.schema).parquet(kept)


def _two_refreshes(spark, sf_dir):
    """(fact table, state table, days of the second refresh): all events but those of the last day, then these."""
    t, tag = _t(spark, sf_dir), uuid.uuid4().hex[:10]
    last = t.table("events").agg(F.max(F.to_date("ts"))).first()[0]
    # ts of an event is its message's event time, as text
    is_last = F.col("event_timestamp").cast("date") == F.lit(last)
    fact, state = f"default.fact_{tag}", f"default.state_{tag}"
    root, days = scratch_dir(spark, "fact"), []
    for part in (F.coalesce(~is_last, F.lit(True)), is_last):
        days = refresh_sensor_fact(
            spark, fact, t.sensor_readings().where(part), bronze_sensor_stream(t.sensor_payloads()).where(part), location=f"{root}/fact"
        )
        refresh_health_state(spark, state, fact, days, location=f"{root}/state")
    return fact, state, days


def q_fact_sensor_incremental(spark, sf_dir):
    """SNK-01 / SLV-09: the day-partitioned fact after two refreshes, the second with one new day."""
    fact, state, _ = _two_refreshes(spark, sf_dir)
    spark.sql(f"DROP TABLE {state}")
    return _files_of(spark, fact).drop("event_date")


def q_sensor_health_merged(spark, sf_dir):
    """AGG-04 / GLD-04: the sensor mart merged from states per line, source and day, refreshed twice."""
    fact, state, _ = _two_refreshes(spark, sf_dir)
    spark.sql(f"DROP TABLE {fact}")
    return merged_sensor_health(_files_of(spark, state), silver.silver_dim_lines(_t(spark, sf_dir).dim_lines()))


# ---- the whole run over files ---------------------------------------------------

# One character that no text holds; the audit file's records end with it.
RECORD_SEPARATORS = {"historical_quality_audit_logs": "\x1e"}
_FILE_RUNS: dict[tuple, LakeConfig] = {}


def _file_run(spark, sf_dir, again: bool = False) -> LakeConfig:
    """One run over landing files; queries of its stored tables share it within a session."""
    run = (spark.sparkContext.applicationId, sf_dir)
    if again or run not in _FILE_RUNS:
        t = _t(spark, sf_dir)
        root = scratch_dir(spark, "lake")
        write_landing(t, f"{root}/raw", separators=RECORD_SEPARATORS, compression="gzip")
        write_payload_files(t, f"{root}/messages", compression="gzip")
        tag = uuid.uuid4().hex[:8]
        cfg = LakeConfig(
            base_path=f"{root}/raw",
            bronze_db=f"bronze_{tag}", silver_db=f"silver_{tag}", gold_db=f"gold_{tag}",
            db_root=f"{root}/db", stream_format="text", stream_path=f"{root}/messages",
            checkpoint_root=f"{root}/ckpt", csv_record_separators=RECORD_SEPARATORS,
        )
        run_all(spark, cfg, with_stream=True, scorer=SCORER)
        if run in _FILE_RUNS:
            drop_databases(spark, _FILE_RUNS[run])
        _FILE_RUNS[run] = cfg
    return _FILE_RUNS[run]


def q_medallion_files_to_gold(spark, sf_dir):
    """SNK-01, SRC-01..10, STR-03: landing files -> bronze -> live stream -> silver -> gold tables."""
    cfg = _file_run(spark, sf_dir, again=True)
    return spark.table(cfg.table("gold", "d_sensor_health_summary"))


def _file_run_table(layer: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        return spark.table(_file_run(spark, sf_dir).table(layer, name))

    return query


def q_file_run_expectations_log(spark, sf_dir):
    """DQ-05: what the run stored about its rules (one run: one row per rule)."""
    cfg = _file_run(spark, sf_dir)
    return spark.table(cfg.table("bronze", EXPECTATIONS_LOG)).drop("run_ts")


# ---- consumer queries -----------------------------------------------------------

def q_cq_plant_ranking(spark, sf_dir):
    t = _t(spark, sf_dir)
    return consumer.plant_ranking(
        silver.fact_production_batches(t.historical_production_batches()),
        silver.silver_dim_plants(t.dim_plants()),
    )


def q_cq_exec_kpis(spark, sf_dir):
    t = _t(spark, sf_dir)
    return consumer.exec_kpis(
        silver.fact_production_batches(t.historical_production_batches()),
        silver.fact_shipments(t.historical_shipments()),
        score_audits(silver.fact_quality_audits(t.historical_quality_audit_logs()), SCORER),
    )


def q_cq_worst_lines(spark, sf_dir):
    return consumer.worst_lines(q_d_production_summary(spark, sf_dir), k=10)


def q_cq_late_customers(spark, sf_dir):
    return consumer.late_customers(q_d_retailer_360(spark, sf_dir))


def q_cq_health_by_source(spark, sf_dir):
    return consumer.health_by_source(_sensor_fact(_t(spark, sf_dir)))


def q_cq_outcome_by_sentiment(spark, sf_dir):
    t = _t(spark, sf_dir)
    return consumer.outcome_by_sentiment(score_audits(silver.fact_quality_audits(t.historical_quality_audit_logs()), SCORER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_dim_plants": q_silver_dim_plants,
    "silver_dim_lines": q_silver_dim_lines,
    "silver_dim_sku_catalog": q_silver_dim_sku_catalog,
    "silver_dim_retail_customers": q_silver_dim_retail_customers,
    "fact_production_batches": q_fact_production_batches,
    "fact_shipments": q_fact_shipments,
    "fact_quality_audits": q_fact_quality_audits,
    "fact_sensor_readings": q_fact_sensor_readings,
    "d_production_summary": q_d_production_summary,
    "d_retailer_360": q_d_retailer_360,
    "d_quality_audit_summary": q_d_quality_audit_summary,
    "d_sensor_health_summary": q_d_sensor_health_summary,
    "audit_pending_anti_join": q_audit_pending_anti_join,
    "d_audit_sentiment": q_d_audit_sentiment,
    "audit_prompt": q_audit_prompt,
    "sentiment_incremental_run": q_sentiment_incremental_run,
    "expectations_report": q_expectations_report,
    "stream_parse": q_stream_parse,
    "stream_bronze_valid": q_stream_bronze_valid,
    "stream_bronze_run": q_stream_bronze_run,
    "sensor_union_by_name": q_sensor_union_by_name,
    "yield_pct": q_yield_pct,
    "conditional_counts": q_conditional_counts,
    "csv_roundtrip_scan": q_csv_roundtrip_scan,
    "json_snapshot_scan": q_json_snapshot_scan,
    "audit_csv_scan": q_audit_csv_scan,
    "stream_multi_batch_run": q_stream_multi_batch_run,
    "stream_expectations_log": q_stream_expectations_log,
    "stream_replay_run": q_stream_replay_run,
    "fact_sensor_incremental": q_fact_sensor_incremental,
    "sensor_health_merged": q_sensor_health_merged,
    "sentiment_concurrent_runs": q_sentiment_concurrent_runs,
    "sentiment_model_run": q_sentiment_model_run,
    "medallion_files_to_gold": q_medallion_files_to_gold,
    **{f"file_run_{n}": _file_run_table("silver", n) for n in SILVER_PLAN},
    **{f"file_run_{n}": _file_run_table("gold", n) for n in ("d_production_summary", "d_retailer_360", "d_quality_audit_summary", "d_audit_sentiment")},
    "file_run_expectations_log": q_file_run_expectations_log,
    "cq_plant_ranking": q_cq_plant_ranking,
    "cq_exec_kpis": q_cq_exec_kpis,
    "cq_worst_lines": q_cq_worst_lines,
    "cq_late_customers": q_cq_late_customers,
    "cq_health_by_source": q_cq_health_by_source,
    "cq_outcome_by_sentiment": q_cq_outcome_by_sentiment,
}


def _rounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Averages to six decimals, as the compared SQL rounds them; the library's own are unrounded.

    Rounding to nine decimals first takes away what the order of a sum leaves
    in the last digits, so that a mean in the middle of two six-decimal
    numbers goes the same way in both engines.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        means = [c for c, kind in df.dtypes if kind == "double" and ("avg_" in c or c == "kpi_value")]
        return df.withColumns({c: F.round(F.round(c, 9), 6) for c in means}) if means else df

    return run


for _name in ("d_production_summary", "d_sensor_health_summary", "sensor_health_merged", "medallion_files_to_gold", "file_run_d_production_summary", "cq_plant_ranking", "cq_exec_kpis", "cq_worst_lines", "cq_health_by_source"):
    QUERIES[_name] = _rounded(QUERIES[_name])
