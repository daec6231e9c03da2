import os

from pyspark.sql import functions as F

from creamery.config import LakeConfig
from creamery.plans.sentiment import run_sentiment
from creamery.streaming import run_sensor_stream
from creamery.streaming.sensor import fields_missing_everywhere


def _messages(spark, path, ids, temps):
    rows = [(f'{{"reading_id":"{i}","line_id":"L1","event_timestamp":"2026-07-30T10:00:00","temperature_c":{t},"anomaly_flag":0}}',)
            for i, t in zip(ids, temps)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(path)


def test_available_now_stream_is_incremental(spark, tmp_dir):
    inp, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    cfg = LakeConfig(stream_format="text", stream_path=inp, checkpoint_root=f"{tmp_dir}/ckpt")
    _messages(spark, inp, ["R1", "R2", "R3"], [25.0, 999.0, 30.0])
    q = run_sensor_stream(spark, cfg, out, to_path=True)
    assert spark.read.parquet(out).count() == 2
    metrics = q.lastProgress["observedMetrics"]["sensor_readings_stream_dq"]
    assert metrics["records"] == 3 and metrics["plausible_temperature"] == 1
    assert metrics["malformed_payload"] == 0
    assert set(fields_missing_everywhere(metrics)) == {"pressure_bar", "fill_volume_ml", "vibration_mm_s", "machine_status"}
    run_sensor_stream(spark, cfg, out, to_path=True)
    assert spark.read.parquet(out).count() == 2  # re-run: nothing appended
    _messages(spark, inp, ["R4"], [40.0])
    run_sensor_stream(spark, cfg, out, to_path=True)
    assert sorted(r.reading_id for r in spark.read.parquet(out).collect()) == ["R1", "R3", "R4"]


def test_incremental_scoring_scores_each_audit_once(spark, tmp_dir):
    audits = spark.createDataFrame(
        [("A1", "B1", "Pass", "All parameters nominal."), ("A2", "B2", "Fail", "Fill volume below tolerance."),
         (None, "B3", "Watch", "Slight temperature deviation, monitored.")],
        "audit_id string, batch_id string, audit_outcome string, audit_notes string",
    )
    target = "default.sentiment_test_target"
    cfg = LakeConfig()
    run_sentiment(spark, cfg, audits=audits.limit(0), target=target, location=tmp_dir)
    assert spark.table(target).count() == 0  # created, empty
    run_sentiment(spark, cfg, audits=audits.filter(F.col("audit_id") == "A1"), target=target, location=tmp_dir)
    run_sentiment(spark, cfg, audits=audits, target=target, location=tmp_dir)
    run_sentiment(spark, cfg, audits=audits, target=target, location=tmp_dir)
    rows = {r.audit_id: r for r in spark.table(target).collect()}
    assert len(spark.table(target).collect()) == 3  # NULL id inserted once, not on every run
    assert rows["A2"].sentiment == "Negative" and rows["A2"].root_cause == "Volume"
    assert rows["A1"].llm_analysis == "Positive"
    spark.sql(f"DROP TABLE {target}")
    assert os.path.isdir(tmp_dir)


def test_malformed_messages_are_counted_and_dropped(spark):
    from pyspark.sql import Observation

    from creamery.streaming import bronze_sensor_stream

    msgs = [('{"reading_id":"R1","temperature_c":25.0}',), ("{not json",), ('{"other":1}',)]
    obs = Observation("m")
    rows = bronze_sensor_stream(spark.createDataFrame(msgs, "value string"), obs).collect()
    assert [r.reading_id for r in rows] == ["R1"]
    assert obs.get["malformed_payload"] == 2 and obs.get["valid_reading_id"] == 2


def test_kafka_options_take_credentials_as_arguments():
    from creamery.streaming.sensor import kafka_sasl_options

    opts = kafka_sasl_options("ns.example:9093", "sensors", "$ConnectionString", "secret")
    assert opts["subscribe"] == "sensors" and opts["kafka.security.protocol"] == "SASL_SSL"
    assert 'password="secret"' in opts["kafka.sasl.jaas.config"]


def test_optional_watermark_dedup_in_stream(spark, tmp_dir):
    from creamery.streaming import bronze_sensor_stream, dedup_within_watermark

    inp = f"{tmp_dir}/in"
    _messages(spark, inp, ["R1", "R1", "R2"], [25.0, 25.0, 30.0])
    raw = spark.readStream.format("text").load(inp)
    rows = dedup_within_watermark(bronze_sensor_stream(raw), "1 hour")
    q = (rows.writeStream.format("memory").queryName("wm_dedup").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.reading_id for r in spark.table("wm_dedup").collect()) == ["R1", "R2"]


def test_scoring_run_fails_loudly_without_source(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        run_sentiment(spark, LakeConfig(silver_db="no_such_db"), target="default.never_created", location=tmp_dir)


def test_kafka_source_without_connector_fails_clearly(spark):
    import pytest

    from creamery.streaming.sensor import kafka_sasl_options, read_sensor_source

    cfg = LakeConfig(stream_format="kafka", stream_options=kafka_sasl_options("h:9093", "sensors", "u", "p"))
    with pytest.raises(Exception, match="(?i)kafka"):
        read_sensor_source(spark, cfg)


def test_bucket_count_stays_within_the_limit(spark):
    from creamery.sinks import tables

    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "372530")
    try:
        seen = []
        frame = type(spark.range(1))
        real = frame.repartition
        frame.repartition = lambda self, n, *c: seen.append(n) or real(self, 6, *c)
        try:
            tables.save_table(spark.range(50), "default.bucket_limit", bucket_by=["id"])
        finally:
            frame.repartition = real
        assert seen == [tables.MAX_BUCKETS] and spark.table("default.bucket_limit").count() == 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
        spark.sql("DROP TABLE IF EXISTS default.bucket_limit")


def test_stream_rules_are_logged_over_all_micro_batches(spark, tmp_dir):
    from creamery.plans.layers import run_stream

    inp = f"{tmp_dir}/in"
    for n, temps in enumerate([[25.0, 999.0, 30.0], [-99.0, 700.0], [20.0]]):
        _messages(spark, inp, [f"R{n}{i}" for i in range(len(temps))], temps)
    cfg = LakeConfig(
        bronze_db="smb", silver_db="sms", gold_db="smg", db_root=f"{tmp_dir}/db", stream_format="text", stream_path=inp,
        checkpoint_root=f"{tmp_dir}/ckpt", stream_options={"maxFilesPerTrigger": "1"},
    )
    counts = run_stream(spark, cfg)
    assert (counts["records"], counts["plausible_temperature"], counts["malformed_payload"]) == (6, 3, 0)
    assert spark.table("smb.sensor_readings_stream").count() == 3
    log = spark.table("smb.expectations_log").where("table_name = 'sensor_readings_stream'")
    assert {(r.rule_name, r.total_records, r.failed_records) for r in log.collect()} == {
        ("valid_reading_id", 6, 0), ("plausible_temperature", 6, 3)}
    assert run_stream(spark, cfg)["records"] == 0  # nothing new: a run with zero counts
    assert log.sparkSession.table("smb.expectations_log").count() == 4
