import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import DoubleType, IntegerType, StringType

from creamery.config import LakeConfig, raw_path
from creamery.schemas import SENSOR_SCHEMA
from creamery.sources import files
from creamery.streaming import parse_sensor_payload


def _write(path, text):
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_sensor_schema_contract():
    expected = {
        "reading_id": StringType(), "line_id": StringType(), "event_timestamp": StringType(),
        "temperature_c": DoubleType(), "pressure_bar": DoubleType(), "fill_volume_ml": DoubleType(),
        "vibration_mm_s": DoubleType(), "machine_status": StringType(), "anomaly_flag": IntegerType(),
    }
    assert {f.name: f.dataType for f in SENSOR_SCHEMA.fields} == expected
    assert all(f.nullable for f in SENSOR_SCHEMA.fields)


def test_raw_path():
    assert raw_path(LakeConfig(base_path="s3a://lake/raw/"), "/dim/x.csv") == "s3a://lake/raw/dim/x.csv"


def test_csv_scan_counts_and_binds_by_header(spark, tmp_dir):
    _write(
        f"{tmp_dir}/dim/dim_plants.csv",
        "plant_name,plant_id,country,capacity_liters_day,opened_year\n"
        "Freising,P01,Germany,450000,1972\nLyon,P02,France,,1990\n",
    )
    df = files.dim_plants(spark, LakeConfig(base_path=tmp_dir))
    rows = df.collect()
    assert df.columns[:2] == ["plant_id", "plant_name"]
    assert [(r.plant_id, r.plant_name, r.capacity_liters_day) for r in rows] == [
        ("P01", "Freising", "450000"), ("P02", "Lyon", None),
    ]
    assert all(isinstance(f.dataType, StringType) for f in df.schema.fields)


def test_csv_renamed_header_fails_loudly(spark, tmp_dir):
    _write(f"{tmp_dir}/dim/dim_plants.csv", "plant,plant_name,country,capacity_liters_day,opened_year\nP01,F,DE,1,2\n")
    with pytest.raises(AnalysisException):
        files.dim_plants(spark, LakeConfig(base_path=tmp_dir)).collect()


def test_csv_quoted_multiline_notes(spark, tmp_dir):
    _write(
        f"{tmp_dir}/historical/historical_quality_audit_logs.csv",
        'audit_id,batch_id,audit_date,audit_outcome,audit_notes\n'
        'QA1,B1,2024-01-01,Pass,"All parameters nominal,\nsecond ""line"""\nQA2,B2,2024-01-02,Fail,Seal defect detected.\n',
    )
    rows = files.historical_quality_audit_logs(spark, LakeConfig(base_path=tmp_dir)).collect()
    assert [r.audit_id for r in rows] == ["QA1", "QA2"]
    assert rows[0].audit_notes == 'All parameters nominal,\nsecond "line"'


def test_json_snapshot_inferred_types(spark, tmp_dir):
    _write(
        f"{tmp_dir}/streaming/part-0.json",
        '{"reading_id":"R1","line_id":"L001","event_timestamp":"2026-07-30T10:00:00","temperature_c":72.1,'
        '"pressure_bar":3.2,"fill_volume_ml":500.0,"vibration_mm_s":1.2,"machine_status":"Running","anomaly_flag":0}\n',
    )
    df = files.sensor_readings(spark, LakeConfig(base_path=tmp_dir))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["anomaly_flag"] == "bigint" and types["event_timestamp"] == "string"
    assert df.count() == 1


def test_payload_parse_is_permissive(spark):
    msgs = [
        ('{"reading_id":"R1","temperature_c":25.0,"anomaly_flag":1,"event_timestamp":"2026-07-30T10:00:00"}',),
        ("{not json",),
        ('{"reading_id":"R3","temperature_c":"hot","event_timestamp":"not-a-date"}',),
    ]
    df = spark.createDataFrame(msgs, "value string")
    rows = parse_sensor_payload(df).collect()
    assert rows[0].reading_id == "R1" and rows[0].anomaly_flag == 1 and rows[0].event_timestamp is not None
    assert rows[1].reading_id is None and rows[1].temperature_c is None
    assert rows[2].reading_id == "R3" and rows[2].temperature_c is None and rows[2].event_timestamp is None


def test_json_snapshot_renamed_field_fails_loudly(spark, tmp_dir):
    _write(
        f"{tmp_dir}/streaming/part-0.json",
        '{"reading_id":"R1","line_id":"L001","event_ts":"2026-07-30T10:00:00","temperature_c":72.1,'
        '"pressure_bar":3.2,"fill_volume_ml":500.0,"vibration_mm_s":1.2,"machine_status":"Running","anomaly_flag":0}\n',
    )
    with pytest.raises(AnalysisException):
        files.sensor_readings(spark, LakeConfig(base_path=tmp_dir)).collect()
