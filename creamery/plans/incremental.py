"""Incremental refresh: only the days that new readings touch are read and rewritten.

``fact_sensor_readings`` is stored by day of ``event_timestamp``. The rule that
picks the survivor of a reading_id is a total order, so the survivor among old
and new rows is the survivor of (stored survivor, new rows): the bronze rows
behind the stored fact are not read again. The sensor mart is kept as partial
states per line, source and day, from which any refresh merges the whole mart.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.functions.measures import safe_pct
from creamery.operators.joins import join_dim
from creamery.plans import silver
from creamery.schemas import SENSOR_COLS
from creamery.session import scratch_dir
from creamery.sinks.tables import create_table_if_missing, replace_partitions

DAY = "event_date"
FACT_DDL = (
    "reading_id STRING, line_id STRING, event_timestamp TIMESTAMP, temperature_c DOUBLE, pressure_bar DOUBLE, "
    "fill_volume_ml DOUBLE, vibration_mm_s DOUBLE, machine_status STRING, anomaly_flag INT, data_source STRING, event_date DATE"
)
STATE_DDL = (
    "line_id STRING, data_source STRING, readings BIGINT, anomalies BIGINT, "
    "temperature_sum DOUBLE, temperature_n BIGINT, temperature_max DOUBLE, pressure_sum DOUBLE, pressure_n BIGINT, "
    "vibration_sum DOUBLE, vibration_n BIGINT, vibration_max DOUBLE, latest_ts TIMESTAMP, event_date DATE"
)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_days(df: DataFrame, days: list[dt.date | None]) -> DataFrame:
    """Rows of the given days (None: no event time); a filter on the partition column alone."""
    known = [d for d in days if d is not None]
    hit = F.col(DAY).isin(known) if known else F.lit(False)
    return df.where(hit | F.col(DAY).isNull() if None in days else hit)


def refresh_sensor_fact(spark: SparkSession, target: str, snapshot: DataFrame, stream: DataFrame, fmt: str = "parquet", location: str | None = None) -> list[dt.date | None]:
    """Merge new bronze readings into the fact ``target`` (created if missing); returns the days rewritten.

    Touched are the days of the new survivors and those of stored rows with
    the same reading_id (from the fact, that takes the id and day columns
    only). Rows of these days and the new ones are merged, stored, and replace
    these partitions; all other files stay as they are. Running it again with
    the same input changes no row.
    """
    create_table_if_missing(spark, target, FACT_DDL, fmt, location, [DAY])
    new = _stored(silver.fact_sensor_readings(snapshot, stream).withColumn(DAY, F.to_date("event_timestamp")), "new-readings")
    old = spark.table(target)
    same = old.select("reading_id", DAY).join(new.select(F.col("reading_id").alias("_id")), F.expr("reading_id <=> _id"), "left_semi")
    # one row per calendar day
    days = [r[0] for r in new.select(DAY).union(same.select(DAY)).distinct().collect()]
    if not days:
        return []
    rows = silver.surviving_readings(_in_days(old, days).select(*SENSOR_COLS).unionByName(new.select(*SENSOR_COLS)))
    merged = _stored(rows.withColumn(DAY, F.to_date("event_timestamp")), "merged-readings")
    replace_partitions(merged, target, DAY, days)
    return sorted(days, key=lambda d: (d is not None, d))


def sensor_health_state(readings: DataFrame) -> DataFrame:
    """Partial states of the sensor mart, one row per line, source and day: they add up over days."""
    return readings.groupBy("line_id", "data_source", DAY).agg(
        F.count("reading_id").alias("readings"),
        F.sum("anomaly_flag").cast("bigint").alias("anomalies"),
        F.sum("temperature_c").alias("temperature_sum"),
        F.count("temperature_c").alias("temperature_n"),
        F.max("temperature_c").alias("temperature_max"),
        F.sum("pressure_bar").alias("pressure_sum"),
        F.count("pressure_bar").alias("pressure_n"),
        F.sum("vibration_mm_s").alias("vibration_sum"),
        F.count("vibration_mm_s").alias("vibration_n"),
        F.max("vibration_mm_s").alias("vibration_max"),
        F.max("event_timestamp").alias("latest_ts"),
    )


def merged_sensor_health(state: DataFrame, lines: DataFrame) -> DataFrame:
    """The sensor mart from its partial states: the columns of ``gold.d_sensor_health_summary``."""
    mean = lambda x: F.try_divide(F.sum(f"{x}_sum"), F.sum(f"{x}_n"))
    per_line = state.groupBy("line_id", "data_source").agg(
        F.sum("readings").alias("total_readings"),
        F.sum("anomalies").alias("anomaly_count"),
        mean("temperature").alias("avg_temperature_c"),
        F.max("temperature_max").alias("max_temperature_c"),
        mean("pressure").alias("avg_pressure_bar"),
        mean("vibration").alias("avg_vibration_mm_s"),
        F.max("vibration_max").alias("max_vibration_mm_s"),
        F.max("latest_ts").alias("latest_reading_ts"),
    )
    per_line = per_line.withColumn("anomaly_rate_pct", safe_pct("anomaly_count", "total_readings"))
    return join_dim(per_line, lines, "line_id", ["line_name", "line_type"])


def refresh_health_state(spark: SparkSession, target: str, fact: str, days: list[dt.date | None], fmt: str = "parquet", location: str | None = None) -> None:
    """Recompute the states of ``days`` from those partitions of the fact table; other days stay as stored."""
    create_table_if_missing(spark, target, STATE_DDL, fmt, location, [DAY])
    if days:
        states = _stored(sensor_health_state(_in_days(spark.table(fact), days)), "health-state")
        replace_partitions(states.select(*spark.table(target).columns), target, DAY, days)
