"""Gold layer: business marts.

Every mart aggregates *before* it joins a dimension, so the join input is one
row per group rather than one row per fact. Aggregates are planned as a
partial (map-side) HashAggregate, a shuffle on the group keys and a final
merge; a hot group key therefore costs one row per map task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamery.functions.measures import count_when, safe_pct
from creamery.operators.joins import join_dim


def d_production_summary(batches: DataFrame, plants: DataFrame, lines: DataFrame) -> DataFrame:
    per_line = batches.groupBy("plant_id", "line_id").agg(
        F.count("batch_id").alias("total_batches"),
        F.sum("planned_qty_units").alias("total_planned_units"),
        F.sum("actual_qty_units").alias("total_actual_units"),
        F.sum("defect_units").alias("total_defect_units"),
        F.avg("yield_pct").alias("avg_yield_pct"),
        count_when(F.col("batch_status") == "Scrapped").alias("scrapped_batches"),
    )
    per_line = per_line.withColumn("defect_rate_pct", safe_pct("total_defect_units", "total_actual_units"))
    with_plant = join_dim(per_line, plants, "plant_id", ["plant_name", "country"])
    return join_dim(with_plant, lines, "line_id", ["line_type", "line_name"])


def d_retailer_360(shipments: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = shipments.groupBy("customer_id").agg(
        F.count("shipment_id").alias("total_shipments"),
        F.sum("qty_units").alias("total_units_shipped"),
        count_when(F.col("shipment_status") == "Delivered").alias("delivered_count"),
        count_when(F.col("shipment_status") == "Delayed").alias("delayed_count"),
        count_when(F.col("shipment_status") == "Returned").alias("returned_count"),
    )
    per_customer = per_customer.withColumn("on_time_rate_pct", safe_pct("delivered_count", "total_shipments"))
    return join_dim(per_customer, customers, "customer_id")


def d_quality_audit_summary(audits: DataFrame, batches: DataFrame, plants: DataFrame) -> DataFrame:
    """Audit counts per plant and outcome.

    Audits are first counted per (batch_id, outcome), so the large-large join
    with the batch fact sees one row per batch and outcome instead of one per
    audit, and a batch audited very often cannot skew the join. The batch
    fact is unique per batch_id (silver dedup), so the join does not multiply
    rows and summing the partial counts gives ``count(audit_id)``.
    """
    per_batch = audits.groupBy("batch_id", "audit_outcome").agg(F.count("audit_id").alias("n"))
    with_plant = per_batch.join(batches.select("batch_id", "plant_id"), "batch_id")
    per_plant = with_plant.groupBy("plant_id", "audit_outcome").agg(F.sum("n").alias("audit_count"))
    named = join_dim(per_plant, plants, "plant_id", ["plant_name"])
    return named.select("plant_id", "plant_name", "audit_outcome", "audit_count")


def d_sensor_health_summary(readings: DataFrame, lines: DataFrame) -> DataFrame:
    per_line = readings.groupBy("line_id", "data_source").agg(
        F.count("reading_id").alias("total_readings"),
        F.sum("anomaly_flag").cast("bigint").alias("anomaly_count"),
        F.avg("temperature_c").alias("avg_temperature_c"),
        F.max("temperature_c").alias("max_temperature_c"),
        F.avg("pressure_bar").alias("avg_pressure_bar"),
        F.avg("vibration_mm_s").alias("avg_vibration_mm_s"),
        F.max("vibration_mm_s").alias("max_vibration_mm_s"),
        F.max("event_timestamp").alias("latest_reading_ts"),
    )
    per_line = per_line.withColumn("anomaly_rate_pct", safe_pct("anomaly_count", "total_readings"))
    return join_dim(per_line, lines, "line_id", ["line_name", "line_type"])
