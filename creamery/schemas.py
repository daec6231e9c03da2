"""Column contracts of the three layers."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

# The payload of one live sensor reading (all fields nullable).
SENSOR_SCHEMA = StructType(
    [
        StructField("reading_id", StringType()),
        StructField("line_id", StringType()),
        StructField("event_timestamp", StringType()),
        StructField("temperature_c", DoubleType()),
        StructField("pressure_bar", DoubleType()),
        StructField("fill_volume_ml", DoubleType()),
        StructField("vibration_mm_s", DoubleType()),
        StructField("machine_status", StringType()),
        StructField("anomaly_flag", IntegerType()),
    ]
)

# The stored snapshot: the same fields as JSON inference types them.
SNAPSHOT_SCHEMA = StructType(
    [StructField(f.name, LongType() if f.name == "anomaly_flag" else f.dataType) for f in SENSOR_SCHEMA.fields]
)

SENSOR_FIELDS = [f.name for f in SENSOR_SCHEMA.fields]

# Column order of fact_sensor_readings.
SENSOR_COLS = SENSOR_FIELDS + ["data_source"]

# Columns each bronze input must carry (bound by header name).
REQUIRED_COLUMNS = {
    "dim_plants": ["plant_id", "plant_name", "country", "capacity_liters_day", "opened_year"],
    "dim_lines": ["line_id", "plant_id", "line_type", "line_name", "install_year"],
    "dim_sku_catalog": ["sku_id", "sku_name", "product_family", "unit_weight_g", "shelf_life_days"],
    "dim_retail_customers": ["customer_id", "customer_name", "country", "account_tier", "contract_start"],
    "historical_production_batches": [
        "batch_id", "plant_id", "line_id", "sku_id", "production_start",
        "planned_qty_units", "actual_qty_units", "defect_units", "batch_status",
    ],
    "historical_shipments": [
        "shipment_id", "batch_id", "customer_id", "ship_date", "qty_units", "shipment_status",
    ],
    "historical_quality_audit_logs": [
        "audit_id", "batch_id", "audit_date", "audit_outcome", "audit_notes",
    ],
    "sensor_readings": SENSOR_FIELDS,
}

# The sentiment target table (audit columns + model answer + structured result).
AUDIT_SENTIMENT_DDL = (
    "audit_id STRING, batch_id STRING, audit_outcome STRING, audit_notes STRING, "
    "llm_analysis STRING, sentiment STRING, root_cause STRING"
)
# Audits a scorer reported an error for, by run.
SENTIMENT_ERRORS_DDL = "run_id STRING, audit_id STRING, error STRING"

AUDIT_SENTIMENT_COLS = [
    "audit_id", "batch_id", "audit_outcome", "audit_notes", "llm_analysis", "sentiment", "root_cause",
]
