"""Output schemas of the silver and gold tables (FIXTURES.md §2-3)."""

import pytest

from conftest import SF_SMALL
from creamery.queries import QUERIES

S, I, L, D, T = "string", "int", "bigint", "double", "timestamp"

CONTRACTS = {
    "silver_dim_plants": {"plant_id": S, "plant_name": S, "country": S, "capacity_liters_day": I, "opened_year": I},
    "silver_dim_lines": {"line_id": S, "plant_id": S, "line_type": S, "line_name": S, "install_year": S},
    "fact_production_batches": {
        "batch_id": S, "plant_id": S, "line_id": S, "sku_id": S, "production_start": S,
        "planned_qty_units": I, "actual_qty_units": I, "defect_units": I, "batch_status": S, "yield_pct": D,
    },
    "fact_shipments": {"shipment_id": S, "batch_id": S, "customer_id": S, "ship_date": S, "qty_units": I, "shipment_status": S},
    "fact_quality_audits": {"audit_id": S, "batch_id": S, "audit_date": S, "audit_outcome": S, "audit_notes": S},
    "fact_sensor_readings": {
        "reading_id": S, "line_id": S, "event_timestamp": T, "temperature_c": D, "pressure_bar": D,
        "fill_volume_ml": D, "vibration_mm_s": D, "machine_status": S, "anomaly_flag": I, "data_source": S,
    },
    "d_production_summary": {
        "line_id": S, "plant_id": S, "total_batches": L, "total_planned_units": L, "total_actual_units": L,
        "total_defect_units": L, "avg_yield_pct": D, "scrapped_batches": L, "defect_rate_pct": D,
        "plant_name": S, "country": S, "line_type": S, "line_name": S,
    },
    "d_retailer_360": {
        "customer_id": S, "total_shipments": L, "total_units_shipped": L, "delivered_count": L, "delayed_count": L,
        "returned_count": L, "on_time_rate_pct": D, "customer_name": S, "country": S, "account_tier": S,
        "contract_start": S,
    },
    "d_quality_audit_summary": {"plant_id": S, "plant_name": S, "audit_outcome": S, "audit_count": L},
    "d_sensor_health_summary": {
        "line_id": S, "data_source": S, "total_readings": L, "anomaly_count": L, "avg_temperature_c": D,
        "max_temperature_c": D, "avg_pressure_bar": D, "avg_vibration_mm_s": D, "max_vibration_mm_s": D,
        "latest_reading_ts": T, "anomaly_rate_pct": D, "line_name": S, "line_type": S,
    },
    "d_audit_sentiment": {
        "audit_id": S, "batch_id": S, "audit_outcome": S, "audit_notes": S, "llm_analysis": S,
        "sentiment": S, "root_cause": S,
    },
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_output_contract(spark, name):
    schema = QUERIES[name](spark, SF_SMALL).schema
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == CONTRACTS[name]
