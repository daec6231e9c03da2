import datetime as dt

from creamery.config import SOURCE_BATCH, SOURCE_STREAM
from creamery.plans import gold, silver

SENSOR_DDL = (
    "reading_id string, line_id string, event_timestamp string, temperature_c double, pressure_bar double, "
    "fill_volume_ml double, vibration_mm_s double, machine_status string, anomaly_flag bigint"
)


def _sensor(spark, rows):
    return spark.createDataFrame(rows, SENSOR_DDL)


def test_sensor_union_dedup_prefers_stored_copy(spark):
    snap = _sensor(spark, [("R1", "L1", "2026-07-30T10:00:00", 70.0, 3.0, 500.0, 1.0, "Running", 0)])
    live = _sensor(spark, [
        ("R1", "L1", "2026-07-30T10:00:00", 71.0, 3.0, 500.0, 1.0, "Running", 0),
        ("S1", "L1", "2026-07-30T10:00:05", 72.0, 3.1, 499.0, 1.1, "Running", 1),
    ])
    rows = {r.reading_id: r for r in silver.fact_sensor_readings(snap, live).collect()}
    assert set(rows) == {"R1", "S1"}
    assert rows["R1"].data_source == SOURCE_BATCH and rows["R1"].temperature_c == 70.0
    assert rows["S1"].data_source == SOURCE_STREAM
    assert rows["S1"].event_timestamp == dt.datetime(2026, 7, 30, 10, 0, 5)


def test_batches_cast_yield_and_latest_wins(spark):
    df = spark.createDataFrame(
        [
            ("B1", "P1", "L1", "S1", "2024-01-01", "1000", "1000", "50", "Completed"),
            ("B1", "P1", "L1", "S1", "2024-01-02", "1000", "800.0", "1", "Scrapped"),
            ("B2", "P1", "L2", "S1", "2024-01-01", "x", "0", "0", "Completed"),
        ],
        "batch_id string, plant_id string, line_id string, sku_id string, production_start string, "
        "planned_qty_units string, actual_qty_units string, defect_units string, batch_status string",
    )
    rows = {r.batch_id: r for r in silver.fact_production_batches(df).collect()}
    assert rows["B1"].production_start == "2024-01-02" and rows["B1"].yield_pct == 99.88
    assert rows["B2"].planned_qty_units is None and rows["B2"].yield_pct is None


def test_anomaly_rate_and_groups(spark):
    readings = spark.createDataFrame(
        [("R1", "L1", 1, "batch_file"), ("R2", "L1", 0, "batch_file"), ("R3", "L1", 0, "batch_file"),
         ("R4", "L1", 0, "batch_file"), ("R5", "L1", 0, "eventhub_stream"), ("R6", "L2", 0, "batch_file"),
         ("R7", None, 1, "batch_file")],
        "reading_id string, line_id string, anomaly_flag int, data_source string",
    ).selectExpr(
        "*", "CAST(70.0 AS DOUBLE) AS temperature_c", "CAST(3.0 AS DOUBLE) AS pressure_bar",
        "CAST(1.0 AS DOUBLE) AS vibration_mm_s", "TIMESTAMP'2026-07-30 10:00:00' AS event_timestamp",
    )
    lines = spark.createDataFrame([("L1", "Filler-1", "Filler"), ("L2", "Pack-1", "Packer")], "line_id string, line_name string, line_type string")
    out = {(r.line_id, r.data_source): r for r in gold.d_sensor_health_summary(readings, lines).collect()}
    assert set(out) == {("L1", "batch_file"), ("L1", "eventhub_stream"), ("L2", "batch_file")}
    assert out[("L1", "batch_file")].anomaly_rate_pct == 25.0
    assert out[("L1", "batch_file")].avg_temperature_c == 70.0


def test_audit_summary_counts_and_empty(spark):
    audits = spark.createDataFrame(
        [("A1", "B1", "Pass"), ("A2", "B2", "Pass"), ("A3", "B3", "Fail"), ("A4", "B9", "Pass")],
        "audit_id string, batch_id string, audit_outcome string",
    )
    batches = spark.createDataFrame([("B1", "P1"), ("B2", "P1"), ("B3", "P2")], "batch_id string, plant_id string")
    plants = spark.createDataFrame([("P1", "Freising"), ("P2", "Lyon")], "plant_id string, plant_name string")
    got = {(r.plant_id, r.audit_outcome): r.audit_count for r in gold.d_quality_audit_summary(audits, batches, plants).collect()}
    assert got == {("P1", "Pass"): 2, ("P2", "Fail"): 1}
    assert gold.d_quality_audit_summary(audits.limit(0), batches, plants).count() == 0


def test_production_and_retailer_marts(spark):
    batches = spark.createDataFrame(
        [("B1", "P1", "L1", 100, 100, 10, 90.0, "Completed"), ("B2", "P1", "L1", 100, 100, 0, 100.0, "Scrapped"),
         ("B3", "P1", None, 100, 100, 0, 100.0, "Completed")],
        "batch_id string, plant_id string, line_id string, planned_qty_units int, actual_qty_units int, "
        "defect_units int, yield_pct double, batch_status string",
    )
    plants = spark.createDataFrame([("P1", "Freising", "Germany")], "plant_id string, plant_name string, country string")
    lines = spark.createDataFrame([("L1", "Filler", "Filler-1")], "line_id string, line_type string, line_name string")
    rows = gold.d_production_summary(batches, plants, lines).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.total_batches, r.total_defect_units, r.scrapped_batches, r.avg_yield_pct, r.defect_rate_pct) == (2, 10, 1, 95.0, 5.0)

    ships = spark.createDataFrame(
        [("S1", "C1", 10, "Delivered"), ("S2", "C1", 5, "In Transit"), ("S3", "C1", 5, "Returned"), ("S4", "C1", 1, "Delayed")],
        "shipment_id string, customer_id string, qty_units int, shipment_status string",
    )
    customers = spark.createDataFrame([("C1", "Lidl", "Germany", "Local", "2022-10-24")],
                                      "customer_id string, customer_name string, country string, account_tier string, contract_start string")
    c = gold.d_retailer_360(ships, customers).first()
    assert (c.total_shipments, c.total_units_shipped, c.delivered_count, c.delayed_count, c.returned_count, c.on_time_rate_pct) == (4, 21, 1, 1, 1, 25.0)


def test_hot_batch_audit_counts_are_exact(spark):
    """One batch holds a third of all audits: the pre-aggregated join still counts every audit."""
    n = 3000
    rows = [(f"A{i}", "HOT" if i % 3 == 0 else f"B{i % 50}", "Pass" if i % 2 else "Fail") for i in range(n)]
    audits = spark.createDataFrame(rows, "audit_id string, batch_id string, audit_outcome string").repartition(8)
    batches = spark.createDataFrame([("HOT", "P1")] + [(f"B{i}", "P2") for i in range(50)], "batch_id string, plant_id string")
    plants = spark.createDataFrame([("P1", "Hot plant"), ("P2", "Other")], "plant_id string, plant_name string")
    got = {(r.plant_id, r.audit_outcome): r.audit_count for r in gold.d_quality_audit_summary(audits, batches, plants).collect()}
    expected = {}
    for _, b, o in rows:
        p = "P1" if b == "HOT" else "P2"
        expected[(p, o)] = expected.get((p, o), 0) + 1
    assert got == expected


def test_batch_yield_is_not_shuffled(spark):
    """The yield follows from two other columns: it is computed from the rows that stay."""
    cols = ["batch_id", "plant_id", "line_id", "sku_id", "production_start", "planned_qty_units", "actual_qty_units", "defect_units", "batch_status"]
    b = spark.createDataFrame([("1", "p", "l", "s", "2024-01-01", "9", "8", "2", "x"), ("1", "p", "l", "s", "2024-01-01", "9", "8", "1", "x"), ("2", "p", "l", "s", None, "9", "0", "0", "x")], ", ".join(f"{c} string" for c in cols))
    out = silver.fact_production_batches(b)
    assert out.columns == [*cols, "yield_pct"]
    assert sorted((r.batch_id, r.defect_units, r.yield_pct) for r in out.collect()) == [("1", 1, 87.5), ("2", 0, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "yield_pct" in plan.splitlines()[0] and not any("yield_pct" in x for x in plan.splitlines()[1:])
