"""Independent DuckDB SQL for every registered query.

Each string restates, in plain SQL over the shared test tables, what the
Spark query computes: the adapter mapping (see
:mod:`creamery.sources.driver_tables`), the silver rules and the gold marts.
Two engine differences are bridged explicitly:

* ``round(x, 2)`` on a double: Spark rounds the shortest decimal text of the
  double HALF_UP; DuckDB rounds the binary value. :func:`sround` rounds the
  decimal text in DuckDB too.
* averages are compared at six decimals, rounded to nine before (sums differ in their last digits).
"""

from __future__ import annotations


def sround(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def to_int(expr: str) -> str:
    """Legacy-cast reading of text as int: digits, or decimals truncated toward zero."""
    return f"TRY_CAST(regexp_replace(trim(CAST(({expr}) AS VARCHAR)), '\\.[0-9]*$', '') AS INTEGER)"


def rounded_avg(expr: str) -> str:
    return sround(sround(f"avg({expr})", 9), 6)


def safe_pct(n: str, d: str) -> str:
    return f"CASE WHEN ({d}) > 0 THEN {sround(f'({n}) / ({d}) * 100')} ELSE 0.0 END"


def dedup(source: str, key: str, order: list[str], columns: list[str], order_columns: list[str]) -> str:
    """ROW_NUMBER() = 1 per key: caller's order, then every other column ascending, NULLs first."""
    rest = [c for c in columns if c != key and c not in order_columns]
    order_by = ", ".join(order + [f"{c} ASC NULLS FIRST" for c in rest])
    cols = ", ".join(columns)
    return (
        f"SELECT {cols} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order_by}) AS __rn "
        f"FROM {source}) WHERE __rn = 1"
    )


# ---- bronze: the adapter mapping ------------------------------------------

def forms(table: str, again: str, keyless: str) -> str:
    """``table`` with each row in its forms: 0 as it is, 1 again in another form, 2 again without its key."""
    return f"(SELECT t.*, f.form FROM {table} t, (VALUES (0), (1), (2)) f(form) WHERE form = 0 OR (form = 1 AND {again}) OR (form = 2 AND {keyless}))"


def key(expr: str) -> str:
    return f"CASE WHEN form <> 2 THEN CAST({expr} AS VARCHAR) END"


def again(other: str, same: str) -> str:
    return f"CASE WHEN form = 1 THEN {other} ELSE {same} END"


def _events(reading_id: str, source: str) -> str:
    """Sensor fields of events, already typed as silver would type them."""
    return f"""
        SELECT {reading_id} AS reading_id, CAST(user_id AS VARCHAR) AS line_id,
               ts AS event_timestamp, value AS temperature_c, value / 100 AS pressure_bar,
               value / 10 + 500 AS fill_volume_ml,
               TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS vibration_mm_s,
               event_type AS machine_status, CAST(event_type = 'error' AS INTEGER) AS anomaly_flag
        FROM {source}"""


BRONZE = {
    "b_plants": f"""
        SELECT {key('n.n_nationkey')} AS plant_id, n.n_name AS plant_name, r.r_name AS country,
               CAST((n.n_nationkey + 1) * 50000 AS VARCHAR) || '.0' AS capacity_liters_day,
               {again("'unknown'", 'CAST(n.n_nationkey + 1950 AS VARCHAR)')} AS opened_year
        FROM {forms('nation', 'n_nationkey % 5 = 0', 'n_nationkey % 10 = 3')} n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "b_lines": f"""
        SELECT {key('s_suppkey')} AS line_id, CAST(s_nationkey AS VARCHAR) AS plant_id,
               'T' || CAST(s_suppkey % 4 AS VARCHAR) AS line_type, s_name AS line_name,
               {again("'1999'", 'CAST(s_suppkey % 20 + 2000 AS VARCHAR)')} AS install_year
        FROM {forms('supplier', 's_suppkey % 7 = 0', 's_suppkey % 11 = 0')}""",
    "b_skus": f"""
        SELECT {key('p_partkey')} AS sku_id, p_name AS sku_name, p_type AS product_family,
               CAST(p_size * 10 AS VARCHAR) AS unit_weight_g, {again("'0'", 'CAST(p_size AS VARCHAR)')} AS shelf_life_days
        FROM {forms('part', 'p_partkey % 9 = 0', 'p_partkey % 101 = 0')}""",
    "b_customers": f"""
        SELECT {key('c_custkey')} AS customer_id, c_name AS customer_name,
               CAST(c_nationkey AS VARCHAR) AS country, {again("'TRIAL'", 'c_mktsegment')} AS account_tier,
               CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS VARCHAR) AS contract_start
        FROM {forms('customer', 'c_custkey % 8 = 0', 'c_custkey % 97 = 0')}""",
    "b_batches": """
        SELECT CASE WHEN NOT (l_orderkey % 20 = 0 AND l_linenumber = 7) THEN CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) END AS batch_id,
               CAST(l_partkey % 25 AS VARCHAR) AS plant_id,
               CAST(l_suppkey AS VARCHAR) AS line_id,
               CAST(l_partkey AS VARCHAR) AS sku_id,
               strftime(l_shipdate, '%Y-%m-%d') AS production_start,
               CAST(CAST(floor(q * 100) AS BIGINT) AS VARCHAR) AS planned_qty_units,
               CAST(CAST(floor(round(q * 100 * (1 - l_discount), 0)) AS BIGINT) AS VARCHAR) AS actual_qty_units,
               CAST(CAST(floor(round(l_quantity * l_tax * 10, 0)) AS BIGINT) AS VARCHAR) AS defect_units,
               CASE l_returnflag WHEN 'R' THEN 'Scrapped' WHEN 'A' THEN 'Reworked' ELSE 'Completed' END AS batch_status
        FROM (SELECT *, CASE WHEN l_suppkey % 20 = 0 AND l_partkey % 25 = 3 THEN 0.0 ELSE l_quantity END AS q FROM lineitem)""",
    "b_shipments": f"""
        SELECT {key('o_orderkey')} AS shipment_id,
               CAST(o_orderkey * 8 + 1 AS VARCHAR) AS batch_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               {again("'1990-01-01'", "strftime(o_orderdate, '%Y-%m-%d')")} AS ship_date,
               CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) AS qty_units,
               CASE WHEN o_orderstatus = 'F' THEN 'Delivered'
                    WHEN o_orderstatus = 'O' THEN 'In Transit'
                    WHEN o_orderpriority = '1-URGENT' THEN 'Returned'
                    ELSE 'Delayed' END AS shipment_status
        FROM {forms('orders', 'o_orderkey % 6 = 0', 'o_orderkey % 50 = 0')}""",
    "b_audits": f"""
        SELECT {key('d.doc_id')} AS audit_id,
               CAST(d.doc_id * 8 + 1 + d.doc_id % 7 AS VARCHAR) AS batch_id,
               {again("'2020-02-02'", "CAST(DATE '2023-06-01' + CAST(d.doc_id % 700 AS INTEGER) AS VARCHAR)")} AS audit_date,
               {again("'Watch'", "CASE WHEN l.toxic = 1 THEN 'Fail' WHEN l.quality = 1 THEN 'Pass' ELSE 'Watch' END")} AS audit_outcome,
               d.text AS audit_notes
        FROM {forms('documents', 'doc_id % 12 = 0', 'doc_id % 40 = 0')} d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "b_snapshot": _events(
        "CAST(event_id AS VARCHAR)",
        f"(SELECT * REPLACE ({again('value + 1', 'value')} AS value) FROM {forms('events', 'event_id % 15 = 0', 'false')})",
    ),
    "b_messages": _events(
        "CASE WHEN event_id % 50 = 3 THEN NULL WHEN event_id % 10 = 4 THEN 'L' || CAST(event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END",
        "events",
    ),
}

SENSOR_FIELDS = (
    "reading_id, line_id, event_timestamp, temperature_c, pressure_bar, fill_volume_ml, "
    "vibration_mm_s, machine_status, anomaly_flag"
)
SENSOR_COLS = SENSOR_FIELDS + ", data_source"

# ---- silver -----------------------------------------------------------------

SILVER = {
    "s_plants": dedup(
        f"""(SELECT plant_id, plant_name, country, {to_int('capacity_liters_day')} AS capacity_liters_day,
                    {to_int('opened_year')} AS opened_year FROM b_plants)""",
        "plant_id", [], ["plant_id", "plant_name", "country", "capacity_liters_day", "opened_year"], [],
    ),
    "s_lines": dedup(
        "b_lines", "line_id", [], ["line_id", "plant_id", "line_type", "line_name", "install_year"], []
    ),
    "s_skus": dedup(
        "b_skus", "sku_id", [], ["sku_id", "sku_name", "product_family", "unit_weight_g", "shelf_life_days"], []
    ),
    "s_customers": dedup(
        "b_customers", "customer_id", [],
        ["customer_id", "customer_name", "country", "account_tier", "contract_start"], [],
    ),
    "s_batches": dedup(
        f"""(SELECT *, CASE WHEN actual_qty_units = 0 THEN NULL
                         ELSE {sround('(actual_qty_units - defect_units) / actual_qty_units * 100')} END AS yield_pct
             FROM (SELECT batch_id, plant_id, line_id, sku_id, production_start,
                          {to_int('planned_qty_units')} AS planned_qty_units,
                          {to_int('actual_qty_units')} AS actual_qty_units,
                          {to_int('defect_units')} AS defect_units, batch_status FROM b_batches))""",
        "batch_id", ["production_start DESC NULLS LAST"],
        ["batch_id", "plant_id", "line_id", "sku_id", "production_start", "planned_qty_units",
         "actual_qty_units", "defect_units", "batch_status", "yield_pct"],
        ["production_start"],
    ),
    "s_shipments": dedup(
        f"""(SELECT shipment_id, batch_id, customer_id, ship_date, {to_int('qty_units')} AS qty_units,
                    shipment_status FROM b_shipments)""",
        "shipment_id", ["ship_date DESC NULLS LAST"],
        ["shipment_id", "batch_id", "customer_id", "ship_date", "qty_units", "shipment_status"], ["ship_date"],
    ),
    "s_audits": dedup(
        "b_audits", "audit_id", ["audit_date DESC NULLS LAST"],
        ["audit_id", "batch_id", "audit_date", "audit_outcome", "audit_notes"], ["audit_date"],
    ),
    "s_sensors": dedup(
        f"""(SELECT {SENSOR_FIELDS}, 'batch_file' AS data_source FROM b_snapshot
             UNION ALL
             SELECT {SENSOR_FIELDS}, 'eventhub_stream' AS data_source FROM b_messages
                 WHERE temperature_c BETWEEN -20 AND 150)""",
        "reading_id",
        ["CASE WHEN data_source = 'batch_file' THEN 0 ELSE 1 END ASC", "event_timestamp DESC NULLS LAST"],
        [c.strip() for c in SENSOR_COLS.split(",")],
        ["data_source", "event_timestamp"],
    ),
}

_DEPENDS = {
    "s_plants": ["b_plants"], "s_lines": ["b_lines"], "s_skus": ["b_skus"], "s_customers": ["b_customers"],
    "s_batches": ["b_batches"], "s_shipments": ["b_shipments"], "s_audits": ["b_audits"],
    "s_sensors": ["b_snapshot", "b_messages"],
}


def with_ctes(names: list[str], body: str) -> str:
    """``WITH`` the named bronze/silver relations (and what they need), then ``body``."""
    ordered: list[str] = []
    for name in names:
        for dep in _DEPENDS.get(name, []):
            if dep not in ordered:
                ordered.append(dep)
        if name not in ordered:
            ordered.append(name)
    parts = [f"{n} AS ({BRONZE.get(n) or SILVER[n]})" for n in ordered]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---- gold -------------------------------------------------------------------

GOLD_PRODUCTION = f"""
    SELECT a.line_id, a.plant_id, a.total_batches, a.total_planned_units, a.total_actual_units,
           a.total_defect_units, a.avg_yield_pct, a.scrapped_batches,
           {safe_pct('a.total_defect_units', 'a.total_actual_units')} AS defect_rate_pct,
           p.plant_name, p.country, l.line_type, l.line_name
    FROM (SELECT plant_id, line_id,
                 count(batch_id) AS total_batches,
                 CAST(sum(planned_qty_units) AS BIGINT) AS total_planned_units,
                 CAST(sum(actual_qty_units) AS BIGINT) AS total_actual_units,
                 CAST(sum(defect_units) AS BIGINT) AS total_defect_units,
                 {rounded_avg('yield_pct')} AS avg_yield_pct,
                 count(*) FILTER (WHERE batch_status = 'Scrapped') AS scrapped_batches
          FROM s_batches GROUP BY plant_id, line_id) a
    JOIN s_plants p ON a.plant_id = p.plant_id
    JOIN s_lines l ON a.line_id = l.line_id"""

GOLD_RETAILER = f"""
    SELECT a.customer_id, a.total_shipments, a.total_units_shipped, a.delivered_count, a.delayed_count,
           a.returned_count, {safe_pct('a.delivered_count', 'a.total_shipments')} AS on_time_rate_pct,
           c.customer_name, c.country, c.account_tier, c.contract_start
    FROM (SELECT customer_id, count(shipment_id) AS total_shipments,
                 CAST(sum(qty_units) AS BIGINT) AS total_units_shipped,
                 count(*) FILTER (WHERE shipment_status = 'Delivered') AS delivered_count,
                 count(*) FILTER (WHERE shipment_status = 'Delayed') AS delayed_count,
                 count(*) FILTER (WHERE shipment_status = 'Returned') AS returned_count
          FROM s_shipments GROUP BY customer_id) a
    JOIN s_customers c ON a.customer_id = c.customer_id"""

GOLD_AUDIT = """
    SELECT b.plant_id, p.plant_name, a.audit_outcome, count(a.audit_id) AS audit_count
    FROM s_audits a JOIN s_batches b ON a.batch_id = b.batch_id
    JOIN s_plants p ON b.plant_id = p.plant_id
    GROUP BY b.plant_id, p.plant_name, a.audit_outcome"""

GOLD_SENSOR = f"""
    SELECT a.line_id, a.data_source, a.total_readings, a.anomaly_count, a.avg_temperature_c,
           a.max_temperature_c, a.avg_pressure_bar, a.avg_vibration_mm_s, a.max_vibration_mm_s,
           a.latest_reading_ts, {safe_pct('a.anomaly_count', 'a.total_readings')} AS anomaly_rate_pct,
           l.line_name, l.line_type
    FROM (SELECT line_id, data_source, count(reading_id) AS total_readings,
                 CAST(sum(anomaly_flag) AS BIGINT) AS anomaly_count,
                 {rounded_avg('temperature_c')} AS avg_temperature_c,
                 max(temperature_c) AS max_temperature_c,
                 {rounded_avg('pressure_bar')} AS avg_pressure_bar,
                 {rounded_avg('vibration_mm_s')} AS avg_vibration_mm_s,
                 max(vibration_mm_s) AS max_vibration_mm_s,
                 max(event_timestamp) AS latest_reading_ts
          FROM s_sensors GROUP BY line_id, data_source) a
    JOIN s_lines l ON a.line_id = l.line_id"""


SENTIMENT = """CASE WHEN audit_notes IS NULL THEN NULL
    WHEN audit_notes ILIKE '%keit%' OR audit_notes ILIKE '%ement%' OR audit_notes ILIKE '%que%' THEN 'Negative'
    WHEN audit_notes ILIKE '%tion%' THEN 'Positive' ELSE 'Neutral' END"""
ROOT_CAUSE = """CASE WHEN audit_notes ILIKE '%keit%' THEN 'Volume' WHEN audit_notes ILIKE '%ement%' THEN 'Packaging'
    WHEN audit_notes ILIKE '%que%' THEN 'Microbial' END"""


def _scored(source: str) -> str:
    return (
        "SELECT *, CASE WHEN root_cause IS NULL THEN sentiment ELSE sentiment || ': ' || root_cause END AS llm_analysis "
        f"FROM (SELECT audit_id, batch_id, audit_outcome, audit_notes, {SENTIMENT} AS sentiment, "
        f"{ROOT_CAUSE} AS root_cause FROM {source})"
    )


PENDING = """(SELECT audit_id, batch_id, audit_outcome, audit_notes FROM s_audits a
              WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) IS NOT DISTINCT FROM a.audit_id))"""


def _report(table: str, source: str, rules) -> str:
    parts = []
    for r in rules:
        parts.append(
            f"SELECT '{table}' AS table_name, '{r.name}' AS rule_name, '{r.action}' AS action, "
            f"count(*) AS total_records, count(*) FILTER (WHERE NOT coalesce({r.predicate}, false)) AS failed_records, "
            f"count(*) - count(*) FILTER (WHERE NOT coalesce({r.predicate}, false)) AS passed_records FROM {source}"
        )
    return " UNION ALL ".join(parts)


def _distinct_messages(source: str) -> str:
    """Rows of ``source``, numbered within each reading and event time in the order of the other columns."""
    rest = [c.strip() for c in SENSOR_FIELDS.split(",") if c.strip() not in ("reading_id", "event_timestamp")]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    return f"SELECT *, row_number() OVER (PARTITION BY reading_id, event_timestamp ORDER BY {order}) AS n FROM ({source})"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_dim_plants"] = with_ctes(["s_plants"], "SELECT * FROM s_plants")
    q["silver_dim_lines"] = with_ctes(["s_lines"], "SELECT * FROM s_lines")
    q["silver_dim_sku_catalog"] = with_ctes(["s_skus"], "SELECT * FROM s_skus")
    q["silver_dim_retail_customers"] = with_ctes(["s_customers"], "SELECT * FROM s_customers")
    q["fact_production_batches"] = with_ctes(["s_batches"], "SELECT * FROM s_batches")
    q["fact_shipments"] = with_ctes(["s_shipments"], "SELECT * FROM s_shipments")
    q["fact_quality_audits"] = with_ctes(["s_audits"], "SELECT * FROM s_audits")
    q["fact_sensor_readings"] = with_ctes(["s_sensors"], "SELECT * FROM s_sensors")
    q["d_production_summary"] = with_ctes(["s_batches", "s_plants", "s_lines"], GOLD_PRODUCTION)
    q["d_retailer_360"] = with_ctes(["s_shipments", "s_customers"], GOLD_RETAILER)
    q["d_quality_audit_summary"] = with_ctes(["s_audits", "s_batches", "s_plants"], GOLD_AUDIT)
    q["d_sensor_health_summary"] = with_ctes(["s_sensors", "s_lines"], GOLD_SENSOR)

    from creamery.operators.quality import BRONZE_RULES

    snapshot = f"SELECT {SENSOR_FIELDS} FROM b_snapshot"
    valid_stream = f"SELECT {SENSOR_FIELDS} FROM b_messages WHERE temperature_c BETWEEN -20 AND 150"
    q["audit_pending_anti_join"] = with_ctes(["s_audits"], f"SELECT * FROM {PENDING}")
    q["d_audit_sentiment"] = with_ctes(["s_audits"], _scored(PENDING))
    q["audit_prompt"] = with_ctes(
        ["s_audits"],
        "SELECT audit_id, 'Classify the sentiment of this quality audit note as Positive, Neutral, or Negative, "
        "and give a one-word root cause category if negative. Note: ' || audit_notes AS prompt FROM s_audits",
    )
    q["sentiment_incremental_run"] = with_ctes(["s_audits"], _scored("s_audits"))
    q["expectations_report"] = with_ctes(
        ["b_plants", "b_batches", "b_messages"],
        " UNION ALL ".join([
            _report("dim_plants", "b_plants", BRONZE_RULES["dim_plants"]),
            _report("historical_production_batches", "b_batches", BRONZE_RULES["historical_production_batches"]),
            _report("sensor_readings_stream", "b_messages", BRONZE_RULES["sensor_readings_stream"]),
        ]),
    )
    q["stream_parse"] = with_ctes(["b_messages"], f"SELECT {SENSOR_FIELDS} FROM b_messages")
    q["stream_bronze_valid"] = with_ctes(["b_messages"], valid_stream)
    q["stream_bronze_run"] = with_ctes(["b_messages"], valid_stream)
    q["sensor_union_by_name"] = with_ctes(
        ["b_snapshot", "b_messages"],
        f"SELECT *, 'batch_file' AS data_source FROM ({snapshot}) "
        f"UNION ALL SELECT *, 'eventhub_stream' AS data_source FROM ({valid_stream})",
    )
    q["yield_pct"] = with_ctes(
        ["b_batches"],
        f"""SELECT batch_id, actual_qty_units, defect_units,
                   CASE WHEN actual_qty_units = 0 THEN NULL
                        ELSE {sround('(actual_qty_units - defect_units) / actual_qty_units * 100')} END AS yield_pct
            FROM (SELECT batch_id, {to_int('actual_qty_units')} AS actual_qty_units,
                         {to_int('defect_units')} AS defect_units FROM b_batches)""",
    )
    q["conditional_counts"] = with_ctes(
        ["s_batches"],
        """SELECT line_id,
                  count(*) FILTER (WHERE batch_status = 'Completed') AS completed_batches,
                  count(*) FILTER (WHERE batch_status = 'Reworked') AS reworked_batches,
                  count(*) FILTER (WHERE batch_status = 'Scrapped') AS scrapped_batches
           FROM s_batches GROUP BY line_id""",
    )
    q["csv_roundtrip_scan"] = with_ctes(["b_shipments"], "SELECT * FROM b_shipments")
    q["json_snapshot_scan"] = with_ctes(
        ["b_snapshot"],
        f"""SELECT reading_id, line_id, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp,
                   temperature_c, pressure_bar, fill_volume_ml, vibration_mm_s, machine_status,
                   CAST(anomaly_flag AS BIGINT) AS anomaly_flag
            FROM b_snapshot""",
    )
    q["audit_csv_scan"] = with_ctes(["b_audits"], "SELECT * FROM b_audits")
    q["stream_multi_batch_run"] = with_ctes(["b_messages"], f"SELECT *, 4 AS micro_batches FROM ({valid_stream})")
    q["stream_replay_run"] = with_ctes(["b_messages"], f"SELECT {SENSOR_FIELDS} FROM ({_distinct_messages(valid_stream)}) WHERE n = 1")
    q["stream_expectations_log"] = with_ctes(
        ["b_messages"],
        "SELECT 104 AS micro_batches, * FROM (" + _report("sensor_readings_stream", "b_messages", BRONZE_RULES["sensor_readings_stream"]) + ")",
    )
    q["fact_sensor_incremental"] = with_ctes(["s_sensors"], "SELECT * FROM s_sensors")
    q["sensor_health_merged"] = q["d_sensor_health_summary"]
    q["sentiment_concurrent_runs"] = q["sentiment_incremental_run"]
    q["sentiment_model_run"] = with_ctes(
        ["s_audits"],
        """SELECT audit_id, audit_outcome, CASE WHEN length(audit_notes) % 7 <> 0 THEN
                    CASE length(audit_notes) % 3 WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' ELSE 'Positive' END END AS sentiment,
                  CASE WHEN length(audit_notes) % 7 = 0 THEN 'ValueError: no answer' END AS error
           FROM s_audits""",
    )
    for name, inner in {
        "silver_dim_plants": "s_plants", "silver_dim_lines": "s_lines", "silver_dim_sku_catalog": "s_skus",
        "silver_dim_retail_customers": "s_customers", "fact_production_batches": "s_batches", "fact_shipments": "s_shipments",
        "fact_quality_audits": "s_audits", "fact_sensor_readings": "s_sensors",
    }.items():
        q[f"file_run_{name}"] = with_ctes([inner], f"SELECT * FROM {inner}")
    for name in ("d_production_summary", "d_retailer_360", "d_quality_audit_summary"):
        q[f"file_run_{name}"] = q[name]
    q["file_run_d_audit_sentiment"] = q["sentiment_incremental_run"]
    q["file_run_expectations_log"] = q["expectations_report"]
    q["medallion_files_to_gold"] = q["d_sensor_health_summary"]

    q["cq_plant_ranking"] = with_ctes(
        ["s_batches", "s_plants"],
        f"""SELECT a.plant_id, a.total_batches, a.avg_yield_pct, p.plant_name, p.country,
                   CAST(rank() OVER (ORDER BY a.avg_yield_pct DESC NULLS LAST) AS INTEGER) AS yield_rank
            FROM (SELECT plant_id, count(batch_id) AS total_batches, {rounded_avg('yield_pct')} AS avg_yield_pct
                  FROM s_batches GROUP BY plant_id) a
            JOIN s_plants p ON a.plant_id = p.plant_id""",
    )
    q["cq_exec_kpis"] = with_ctes(
        ["s_batches", "s_shipments", "s_audits"],
        f"""SELECT 'production' AS area, k.kpi_name, k.kpi_value FROM (
                SELECT count(batch_id) AS total_batches, {rounded_avg('yield_pct')} AS avg_yield_pct,
                       {safe_pct('sum(defect_units)', 'sum(actual_qty_units)')} AS defect_rate_pct,
                       {safe_pct("count(*) FILTER (WHERE batch_status = 'Scrapped')", 'count(batch_id)')} AS scrap_rate_pct
                FROM s_batches) w,
              LATERAL (VALUES ('total_batches', CAST(w.total_batches AS DOUBLE)),
                              ('avg_yield_pct', CAST(w.avg_yield_pct AS DOUBLE)),
                              ('defect_rate_pct', CAST(w.defect_rate_pct AS DOUBLE)),
                              ('scrap_rate_pct', CAST(w.scrap_rate_pct AS DOUBLE))) k(kpi_name, kpi_value)
            UNION ALL
            SELECT 'delivery', k.kpi_name, k.kpi_value FROM (
                SELECT count(shipment_id) AS total_shipments,
                       {safe_pct("count(*) FILTER (WHERE shipment_status = 'Delivered')", 'count(shipment_id)')} AS on_time_rate_pct
                FROM s_shipments) w,
              LATERAL (VALUES ('total_shipments', CAST(w.total_shipments AS DOUBLE)),
                              ('on_time_rate_pct', CAST(w.on_time_rate_pct AS DOUBLE))) k(kpi_name, kpi_value)
            UNION ALL
            SELECT 'quality', k.kpi_name, k.kpi_value FROM (
                SELECT count(sentiment) AS scored_audits,
                       {safe_pct("count(*) FILTER (WHERE sentiment = 'Negative')", 'count(sentiment)')} AS negative_note_pct
                FROM (SELECT {SENTIMENT} AS sentiment FROM s_audits)) w,
              LATERAL (VALUES ('scored_audits', CAST(w.scored_audits AS DOUBLE)),
                              ('negative_note_pct', CAST(w.negative_note_pct AS DOUBLE))) k(kpi_name, kpi_value)""",
    )
    q["cq_worst_lines"] = with_ctes(
        ["s_batches", "s_plants", "s_lines"],
        f"""SELECT line_id, plant_id, plant_name, line_name, defect_rate_pct, scrapped_batches, total_batches
            FROM ({GOLD_PRODUCTION})
            ORDER BY defect_rate_pct DESC NULLS LAST, scrapped_batches DESC NULLS LAST, line_id, plant_id
            LIMIT 10""",
    )
    q["cq_late_customers"] = with_ctes(
        ["s_shipments", "s_customers"],
        f"""SELECT customer_id, customer_name, total_shipments, delayed_count, returned_count, on_time_rate_pct
            FROM ({GOLD_RETAILER}) WHERE delayed_count + returned_count > 0""",
    )
    q["cq_health_by_source"] = with_ctes(
        ["s_sensors"],
        f"""SELECT line_id,
                   count(reading_id) FILTER (WHERE data_source = 'batch_file') AS batch_file_readings,
                   CASE WHEN count(*) FILTER (WHERE data_source = 'batch_file') = 0 THEN NULL ELSE
                     CAST(sum(anomaly_flag) FILTER (WHERE data_source = 'batch_file') AS BIGINT) END AS batch_file_anomalies,
                   {rounded_avg("CASE WHEN data_source = 'batch_file' THEN temperature_c END")} AS batch_file_avg_temperature_c,
                   count(reading_id) FILTER (WHERE data_source = 'eventhub_stream') AS eventhub_stream_readings,
                   CASE WHEN count(*) FILTER (WHERE data_source = 'eventhub_stream') = 0 THEN NULL ELSE
                     CAST(sum(anomaly_flag) FILTER (WHERE data_source = 'eventhub_stream') AS BIGINT) END AS eventhub_stream_anomalies,
                   {rounded_avg("CASE WHEN data_source = 'eventhub_stream' THEN temperature_c END")} AS eventhub_stream_avg_temperature_c
            FROM s_sensors GROUP BY line_id""",
    )
    q["cq_outcome_by_sentiment"] = with_ctes(
        ["s_audits"],
        f"SELECT audit_outcome, sentiment, count(*) AS audit_count FROM ({_scored('s_audits')}) GROUP BY audit_outcome, sentiment",
    )
    return q
