"""Bronze inputs derived from the shared test tables.

The checks run on a generic star schema (region, nation, supplier, part,
customer, orders, lineitem, events, documents, labels). These functions map
it onto the manufacturing inputs, column for column, with built-in
expressions only. Bronze is string-typed like a header-only CSV scan, so
silver's tolerant casts are exercised. Raw inputs are never clean, so a fixed
share of the rows, chosen by key, stands in them again in another form, or
without its key, and some quantities are zero: duplicate removal, the quality
rules and the guards against zero all have work. Every mapping reads whole
tables; the oracle in :mod:`creamery.oracle` states the same mapping in SQL.

| bronze table                  | from                 |
|-------------------------------|----------------------|
| dim_plants                    | nation ⋈ region      |
| dim_lines                     | supplier             |
| dim_sku_catalog               | part                 |
| dim_retail_customers          | customer             |
| historical_production_batches | lineitem (duplicate batch ids included) |
| historical_shipments          | orders               |
| historical_quality_audit_logs | documents ⟕ labels   |
| sensor_readings (snapshot)    | events                          |
| sensor stream payloads        | every event, as a JSON message; a tenth as a reading of its own, that only the stream has |
| already-scored audit ids      | labels               |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "labels",
)


# The form of a row: as it is, again in another form, again without its key.
SAME, AGAIN, KEYLESS = 0, 1, 2


def _forms(df: DataFrame, again: Column, keyless: Column) -> DataFrame:
    """Each row of ``df`` in its forms, told by the column ``form``."""
    forms = F.array(F.lit(SAME), F.when(again, F.lit(AGAIN)), F.when(keyless, F.lit(KEYLESS)))
    return df.withColumn("form", F.explode(F.array_compact(forms)))


def _key(key: Column) -> Column:
    return F.when(F.col("form") != KEYLESS, key)


def _again(other: Column, same: Column) -> Column:
    return F.when(F.col("form") == AGAIN, other).otherwise(same)


class DriverTables:
    """Lazy readers over ``<sf_dir>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- dimensions -------------------------------------------------------

    def dim_plants(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        rows = _forms(n.join(r, n.n_regionkey == r.r_regionkey), F.col("n_nationkey") % 5 == 0, F.col("n_nationkey") % 10 == 3)
        return rows.select(
            _key(F.col("n_nationkey").cast("string")).alias("plant_id"),
            F.col("n_name").alias("plant_name"),
            F.col("r_name").alias("country"),
            # Spreadsheet-style "450000.0" text: silver must still read an int.
            F.concat(((F.col("n_nationkey") + 1) * 50000).cast("string"), F.lit(".0")).alias("capacity_liters_day"),
            _again(F.lit("unknown"), (F.col("n_nationkey") + 1950).cast("string")).alias("opened_year"),
        )

    def dim_lines(self) -> DataFrame:
        rows = _forms(self.table("supplier"), F.col("s_suppkey") % 7 == 0, F.col("s_suppkey") % 11 == 0)
        return rows.select(
            _key(F.col("s_suppkey").cast("string")).alias("line_id"),
            F.col("s_nationkey").cast("string").alias("plant_id"),
            F.concat(F.lit("T"), (F.col("s_suppkey") % 4).cast("string")).alias("line_type"),
            F.col("s_name").alias("line_name"),
            _again(F.lit("1999"), (F.col("s_suppkey") % 20 + 2000).cast("string")).alias("install_year"),
        )

    def dim_sku_catalog(self) -> DataFrame:
        rows = _forms(self.table("part"), F.col("p_partkey") % 9 == 0, F.col("p_partkey") % 101 == 0)
        return rows.select(
            _key(F.col("p_partkey").cast("string")).alias("sku_id"),
            F.col("p_name").alias("sku_name"),
            F.col("p_type").alias("product_family"),
            (F.col("p_size") * 10).cast("string").alias("unit_weight_g"),
            _again(F.lit("0"), F.col("p_size").cast("string")).alias("shelf_life_days"),
        )

    def dim_retail_customers(self) -> DataFrame:
        rows = _forms(self.table("customer"), F.col("c_custkey") % 8 == 0, F.col("c_custkey") % 97 == 0)
        return rows.select(
            _key(F.col("c_custkey").cast("string")).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").cast("string").alias("country"),
            _again(F.lit("TRIAL"), F.col("c_mktsegment")).alias("account_tier"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))
            .cast("string")
            .alias("contract_start"),
        )

    # ---- facts ------------------------------------------------------------

    def historical_production_batches(self) -> DataFrame:
        """Batches; duplicates are in the table. Some have no id, and some lines produced nothing at one plant."""
        idle = (F.col("l_suppkey") % 20 == 0) & (F.col("l_partkey") % 25 == 3)
        q = F.when(idle, F.lit(0.0)).otherwise(F.col("l_quantity"))
        no_id = (F.col("l_orderkey") % 20 == 0) & (F.col("l_linenumber") == 7)
        return self.table("lineitem").select(
            F.when(~no_id, (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string")).alias("batch_id"),
            (F.col("l_partkey") % 25).cast("string").alias("plant_id"),
            F.col("l_suppkey").cast("string").alias("line_id"),
            F.col("l_partkey").cast("string").alias("sku_id"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("production_start"),
            F.floor(q * 100).cast("string").alias("planned_qty_units"),
            F.floor(F.round(q * 100 * (1 - F.col("l_discount")), 0)).cast("string").alias("actual_qty_units"),
            F.floor(F.round(F.col("l_quantity") * F.col("l_tax") * 10, 0)).cast("string").alias("defect_units"),
            F.when(F.col("l_returnflag") == "R", "Scrapped")
            .when(F.col("l_returnflag") == "A", "Reworked")
            .otherwise("Completed")
            .alias("batch_status"),
        )

    def historical_shipments(self) -> DataFrame:
        rows = _forms(self.table("orders"), F.col("o_orderkey") % 6 == 0, F.col("o_orderkey") % 50 == 0)
        return rows.select(
            _key(F.col("o_orderkey").cast("string")).alias("shipment_id"),
            (F.col("o_orderkey") * 8 + 1).cast("string").alias("batch_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            _again(F.lit("1990-01-01"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("ship_date"),
            F.floor(F.col("o_totalprice") / 100).cast("string").alias("qty_units"),
            F.when(F.col("o_orderstatus") == "F", "Delivered")
            .when(F.col("o_orderstatus") == "O", "In Transit")
            .when(F.col("o_orderpriority") == "1-URGENT", "Returned")
            .otherwise("Delayed")
            .alias("shipment_status"),
        )

    def historical_quality_audit_logs(self) -> DataFrame:
        d, lab = self.table("documents"), self.table("labels")
        joined = _forms(d.join(lab, "doc_id", "left"), F.col("doc_id") % 12 == 0, F.col("doc_id") % 40 == 0)
        return joined.select(
            _key(F.col("doc_id").cast("string")).alias("audit_id"),
            (F.col("doc_id") * 8 + 1 + F.col("doc_id") % 7).cast("string").alias("batch_id"),
            _again(F.lit("2020-02-02"), F.date_add(F.lit("2023-06-01").cast("date"), (F.col("doc_id") % 700).cast("int")).cast("string"))
            .alias("audit_date"),
            _again(F.lit("Watch"), F.when(F.col("toxic") == 1, "Fail").when(F.col("quality") == 1, "Pass").otherwise("Watch")).alias("audit_outcome"),
            F.col("text").alias("audit_notes"),
        )

    def scored_audit_ids(self) -> DataFrame:
        """Audits a previous scoring run already handled (the labelled documents)."""
        return self.table("labels").select(F.col("doc_id").cast("string").alias("audit_id"))

    # ---- sensors ----------------------------------------------------------

    def _sensor_fields(self, events: DataFrame, reading_id: Column) -> DataFrame:
        v = F.col("value")
        return events.select(
            reading_id.alias("reading_id"),
            F.col("user_id").cast("string").alias("line_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
            v.alias("temperature_c"),
            (v / 100).alias("pressure_bar"),
            (v / 10 + 500).alias("fill_volume_ml"),
            F.get_json_object("props", "$.k").try_cast("double").alias("vibration_mm_s"),
            F.col("event_type").alias("machine_status"),
            (F.col("event_type") == "error").cast("int").alias("anomaly_flag"),
        )

    def sensor_readings(self) -> DataFrame:
        """The stored snapshot, typed as JSON inference would type it; some readings stand in it again, warmer."""
        events = _forms(self.table("events"), F.col("event_id") % 15 == 0, F.lit(False))
        events = events.withColumn("value", _again(F.col("value") + 1, F.col("value")))
        rows = self._sensor_fields(events, F.col("event_id").cast("string"))
        return rows.withColumn("anomaly_flag", F.col("anomaly_flag").cast("bigint"))

    def sensor_payloads(self, events: DataFrame | None = None) -> DataFrame:
        """Every event as a message: one JSON document in a binary ``value``. Some are the stream's own readings, some have no id."""
        events = self.table("events") if events is None else events
        name = F.col("event_id").cast("string")
        name = F.when(F.col("event_id") % 50 == 3, F.lit(None)).when(F.col("event_id") % 10 == 4, F.concat(F.lit("L"), name)).otherwise(name)
        fields = self._sensor_fields(events, name)
        return fields.select(F.to_json(F.struct(*fields.columns)).cast("binary").alias("value"))

    def bronze(self) -> dict[str, DataFrame]:
        return {
            "dim_plants": self.dim_plants(),
            "dim_lines": self.dim_lines(),
            "dim_sku_catalog": self.dim_sku_catalog(),
            "dim_retail_customers": self.dim_retail_customers(),
            "historical_production_batches": self.historical_production_batches(),
            "historical_shipments": self.historical_shipments(),
            "historical_quality_audit_logs": self.historical_quality_audit_logs(),
            "sensor_readings": self.sensor_readings(),
        }
