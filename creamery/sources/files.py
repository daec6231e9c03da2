"""Raw file scans of the bronze layer.

CSV inputs are read with a header and *no* schema: every column is a string
bound by its header name, and the required columns are selected at once, so a
renamed or missing column fails the scan (AnalysisException) instead of
shifting data. Without ``inferSchema`` Spark reads only the header line up
front; the data itself is read once, by the job that uses it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creamery.config import RAW_PATHS, LakeConfig, raw_path
from creamery.schemas import REQUIRED_COLUMNS, SNAPSHOT_SCHEMA


def read_csv_table(
    spark: SparkSession, path: str, name: str, options: dict | None = None
) -> DataFrame:
    reader = spark.read.option("header", "true")
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.csv(path).select(*REQUIRED_COLUMNS[name])


def read_json_table(
    spark: SparkSession,
    path: str,
    name: str,
    schema: StructType | None = None,
    options: dict | None = None,
) -> DataFrame:
    """JSON lines; inferred types unless ``schema`` is given.

    Inference costs one extra pass over the files, and a renamed field fails
    the select. With a schema the files are read once, but a renamed field
    turns into NULLs; ``sensor_snapshot`` notices that.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.json(path).select(*REQUIRED_COLUMNS[name])


def _csv(name: str):
    def scan(spark: SparkSession, cfg: LakeConfig, options: dict | None = None) -> DataFrame:
        opts = cfg.csv_reader_options(name)
        opts.update(options or {})
        return read_csv_table(spark, raw_path(cfg, RAW_PATHS[name]), name, opts)

    scan.__name__ = name
    scan.__doc__ = f"CSV scan of ``{RAW_PATHS[name]}`` (all columns string)."
    return scan


dim_plants = _csv("dim_plants")
dim_lines = _csv("dim_lines")
dim_sku_catalog = _csv("dim_sku_catalog")
dim_retail_customers = _csv("dim_retail_customers")
historical_production_batches = _csv("historical_production_batches")
historical_shipments = _csv("historical_shipments")
historical_quality_audit_logs = _csv("historical_quality_audit_logs")


def sensor_readings(
    spark: SparkSession, cfg: LakeConfig, schema: StructType | None = None, options: dict | None = None
) -> DataFrame:
    """Every JSON-lines file of the sensor snapshot folder."""
    return read_json_table(spark, raw_path(cfg, RAW_PATHS["sensor_readings"]), "sensor_readings", schema, options)


class MissingFieldError(ValueError):
    """Fields of a declared schema that no record of the input holds."""


def sensor_snapshot(spark: SparkSession, cfg: LakeConfig, nullable: Sequence[str] = ()) -> tuple[DataFrame, Callable[[], None]]:
    """The sensor snapshot in one pass: (rows, check), typed by declaration instead of inference.

    The job that writes the rows counts the values of each field on the way
    (``observe``). ``check``, called after it, raises ``MissingFieldError`` if
    there are records but a field is NULL in all of them, as after a rename;
    fields in ``nullable`` may be. Give it to ``save_table``, which then keeps
    the old table.
    """
    rows = sensor_readings(spark, cfg, SNAPSHOT_SCHEMA)
    seen = Observation(f"sensor_snapshot_{uuid.uuid4().hex[:8]}")
    rows = rows.observe(seen, F.count(F.lit(1)).alias("records"), *[F.count(c).alias(c) for c in rows.columns])

    def check() -> None:
        counts = seen.get
        gone = [c for c in rows.columns if c not in nullable and counts["records"] and not counts[c]]
        if gone:
            raise MissingFieldError(f"sensor_readings: no record of {counts['records']} has {', '.join(gone)}")

    return rows, check


CSV_SCANS = {
    "dim_plants": dim_plants,
    "dim_lines": dim_lines,
    "dim_sku_catalog": dim_sku_catalog,
    "dim_retail_customers": dim_retail_customers,
    "historical_production_batches": historical_production_batches,
    "historical_shipments": historical_shipments,
    "historical_quality_audit_logs": historical_quality_audit_logs,
}
