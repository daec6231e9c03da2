"""Silver layer: typed, derived, deduplicated tables.

Each function takes bronze DataFrames and returns a DataFrame; reading and
writing tables is done by :mod:`creamery.plans.layers`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamery.config import SOURCE_BATCH, SOURCE_STREAM
from creamery.functions.casts import to_int
from creamery.functions.measures import yield_pct
from creamery.operators.dedup import dedup_by_key
from creamery.operators.harmonise import harmonise_sensor, union_sources


def silver_dim_plants(dim_plants: DataFrame) -> DataFrame:
    typed = dim_plants.withColumns(
        {
            "capacity_liters_day": to_int("capacity_liters_day"),
            "opened_year": to_int("opened_year"),
        }
    )
    return dedup_by_key(typed, ["plant_id"])


def silver_dim_lines(dim_lines: DataFrame) -> DataFrame:
    return dedup_by_key(dim_lines, ["line_id"])


def silver_dim_sku_catalog(dim_sku_catalog: DataFrame) -> DataFrame:
    return dedup_by_key(dim_sku_catalog, ["sku_id"])


def silver_dim_retail_customers(dim_retail_customers: DataFrame) -> DataFrame:
    return dedup_by_key(dim_retail_customers, ["customer_id"])


def fact_production_batches(batches: DataFrame) -> DataFrame:
    """Int casts, ``yield_pct``; per batch_id the latest production_start wins."""
    typed = batches.withColumns(
        {
            "planned_qty_units": to_int("planned_qty_units"),
            "actual_qty_units": to_int("actual_qty_units"),
            "defect_units": to_int("defect_units"),
        }
    )
    # the yield follows from two columns of the tie-break, so it need not travel with the rows
    return dedup_by_key(
        typed,
        ["batch_id"],
        order=[F.col("production_start").desc_nulls_last()],
        order_columns=["production_start"],
    ).withColumn("yield_pct", yield_pct("actual_qty_units", "defect_units"))


def fact_shipments(shipments: DataFrame) -> DataFrame:
    typed = shipments.withColumn("qty_units", to_int("qty_units"))
    return dedup_by_key(
        typed,
        ["shipment_id"],
        order=[F.col("ship_date").desc_nulls_last()],
        order_columns=["ship_date"],
    )


def fact_quality_audits(audits: DataFrame, dedup: Callable[..., DataFrame] = dedup_by_key) -> DataFrame:
    """Per audit_id the latest audit_date wins; ``dedup_long_rows`` for audits that are stored, as their notes are long."""
    return dedup(
        audits,
        ["audit_id"],
        order=[F.col("audit_date").desc_nulls_last()],
        order_columns=["audit_date"],
    )


def surviving_readings(readings: DataFrame) -> DataFrame:
    """One row per reading_id: the stored (``batch_file``) copy before a live one, then the latest event_timestamp.

    A total order decides, so survivors of parts can be merged the same way.
    """
    return dedup_by_key(
        readings,
        ["reading_id"],
        order=[
            F.when(F.col("data_source") == SOURCE_BATCH, 0).otherwise(1).asc(),
            F.col("event_timestamp").desc_nulls_last(),
        ],
        order_columns=["data_source", "event_timestamp"],
    )


def fact_sensor_readings(snapshot: DataFrame, stream: DataFrame) -> DataFrame:
    """Stored snapshot and live readings in one table, one row per reading_id (see ``surviving_readings``)."""
    return surviving_readings(
        union_sources(
            harmonise_sensor(snapshot, SOURCE_BATCH),
            harmonise_sensor(stream, SOURCE_STREAM),
        )
    )
