"""Consumer queries over silver and gold (the dashboards' data).

All of them aggregate first; whatever needs a global order (ranking, top-k)
only ever sees one row per plant or line, never per fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creamery.config import SOURCE_BATCH, SOURCE_STREAM
from creamery.functions.measures import count_when, safe_pct
from creamery.operators.joins import join_dim


def plant_ranking(batches: DataFrame, plants: DataFrame) -> DataFrame:
    """Plants ranked by average batch yield (1 = best; ties share a rank)."""
    per_plant = batches.groupBy("plant_id").agg(
        F.count("batch_id").alias("total_batches"),
        F.avg("yield_pct").alias("avg_yield_pct"),
    )
    named = join_dim(per_plant, plants, "plant_id", ["plant_name", "country"])
    # One row per plant: the global ordering window is bounded by the plant dimension.
    return named.withColumn("yield_rank", F.rank().over(Window.orderBy(F.col("avg_yield_pct").desc_nulls_last())))


def _kpis(df: DataFrame, area: str, measures: dict) -> DataFrame:
    """One global aggregate (partial per task, one tiny merge) -> long (kpi, value) rows."""
    wide = df.agg(*[expr.alias(name) for name, expr in measures.items()])
    pieces = ", ".join(f"'{name}', CAST(`{name}` AS DOUBLE)" for name in measures)
    return wide.selectExpr(f"stack({len(measures)}, {pieces}) AS (kpi_name, kpi_value)").select(
        F.lit(area).alias("area"), "kpi_name", "kpi_value"
    )


def exec_kpis(batches: DataFrame, shipments: DataFrame, scored_audits: DataFrame) -> DataFrame:
    """Headline numbers: yield, defects, scrap, delivery, negative audit notes."""
    production = _kpis(
        batches,
        "production",
        {
            "total_batches": F.count("batch_id"),
            "avg_yield_pct": F.avg("yield_pct"),
            "defect_rate_pct": safe_pct(F.sum("defect_units"), F.sum("actual_qty_units")),
            "scrap_rate_pct": safe_pct(count_when(F.col("batch_status") == "Scrapped"), F.count("batch_id")),
        },
    )
    delivery = _kpis(
        shipments,
        "delivery",
        {
            "total_shipments": F.count("shipment_id"),
            "on_time_rate_pct": safe_pct(count_when(F.col("shipment_status") == "Delivered"), F.count("shipment_id")),
        },
    )
    quality = _kpis(
        scored_audits,
        "quality",
        {
            "scored_audits": F.count("sentiment"),
            "negative_note_pct": safe_pct(count_when(F.col("sentiment") == "Negative"), F.count("sentiment")),
        },
    )
    return production.unionByName(delivery).unionByName(quality)


def worst_lines(production_summary: DataFrame, k: int = 10) -> DataFrame:
    """Top-k (plant, line) pairs by defect rate, then scrapped batches (a top-k report)."""
    return production_summary.select(
        "line_id", "plant_id", "plant_name", "line_name", "defect_rate_pct", "scrapped_batches", "total_batches"
    ).orderBy(
        F.col("defect_rate_pct").desc_nulls_last(),
        F.col("scrapped_batches").desc_nulls_last(),
        "line_id",
        "plant_id",
    ).limit(k)


def late_customers(retailer_360: DataFrame) -> DataFrame:
    """Customers with at least one delayed or returned shipment."""
    return retailer_360.filter((F.col("delayed_count") + F.col("returned_count")) > 0).select(
        "customer_id", "customer_name", "total_shipments", "delayed_count", "returned_count", "on_time_rate_pct"
    )


def health_by_source(readings: DataFrame) -> DataFrame:
    """Stored vs live readings side by side, one row per line (pivot on data_source).

    The pivot values are given, so Spark does not run a job to find them.
    """
    wide = readings.groupBy("line_id").pivot("data_source", [SOURCE_BATCH, SOURCE_STREAM]).agg(
        F.count("reading_id").alias("readings"),
        F.sum("anomaly_flag").cast("bigint").alias("anomalies"),
        F.avg("temperature_c").alias("avg_temperature_c"),
    )
    counts = [f"{s}_{m}" for s in (SOURCE_BATCH, SOURCE_STREAM) for m in ("readings",)]
    return wide.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in counts})


def outcome_by_sentiment(scored_audits: DataFrame) -> DataFrame:
    """Audit outcome x note sentiment counts."""
    return scored_audits.groupBy("audit_outcome", "sentiment").agg(F.count(F.lit(1)).alias("audit_count"))
