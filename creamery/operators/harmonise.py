"""Bring sensor readings from different sources to one typed shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamery.functions.casts import to_double, to_int, to_timestamp
from creamery.schemas import SENSOR_COLS


def harmonise_sensor(df: DataFrame, source_tag: str) -> DataFrame:
    """Tolerant casts, a constant ``data_source`` tag, fixed column order.

    One projection (``withColumns``); a field missing from the input raises
    an AnalysisException instead of silently becoming NULL.
    """
    return df.withColumns(
        {
            "event_timestamp": to_timestamp("event_timestamp"),
            "temperature_c": to_double("temperature_c"),
            "pressure_bar": to_double("pressure_bar"),
            "fill_volume_ml": to_double("fill_volume_ml"),
            "vibration_mm_s": to_double("vibration_mm_s"),
            "anomaly_flag": to_int("anomaly_flag"),
            "data_source": F.lit(source_tag),
        }
    ).select(*SENSOR_COLS)


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """By-name bag union; a column missing on one side becomes NULL there."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
