"""Structured Streaming ingestion of live sensor readings."""

from creamery.streaming.sensor import (
    bronze_sensor_stream,
    dedup_within_watermark,
    parse_sensor_payload,
    read_sensor_source,
    run_sensor_stream,
)

__all__ = [
    "parse_sensor_payload", "bronze_sensor_stream", "dedup_within_watermark",
    "read_sensor_source", "run_sensor_stream",
]
