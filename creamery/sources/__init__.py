"""Scans: raw files (CSV / JSON), and the shared test tables."""

from creamery.sources.driver_tables import DriverTables
from creamery.sources.files import CSV_SCANS, read_csv_table, read_json_table, sensor_readings

__all__ = [
    "DriverTables", "CSV_SCANS",
    "read_csv_table", "read_json_table", "sensor_readings",
]
