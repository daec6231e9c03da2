"""Sinks: catalog tables (batch) and the streaming writer lives in creamery.streaming."""

from creamery.sinks.tables import append_rows, create_table_if_missing, ensure_database, save_table

__all__ = ["save_table", "create_table_if_missing", "append_rows", "ensure_database"]
