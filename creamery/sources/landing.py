"""Raw landing files written from the shared test tables.

Used to exercise the file scans, the stream source and the full layer run on
real files: CSV with a header for the seven tabular inputs, JSON lines for the
sensor snapshot, and text files of JSON messages for the live stream. All
writes are distributed Spark writes into a folder below the shared root.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from creamery.config import RAW_PATHS
from creamery.sources.driver_tables import DriverTables
from creamery.sources.files import CSV_SCANS

# Fixed value: a compressed text file is read by one task, so none holds more rows than this.
RECORDS_PER_FILE = 200_000


def _codec(compression: str | None) -> dict[str, str]:
    return {"compression": compression, "maxRecordsPerFile": str(RECORDS_PER_FILE)} if compression else {}


def write_csv_input(t: DriverTables, name: str, root: str, separator: str | None = None, compression: str | None = None) -> str:
    """CSV with a header; values keep their outer spaces; ``separator``, if given, ends the records; ``compression`` as the writer names it."""
    path = f"{root.rstrip('/')}/{RAW_PATHS[name]}"
    writer = getattr(t, name)().write.mode("overwrite").option("header", "true").option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    if separator is not None:
        writer = writer.option("lineSep", separator)
    writer.options(**_codec(compression)).csv(path)
    return path


def write_landing(
    t: DriverTables, root: str, concurrent_writes: int = 4, separators: dict | None = None, compression: str | None = None
) -> None:
    """Every raw input of the bronze layer below ``root`` (independent writes run concurrently)."""
    from creamery.plans.layers import run_concurrently

    tasks = [lambda n=name: write_csv_input(t, n, root, (separators or {}).get(n), compression) for name in CSV_SCANS]
    tasks.append(
        lambda: t.sensor_readings().write.mode("overwrite").options(**_codec(compression)).json(f"{root.rstrip('/')}/{RAW_PATHS['sensor_readings']}")
    )
    run_concurrently(tasks, concurrent_writes)


def write_payload_files(t: DriverTables, path: str, files: int | None = None, compression: str | None = None) -> None:
    """Append one batch of message files (one JSON message per line) for the text stream source."""
    messages = t.sensor_payloads().select(F.col("value").cast("string").alias("value"))
    if files is not None:
        messages = messages.repartition(files)
    messages.write.mode("append").options(**_codec(compression)).text(path)
