"""Names, paths and formats for one medallion deployment.

Everything environment-specific lives in one frozen dataclass that is passed
explicitly; nothing is read from the environment or created at import time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Relative locations of the raw inputs under the landing root.
RAW_PATHS = {
    "dim_plants": "dim/dim_plants.csv",
    "dim_lines": "dim/dim_lines.csv",
    "dim_sku_catalog": "dim/dim_sku_catalog.csv",
    "dim_retail_customers": "dim/dim_retail_customers.csv",
    "historical_production_batches": "historical/historical_production_batches.csv",
    "historical_shipments": "historical/historical_shipments.csv",
    "historical_quality_audit_logs": "historical/historical_quality_audit_logs.csv",
    "sensor_readings": "streaming/",
}

# Tags written to fact_sensor_readings.data_source.
SOURCE_BATCH = "batch_file"
SOURCE_STREAM = "eventhub_stream"


@dataclass(frozen=True)
class LakeConfig:
    """Where the raw files are and where the three layers are stored.

    ``base_path`` is any Hadoop-compatible URI (``s3a://``, ``abfss://``,
    ``hdfs://``, ``file:/``); :func:`raw_path` joins it with a relative path.
    """

    base_path: str = ""
    bronze_db: str = "bronze"
    silver_db: str = "silver"
    gold_db: str = "gold"
    table_format: str = "parquet"
    # Options for the live sensor source; ``format`` is "kafka" on a cluster
    # with the connector, or "text" for a directory of JSON lines.
    stream_format: str = "kafka"
    stream_options: dict = field(default_factory=dict)
    stream_path: str | None = None
    # Limits of one micro-batch, so that a large backlog is taken in several
    # bounded ones: Kafka offsets, and the tasks that read them; files.
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    max_files_per_trigger: int | None = None
    # Whether the live table leaves out messages it already holds (same
    # reading_id and event time), as a replay from the earliest offset sends.
    stream_dedup: bool = False
    # Where streaming checkpoints go; defaults to <spark.checkpoint.dir>/streams.
    checkpoint_root: str | None = None
    # Optional storage root for the three databases (CREATE DATABASE ... LOCATION).
    db_root: str | None = None
    # Independent tables of one layer are written by this many concurrent Spark
    # jobs, so small tables (dimensions) do not leave the cluster idle.
    concurrent_writes: int = 4
    # Buckets of the bucketed silver batch fact; None = spark.sql.shuffle.partitions.
    # Size it to the fact (e.g. fact bytes / 256 MB), not to the whole input.
    bucket_count: int | None = None
    # Fields of the sensor snapshot that may be NULL in every record.
    snapshot_nullable: tuple = ()
    # Extra CSV reader options per bronze input. Quotes are escaped by doubling
    # (RFC 4180, as spreadsheet and pandas writers do); free-text notes may
    # span lines, which makes those files unsplittable, so it is per table.
    csv_options: dict = field(
        default_factory=lambda: {
            "*": {"escape": '"'},
            "historical_quality_audit_logs": {"escape": '"', "multiLine": "true"},
        }
    )
    # Record separator (one character) of CSV inputs whose writer uses another
    # one than the line break, by input. Their quoted notes may span lines, and
    # still such a file is split over tasks, as no ``multiLine`` is needed.
    csv_record_separators: dict = field(default_factory=dict)

    def database(self, layer: str) -> str:
        return {"bronze": self.bronze_db, "silver": self.silver_db, "gold": self.gold_db}[layer]

    def csv_reader_options(self, name: str) -> dict:
        options = dict(self.csv_options.get(name, self.csv_options.get("*", {})))
        if name in self.csv_record_separators:
            options.pop("multiLine", None)
            options["lineSep"] = self.csv_record_separators[name]
        return options

    def table(self, layer: str, name: str) -> str:
        db = {"bronze": self.bronze_db, "silver": self.silver_db, "gold": self.gold_db}[layer]
        return f"{db}.{name}"


def raw_path(cfg: LakeConfig, relative_path: str) -> str:
    """Join the landing root and a relative path (leading '/' is ignored)."""
    rel = relative_path.lstrip("/")
    if not cfg.base_path:
        return rel
    return cfg.base_path.rstrip("/") + "/" + rel
