"""Live sensor path: message payload -> typed bronze rows -> append-only table.

The same parse function serves a streaming DataFrame (Kafka or a folder of
JSON-lines files) and a batch DataFrame with a ``value`` column, so the
stream's logic is tested and checked in batch as well.

There is deliberately no watermark or stateful operator here: duplicates in
the stream are removed in silver, where stored and live readings meet.
:func:`dedup_within_watermark` is an opt-in for bounded-state dedup in the
stream itself.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from creamery.config import LakeConfig
from creamery.functions.casts import to_timestamp
from creamery.operators.dedup import dedup_by_key
from creamery.operators.quality import BRONZE_RULES, apply_expectations
from creamery.schemas import SENSOR_FIELDS, SENSOR_SCHEMA
from creamery.session import scratch_dir
from creamery.sinks.tables import append_rows, file_options


def parse_sensor_payload(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON payload (binary or string) -> the nine sensor fields.

    PERMISSIVE parsing: a malformed message gives an all-NULL row (dropped
    later by the temperature rule), a wrongly typed field gives NULL in that
    field only. ``event_timestamp`` becomes a timestamp; bad text -> NULL.
    """
    parsed = raw.select(F.from_json(F.col(value_col).cast("string"), SENSOR_SCHEMA).alias("data")).select("data.*")
    return parsed.withColumn("event_timestamp", to_timestamp("event_timestamp"))


def payload_metrics() -> dict:
    """Observed per micro-batch besides the rules.

    ``malformed_payload``: messages where no field could be read (not JSON, or
    none of the expected keys). ``null_<field>``: rows where the field is
    NULL; a field that is NULL in every row of a batch usually means the
    producer renamed it, which a fixed schema would otherwise hide.
    """
    nulls = {f"null_{name}": F.count_if(F.col(name).isNull()) for name in SENSOR_FIELDS}
    all_null = None
    for name in SENSOR_FIELDS:
        all_null = F.col(name).isNull() if all_null is None else all_null & F.col(name).isNull()
    return {"malformed_payload": F.count_if(all_null), **nulls}


def fields_missing_everywhere(metrics) -> list[str]:
    """Fields that were NULL in every record of the observed batch (> 0 records).

    ``metrics``: ``Observation.get`` (a dict) or a ``Row`` from
    ``StreamingQueryProgress.observedMetrics``.
    """
    if hasattr(metrics, "asDict"):
        metrics = metrics.asDict()
    n = metrics.get("records", 0)
    return [f for f in SENSOR_FIELDS if n > 0 and metrics.get(f"null_{f}") == n]


def bronze_sensor_stream(raw: DataFrame, observation=None) -> DataFrame:
    """Parse, count ``valid_reading_id`` / ``plausible_temperature`` and payload
    health, drop implausible rows."""
    return apply_expectations(
        parse_sensor_payload(raw), BRONZE_RULES["sensor_readings_stream"], observation, payload_metrics()
    )


def dedup_within_watermark(df: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Optional: drop repeated reading_ids inside the watermark (bounded state)."""
    return df.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["reading_id"])


def kafka_sasl_options(bootstrap_servers: str, topic: str, username: str, password: str) -> dict:
    """Reader options for a SASL_SSL / PLAIN Kafka endpoint (e.g. a cloud event hub).

    Credentials are arguments (fetch them from the cluster's secret store at
    run time); nothing is embedded in code or configuration files.
    """
    quoted = [x.replace("\\", "\\\\").replace('"', '\\"') for x in (username, password)]
    jaas = (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        f'username="{quoted[0]}" password="{quoted[1]}";'
    )
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": jaas,
    }


def source_options(cfg: LakeConfig) -> dict[str, str]:
    """Reader options of the live source: replay and rate limits, then ``cfg.stream_options``, which win.

    A limit bounds one micro-batch, not the run: an ``availableNow`` run takes
    a backlog of any size in as many bounded micro-batches as it needs.
    """
    if cfg.stream_format == "kafka":
        options = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
        limits = {"maxOffsetsPerTrigger": cfg.max_offsets_per_trigger, "minPartitions": cfg.min_partitions}
    else:
        options, limits = {}, {"maxFilesPerTrigger": cfg.max_files_per_trigger}
    return options | {k: str(v) for k, v in limits.items() if v is not None} | cfg.stream_options


def read_sensor_source(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Streaming source with a ``value`` column.

    ``kafka``: replays from the earliest offset and tolerates aged-out data;
    connection and security options come from ``cfg.stream_options`` (never
    embedded here). ``text``: every line of every file under
    ``cfg.stream_path`` is one message.
    """
    reader = spark.readStream.format(cfg.stream_format).options(**source_options(cfg))
    return reader.load() if cfg.stream_format == "kafka" else reader.load(cfg.stream_path)


def checkpoint_location(spark: SparkSession, cfg: LakeConfig, name: str) -> str:
    """Stable across applications, so the next run resumes: the configured root,
    the cluster's shared folder, or a folder beside the session's tables."""
    root = cfg.checkpoint_root
    if not root:
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        root = f"{shared.rstrip('/')}/_streams"
    return f"{root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class MicroBatch:
    """One micro-batch of a run: its number, its time (as reported) and the observed counts."""

    batch_id: int
    timestamp: str
    counts: dict[str, int]


class _Progress(StreamingQueryListener):
    """Keeps the observed counts of every micro-batch, as Spark reports it when it ends."""

    def __init__(self, metrics_name: str):
        self.metrics_name = metrics_name
        self.batches: dict[str, dict[int, MicroBatch]] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = p.observedMetrics.get(self.metrics_name)
        if found is not None:
            with self.changed:
                self.batches.setdefault(str(p.runId), {})[p.batchId] = MicroBatch(p.batchId, p.timestamp, found.asDict())

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of_run(self, run_id: str, seconds: float = 60.0) -> list[MicroBatch]:
        """All micro-batches of an ended run. Its end is reported after them, so nothing comes later."""
        with self.changed:
            self.changed.wait_for(lambda: run_id in self.ended, timeout=seconds)
            found = self.batches.get(run_id, {})
            return [found[i] for i in sorted(found)]


def missing_batches(seen: Sequence[MicroBatch], last_logged: int | None = None) -> list[int]:
    """Numbers of micro-batches without a report: gaps in a run, and between it and the last one logged before it.

    A first number of 0 starts a new checkpoint, whatever was logged before.
    """
    if not seen:
        return []
    ids = {b.batch_id for b in seen}
    first = min(ids)
    start = 0 if last_logged is None or first <= last_logged else last_logged + 1
    return [i for i in range(min(start, first), max(ids)) if i not in ids]


def append_unseen(rows: DataFrame, target: str, is_path: bool, fmt: str) -> None:
    """Append to ``target`` the readings it does not hold yet, one of each (reading_id, event_timestamp).

    A replayed message carries its old event time, so only stored rows within
    the times of ``rows`` can equal it: the time range reaches the scan of the
    target and skips its other files and row groups. Rows that an interrupted
    attempt already stored are found the same way, so a retry adds the rest
    only. NULL equals NULL. ``rows`` is written once to the shared scratch
    folder first: its rules are counted once, and lineage ends there.
    """
    spark = rows.sparkSession
    staged = scratch_dir(spark, "micro-batch")
    rows.write.options(**file_options("parquet")).parquet(staged)
    rows = dedup_by_key(spark.read.schema(rows.schema).parquet(staged), ["reading_id", "event_timestamp"])
    low, high = rows.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    stored = spark.read.schema(rows.schema).format(fmt).load(target) if is_path else spark.table(target)
    near = F.col("event_timestamp").isNull()
    if low is not None:
        near |= F.col("event_timestamp").between(F.lit(low), F.lit(high))
    keys = stored.where(near).select(F.col("reading_id").alias("_id"), F.col("event_timestamp").alias("_ts"))
    new = rows.join(keys, rows["reading_id"].eqNullSafe(keys["_id"]) & rows["event_timestamp"].eqNullSafe(keys["_ts"]), "left_anti")
    if is_path:
        new.write.mode("append").format(fmt).options(**file_options(fmt)).save(target)
    else:
        append_rows(new, target)


def run_sensor_stream(
    spark: SparkSession,
    cfg: LakeConfig,
    target: str,
    to_path: bool = False,
    checkpoint: str | None = None,
    metrics_name: str = "sensor_readings_stream_dq",
    counts: dict | None = None,
    history: list[MicroBatch] | None = None,
) -> StreamingQuery:
    """Process everything available now, append it to ``target``, stop.

    The checkpoint records the consumed offsets / files, so a rerun appends
    only messages that arrived since the last run. ``target`` is a table name,
    or a path when ``to_path``; with ``cfg.stream_dedup`` it exists already
    and replayed messages are left out (``append_unseen``). ``counts``, if
    given, receives the rule and payload counts of this run, summed over all
    its micro-batches; ``history`` receives each micro-batch. Both are filled
    also when a later micro-batch fails.
    """
    rows = bronze_sensor_stream(read_sensor_source(spark, cfg), observation=metrics_name)
    place = checkpoint or checkpoint_location(spark, cfg, target.replace(".", "_").replace("/", "_"))
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", place).trigger(availableNow=True)
    progress = _Progress(metrics_name) if counts is not None or history is not None else None
    if progress is not None:
        spark.streams.addListener(progress)
    try:
        if cfg.stream_dedup:
            query = writer.foreachBatch(lambda df, _: append_unseen(df, target, to_path, cfg.table_format)).start()
        else:
            writer = writer.format(cfg.table_format).options(**file_options(cfg.table_format))
            query = writer.start(target) if to_path else writer.toTable(target)
        try:
            query.awaitTermination()
        finally:
            for batch in progress.of_run(str(query.runId)) if progress is not None else ():
                if history is not None:
                    history.append(batch)
                for name, n in batch.counts.items() if counts is not None else ():
                    counts[name] = counts.get(name, 0) + n
    finally:
        if progress is not None:
            spark.streams.removeListener(progress)
        if not to_path and spark.catalog.tableExists(target):
            spark.catalog.refreshTable(target)  # written by the query's own session
    return query
