"""Measure how a hot key (a third of all rows) reaches the reducers.

Runs the deterministic dedup and the audit summary on inputs where one key
holds a third of the rows, with Spark's event log written to a fresh scratch
folder, and prints the largest number of shuffle records any single task read.
For comparison the dedup also runs with the partial window limit disabled.

Usage: python scripts/skew_check.py [rows]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from creamery.operators.dedup import dedup_by_key  # noqa: E402
from creamery.plans.gold import d_quality_audit_summary  # noqa: E402
from creamery.session import local_session  # noqa: E402


def read_events(log_dir: str) -> list[dict]:
    import zstandard

    events = []
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/local-*"):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        events += [json.loads(line) for line in raw.decode().splitlines() if line.strip()]
    return events


def max_task_shuffle_records(events: list[dict], job_group: str) -> tuple[int, int]:
    """(largest shuffle-read record count of one task, total) for jobs in ``job_group``."""
    stages = set()
    for e in events:
        if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == job_group:
            stages.update(e["Stage IDs"])
    per_task = []
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
            read = e.get("Task Metrics", {}).get("Shuffle Read Metrics", {})
            per_task.append(read.get("Total Records Read", 0))
    return (max(per_task) if per_task else 0, sum(per_task))


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 300_000
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = local_session(
        master="local[8]",
        shuffle_partitions=8,
        # Coalescing would merge small reducers into one task and hide where the hot key lands.
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
               "spark.eventLog.compress": "false",
               "spark.sql.adaptive.coalescePartitions.enabled": "false"},
    )
    sc = spark.sparkContext
    base = spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 97).alias("v"),
    )

    sc.setJobGroup("dedup", "dedup with partial limit")
    dedup_by_key(base, ["k"]).write.format("noop").mode("overwrite").save()

    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    sc.setJobGroup("dedup_no_partial", "dedup without partial limit")
    dedup_by_key(base, ["k"]).write.format("noop").mode("overwrite").save()
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")

    audits = base.select(
        F.concat(F.lit("A"), F.monotonically_increasing_id().cast("string")).alias("audit_id"),
        F.col("k").alias("batch_id"),
        F.when(F.col("v") % 2 == 0, "Pass").otherwise("Fail").alias("audit_outcome"),
    )
    batches = spark.range(rows).select(
        F.when(F.col("id") == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("batch_id"),
        (F.col("id") % 4).cast("string").alias("plant_id"),
    )
    plants = spark.createDataFrame([(str(i), f"P{i}") for i in range(4)], "plant_id string, plant_name string")
    sc.setJobGroup("audit_summary", "audit summary with a hot batch")
    d_quality_audit_summary(audits, batches, plants).write.format("noop").mode("overwrite").save()

    spark.stop()
    events = read_events(log_dir)
    hot = rows // 3
    for group in ("dedup", "dedup_no_partial", "audit_summary"):
        peak, total = max_task_shuffle_records(events, group)
        print(f"{group:18s} hot-key rows={hot:8d}  max shuffle records read by one task={peak:8d}  total={total}")


if __name__ == "__main__":
    main()
