"""Session construction and the shared working folder.

Jobs never write to a machine-local temp folder on a cluster: scratch output
(stream checkpoints, CSV/JSON landing copies, lineage cuts) goes below the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting
is absent (local runs, tests) is a local temp folder created and registered.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    master: str = "local[*]",
    app_name: str = "creamery",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
    driver_memory: str = "8g",
) -> SparkSession:
    """A session for tests and the local bench: AQE on, UI off, UTC clock."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
    )
    extra = dict(extra or {})
    scratch = tempfile.mkdtemp(prefix="creamery-local-")
    if "spark.sql.warehouse.dir" not in extra:
        builder = builder.config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Keep a checkpoint folder named by the environment (spark-defaults, --conf);
    # only a bare local session gets its own.
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide scratch folder (``spark.checkpoint.dir``).

    Falls back to a fresh local folder only when the session has none, and
    registers it so later calls and ``DataFrame.checkpoint`` agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="creamery-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique sub-folder of the shared root for one run."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20, broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Spark settings sized for reading ``input_bytes`` of data (pass to ``spark-submit --conf``).

    One scan split and one initial shuffle partition per ``partition_bytes``
    (AQE then coalesces small shuffles towards the same size), skew splitting
    for partitions four times larger than that, and the broadcast limit
    that AQE holds joins against. For 100 TB this gives ~373k
    initial partitions of 256 MB, i.e. tasks that fit comfortably in executor
    memory.
    """
    parts = max(200, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }
