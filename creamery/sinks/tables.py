"""Table sinks: atomic full refresh, create-if-missing, append, locks.

Writing a layer to a table is also what cuts lineage between layers: the next
layer plans against stored files, not against the previous layer's plan, and
a lost executor only re-runs the stage it was in.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from creamery.session import scratch_dir

# File formats: their tables are a folder of files, which Spark can also store
# bucketed. Table formats such as Delta or Iceberg replace a table in one
# transaction and use their own clustering instead.
FILE_FORMATS = ("parquet", "orc", "json", "csv")

# Fixed value: codec of the formats below. Long texts and string columns take
# about two thirds of the bytes of Spark's default (snappy).
COMPRESSION = {"parquet": "zstd", "orc": "zstd"}

# Fixed value: Spark's default of spark.sql.sources.bucketing.maxBuckets.
MAX_BUCKETS = 100_000

# Table property that names the folder of the version before the current one.
PREVIOUS = "creamery.previous_version"


def ensure_database(spark: SparkSession, qualified_name: str) -> None:
    if "." in qualified_name:
        db = qualified_name.rsplit(".", 1)[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def file_system(spark: SparkSession, path: str):
    """(file system, path object) of ``path``, as Spark itself reaches it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def file_options(fmt: str) -> dict[str, str]:
    """Writer options of a format's files."""
    return {"compression": COMPRESSION[fmt]} if fmt in COMPRESSION else {}


def stored_rows(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: lineage ends here."""
    spark, place = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    df.write.options(**file_options("parquet")).parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """The detail rows of DESCRIBE TABLE EXTENDED (location, type, provider, buckets)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    at = next(i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed Table"))
    return {r["col_name"]: r["data_type"] for r in rows[at + 1 :]}


def table_location(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"].rstrip("/")


def _layout(spark: SparkSession, name: str, details: dict[str, str]) -> tuple:
    """What a table's files must agree with: columns, partitioning, format, buckets."""
    columns = tuple((c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(name))
    return columns, details.get("Provider"), details.get("Num Buckets"), details.get("Bucket Columns")


def _swap(spark: SparkSession, name: str, staged: str) -> None:
    """Let ``name`` stand for the files of the table ``staged``, which goes.

    One catalog call does it: the table's location is set, or, for a new
    table, the staged one renamed. Only when columns or buckets changed is the
    old table renamed out of the way first.
    """
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        return
    old, new = _described(spark, name), _described(spark, staged)
    if old["Type"] == "EXTERNAL" and _layout(spark, name, old) == _layout(spark, staged, new):
        before = spark.sql(f"SHOW TBLPROPERTIES {name}").where(f"key = '{PREVIOUS}'").first()
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new['Location']}'")
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)
        spark.sql(f"DROP TABLE {staged}")  # external: its files stay
        # running readers may still use the version just replaced; the one before it goes
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{old['Location']}')")
        if before is not None and before["value"] not in (old["Location"], new["Location"]):
            delete_path(spark, before["value"])
        return
    aside = f"{name}__old_{uuid.uuid4().hex[:8]}"
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {aside}")


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    path: str | None = None,
    partition_by: list[str] | None = None,
    bucket_by: list[str] | None = None,
    buckets: int | None = None,
    check: Callable[[], None] | None = None,
) -> None:
    """Full refresh: replace the table's content with ``df`` (materialized view), all or nothing.

    The rows are written to a new folder below ``path`` (default: beside the
    database's tables); then ``check``, if given, may raise; then the table
    is pointed at that folder. Until this last step, and if anything fails
    before it, the table holds its old rows, so a driver lost in the middle
    harms no reader. The version before is kept for readers that still run.

    ``bucket_by`` stores the table hash-bucketed on a key, so later joins and
    aggregations on that key read it without a shuffle. The bucket count
    defaults to ``spark.sql.shuffle.partitions``, up to the most that Spark
    allows; rows are dealt by bucket first, so each bucket is one file. Only
    bucket on keys without heavy skew, since a bucket is read by one task.
    """
    spark = df.sparkSession
    ensure_database(spark, name)
    bucketed = bool(bucket_by) and fmt in FILE_FORMATS
    if bucketed:
        n = buckets or min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
        df = df.repartition(n, *bucket_by)
    writer = df.write.format(fmt).options(**file_options(fmt))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucketed:
        writer = writer.bucketBy(n, *bucket_by)
    if fmt not in FILE_FORMATS:
        if path:
            writer = writer.option("path", path)
        writer.mode("overwrite").saveAsTable(name)
        if check is not None:
            check()
        return
    db, table = name.rsplit(".", 1) if "." in name else (spark.catalog.currentDatabase(), name)
    tag = uuid.uuid4().hex[:12]
    home = path or f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}__versions"
    version, staged = f"{home.rstrip('/')}/{tag}", f"{db}.{table}__staged_{tag}"
    try:
        writer.option("path", version).saveAsTable(staged)
        if check is not None:
            check()
        _swap(spark, f"{db}.{table}", staged)
    except Exception:
        if spark.catalog.tableExists(staged):
            spark.sql(f"DROP TABLE {staged}")
            delete_path(spark, version)
        raise


def create_table_if_missing(
    spark: SparkSession, name: str, columns_ddl: str, fmt: str = "parquet", location: str | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Idempotent target creation with a fixed schema."""
    ensure_database(spark, name)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    where = f" LOCATION '{location}'" if location else ""
    options = ", ".join(f"'{k}' '{v}'" for k, v in file_options(fmt).items())
    options = f" OPTIONS ({options})" if options else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING {fmt}{options}{parts}{where}")


def append_rows(df: DataFrame, name: str) -> None:
    """Append ``df`` to an existing table, matching columns by name."""
    target_cols = df.sparkSession.table(name).columns
    df.select(*target_cols).write.insertInto(name)


def replace_partitions(df: DataFrame, name: str, partition: str, values: list) -> None:
    """Replace the partitions ``values`` of the file table ``name`` with the rows of ``df``, and no other.

    ``df`` must not read the table itself (store it first). Partitions among
    ``values`` that have no row in ``df`` are removed.
    """
    spark = df.sparkSession
    details = _described(spark, name)
    place, fmt = details["Location"].rstrip("/"), details["Provider"]
    left = {r[0] for r in df.select(partition).distinct().collect()}  # at most as many as ``values``
    df.write.format(fmt).options(**file_options(fmt)).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).save(place)
    spec = lambda v: f"PARTITION ({partition} = " + ("NULL" if v is None else f"'{v}'") + ")"
    added = [spec(v) for v in values if v in left]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added)}")
    for value in values:
        if value not in left:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec(value)}")
            delete_path(spark, f"{place}/{partition}=" + ("__HIVE_DEFAULT_PARTITION__" if value is None else str(value)))
    spark.catalog.refreshTable(name)


_HELD: dict[str, threading.Lock] = {}
_HELD_GUARD = threading.Lock()


@contextmanager
def path_lock(spark: SparkSession, path: str, owner: str, wait_s: float = 600.0, lease_s: float = 3600.0) -> Iterator[None]:
    """Hold the lock file ``path``, which only one driver can create at a time.

    A lock older than ``lease_s`` belongs to a lost driver and is taken over.
    Needs a file system whose create without overwrite is atomic; within one
    driver a thread lock stands before the file.
    """
    with _HELD_GUARD:
        local = _HELD.setdefault(path, threading.Lock())
    end = time.monotonic() + wait_s
    if not local.acquire(timeout=wait_s):
        raise TimeoutError(f"{path} is locked")
    try:
        fs, p = file_system(spark, path)
        while True:
            try:
                out = fs.create(p, False)
                out.write(bytearray(owner.encode()))
                out.close()
                break
            except Py4JJavaError as exc:
                if "AlreadyExists" not in exc.java_exception.getClass().getName():
                    raise
                if fs.exists(p) and time.time() * 1000 - fs.getFileStatus(p).getModificationTime() > lease_s * 1000:
                    fs.delete(p, False)
                elif time.monotonic() > end:
                    raise TimeoutError(f"{path} is locked") from None
                else:
                    time.sleep(0.2)
        try:
            yield
        finally:
            fs.delete(p, False)
    finally:
        local.release()
