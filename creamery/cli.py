"""Run the medallion layers from the command line.

    python -m creamery.cli --base-path s3a://lake/raw --layers bronze,silver,gold,sentiment
    python -m creamery.cli --base-path ... --layers stream --stream-format kafka \
        --stream-option kafka.bootstrap.servers=host:9093 --stream-option subscribe=sensors

Uses the active session (``spark-submit`` configures the cluster). Options that
hold credentials belong into a file (``--stream-options-file``, lines of
key=value, any path Spark can read) rather than on the command line, where
other users of the machine can see them.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from creamery.config import LakeConfig
from creamery.plans import layers
from creamery.plans.sentiment import run_sentiment

LAYERS = ("bronze", "stream", "silver", "gold", "sentiment", "consumer")


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="creamery")
    p.add_argument("--base-path", required=True, help="landing root of the raw files")
    p.add_argument("--layers", default="bronze,silver,gold,sentiment,consumer", help=f"comma list of {LAYERS}")
    p.add_argument("--bronze-db", default="bronze")
    p.add_argument("--silver-db", default="silver")
    p.add_argument("--gold-db", default="gold")
    p.add_argument("--format", default="parquet", help="table format")
    p.add_argument("--stream-format", default="kafka")
    p.add_argument("--stream-path", default=None)
    p.add_argument("--stream-option", action="append", default=[], help="key=value, repeatable")
    p.add_argument("--stream-options-file", default=None, help="file of key=value lines; --stream-option wins")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None)
    p.add_argument("--min-partitions", type=int, default=None)
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--stream-dedup", action="store_true", help="leave out messages the live table already holds")
    p.add_argument("--checkpoint-root", default=None, help="folder of the stream checkpoints")
    p.add_argument("--db-root", default=None, help="storage root of the three databases")
    p.add_argument("--bucket-count", type=int, default=None, help="buckets of the silver batch fact")
    p.add_argument("--record-separator", action="append", default=[], help="input=separator of CSV records, e.g. historical_quality_audit_logs=\\x1e")
    return p.parse_args(argv)


def _pairs(items) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def stream_options(spark: SparkSession, args) -> dict[str, str]:
    """Options of the file (blank lines and lines that start with # left out), then those of the command line."""
    lines = []
    if args.stream_options_file:
        # a handful of settings, read on the driver
        lines = [r["value"].strip() for r in spark.read.text(args.stream_options_file).collect()]
    return _pairs(x for x in lines if x and not x.startswith("#")) | _pairs(args.stream_option)


def main(argv=None) -> None:
    args = parse_args(argv)
    wanted = [x for x in args.layers.split(",") if x]
    unknown = set(wanted) - set(LAYERS)
    if unknown:
        raise SystemExit(f"unknown layers: {sorted(unknown)}")
    spark = SparkSession.builder.appName("creamery").getOrCreate()
    cfg = LakeConfig(
        base_path=args.base_path, bronze_db=args.bronze_db, silver_db=args.silver_db, gold_db=args.gold_db,
        table_format=args.format, stream_format=args.stream_format, stream_path=args.stream_path,
        stream_options=stream_options(spark, args), max_offsets_per_trigger=args.max_offsets_per_trigger,
        min_partitions=args.min_partitions, max_files_per_trigger=args.max_files_per_trigger, stream_dedup=args.stream_dedup,
        checkpoint_root=args.checkpoint_root, db_root=args.db_root, bucket_count=args.bucket_count,
        csv_record_separators={k: v.encode().decode("unicode_escape") for k, v in _pairs(args.record_separator).items()},
    )
    if "bronze" in wanted:
        for name, obs in layers.run_bronze(spark, cfg).items():
            print(f"expectations {name}: {obs.get}")
    if "stream" in wanted:
        print(f"expectations {layers.STREAM_TABLE}: {layers.run_stream(spark, cfg)}")
    if "silver" in wanted:
        layers.run_silver(spark, cfg)
    if "gold" in wanted:
        layers.run_gold(spark, cfg)
    if "sentiment" in wanted:
        run_sentiment(spark, cfg)
    if "consumer" in wanted:
        layers.run_consumer(spark, cfg)


if __name__ == "__main__":
    main()
