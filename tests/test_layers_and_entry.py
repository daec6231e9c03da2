import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from creamery.config import LakeConfig
from creamery.plans.layers import run_all
from creamery.queries import QUERIES
from creamery.sources.driver_tables import DriverTables
from creamery.sources.landing import write_landing, write_payload_files

sys.path.insert(0, ROOT)
import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_full_layer_run_over_files(spark, tmp_dir):
    t = DriverTables(spark, SF_SMALL)
    write_landing(t, f"{tmp_dir}/raw")
    write_payload_files(t, f"{tmp_dir}/messages")
    cfg = LakeConfig(
        base_path=f"{tmp_dir}/raw", bronze_db="tb", silver_db="ts", gold_db="tg", db_root=f"{tmp_dir}/db",
        stream_format="text", stream_path=f"{tmp_dir}/messages", checkpoint_root=f"{tmp_dir}/ckpt",
    )
    obs = run_all(spark, cfg, with_stream=True)
    assert obs["historical_production_batches"].get["valid_batch_id"] == t.historical_production_batches().where("batch_id IS NULL").count() > 0
    log = {(r.table_name, r.rule_name): (r.total_records, r.failed_records) for r in spark.table("tb.expectations_log").collect()}
    assert log[("dim_plants", "valid_plant_id")] == (33, 3)
    for name in ("d_production_summary", "d_retailer_360", "d_quality_audit_summary", "d_sensor_health_summary"):
        table = spark.table(cfg.table("gold", name))
        means = {c: F.round(c, 6) for c, kind in table.dtypes if kind == "double" and "avg_" in c}
        stored = sorted(map(str, table.withColumns(means).collect()))
        direct = sorted(map(str, QUERIES[name](spark, SF_SMALL).select(*spark.table(cfg.table("gold", name)).columns).collect()))
        assert stored == direct, name
    assert spark.table(cfg.table("gold", "d_audit_sentiment")).count() == spark.table(cfg.table("silver", "fact_quality_audits")).count()
    for name in ("cq_health_by_source", "cq_late_customers", "cq_worst_lines", "cq_plant_ranking"):
        table = spark.table(cfg.table("gold", name))
        means = {c: F.round(c, 6) for c, kind in table.dtypes if kind == "double" and "avg_" in c}
        stored = sorted(map(str, table.withColumns(means).collect()))
        direct = sorted(map(str, QUERIES[name](spark, SF_SMALL).select(*spark.table(cfg.table("gold", name)).columns).collect()))
        assert stored == direct, name
    bucket_spec = spark.sql(f"DESCRIBE TABLE EXTENDED {cfg.table('silver', 'fact_production_batches')}").collect()
    assert any(r.col_name == "Bucket Columns" and "batch_id" in r.data_type for r in bucket_spec)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(o_cols, res.fetchall())


def test_cli_runs_layers(spark, tmp_dir):
    from creamery import cli

    t = DriverTables(spark, SF_SMALL)
    write_landing(t, f"{tmp_dir}/raw")
    cli.main(["--base-path", f"{tmp_dir}/raw", "--layers", "bronze,silver,gold",
              "--bronze-db", "cli_b", "--silver-db", "cli_s", "--gold-db", "cli_g"])
    assert spark.table("cli_g.d_production_summary").count() == QUERIES["d_production_summary"](spark, SF_SMALL).count()
    with pytest.raises(SystemExit):
        cli.main(["--base-path", "x", "--layers", "bronze,nope"])
