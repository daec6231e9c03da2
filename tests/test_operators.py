from pyspark.sql import Observation
from pyspark.sql import functions as F

from creamery.operators import (
    PLAUSIBLE_TEMPERATURE,
    VALID_READING_ID,
    Expectation,
    anti_join_null_safe,
    apply_expectations,
    dedup_by_key,
    expectations_report,
)


def test_dedup_removes_duplicates_keeps_distinct(spark):
    df = spark.createDataFrame([("R1", 1.0), ("R1", 1.0), ("R2", 2.0)], "reading_id string, v double")
    assert dedup_by_key(df, ["reading_id"]).count() == 2


def test_dedup_survivor_is_deterministic(spark):
    rows = [("K", f"2024-01-0{d}", x) for d in (1, 3, 2) for x in ("b", "a")] + [(None, "2024-01-01", "z"), (None, "2024-01-02", "y")]
    df = spark.createDataFrame(rows, "k string, day string, x string")
    order = [F.col("day").desc_nulls_last()]
    key = lambda r: tuple(str(x) for x in r)
    expected = sorted((tuple(r) for r in dedup_by_key(df, ["k"], order, ["day"]).collect()), key=key)
    for seed in range(3):
        shuffled = df.repartition(4).orderBy(F.rand(seed))
        got = sorted((tuple(r) for r in dedup_by_key(shuffled, ["k"], order, ["day"]).collect()), key=key)
        assert got == expected
    # Latest day wins, then the smallest remaining column; NULL keys collapse to one row.
    assert ("K", "2024-01-03", "a") in expected
    assert [r for r in expected if r[0] is None] == [(None, "2024-01-02", "y")]


def test_dedup_plans_partial_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_drop_rule_keeps_only_plausible_temperatures(spark):
    df = spark.createDataFrame([("R1", 25.0), ("R2", 999.0), ("R3", -50.0), ("R4", None)], "reading_id string, temperature_c double")
    out = apply_expectations(df, [PLAUSIBLE_TEMPERATURE])
    assert [r.temperature_c for r in out.collect()] == [25.0]


def test_warn_rule_keeps_rows_and_counts(spark):
    df = spark.createDataFrame([("R1", 25.0), (None, 30.0), (None, 500.0)], "reading_id string, temperature_c double")
    obs = Observation("dq")
    out = apply_expectations(df, [VALID_READING_ID, PLAUSIBLE_TEMPERATURE], obs)
    assert out.count() == 2
    assert obs.get == {"records": 3, "valid_reading_id": 2, "plausible_temperature": 1}


def test_expectations_report(spark):
    df = spark.createDataFrame([("P1",), (None,), ("P3",)], "plant_id string")
    rows = expectations_report(df, "dim_plants", [Expectation("valid_plant_id", "plant_id IS NOT NULL")]).collect()
    assert [tuple(r) for r in rows] == [("dim_plants", "valid_plant_id", "warn", 3, 1, 2)]


def test_unknown_action_rejected():
    import pytest

    with pytest.raises(ValueError):
        Expectation("x", "true", "explode")


def test_anti_join_is_null_safe(spark):
    left = spark.createDataFrame([("A1",), ("A2",), (None,)], "audit_id string")
    right = spark.createDataFrame([("A1",), (None,)], "audit_id string")
    assert [r.audit_id for r in anti_join_null_safe(left, right, "audit_id").collect()] == ["A2"]


def test_join_dim_runs_no_job(spark):
    from creamery.operators.joins import join_dim

    dim = spark.createDataFrame([("ab", 1), ("c", 2)], "k string, v int")
    fact = spark.createDataFrame([("ab", 5.0), ("zz", 1.0)], "k string, x double")
    spark.sparkContext.setJobGroup("building", "")
    joined = join_dim(fact, dim, "k", ["v"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == 0
    assert [tuple(r) for r in joined.collect()] == [("ab", 5.0, 1)]


def test_dedup_of_long_rows_equals_the_ranking_of_all(spark):
    from creamery.operators.dedup import dedup_long_rows

    data = [("a", "2", "x"), ("a", "3", "z"), ("a", "3", "y"), ("b", "1", "q"), (None, "1", "n"), (None, None, "m"), ("c", None, None), ("d", "1", "s"), ("d", "1", "s")]
    df = spark.createDataFrame(data, "k string, d string, note string")
    how = {"keys": ["k"], "order": [F.col("d").desc_nulls_last()], "order_columns": ["d"]}
    want = sorted(map(tuple, dedup_by_key(df, **how).collect()), key=repr)
    assert want == sorted([("a", "3", "y"), ("b", "1", "q"), (None, "1", "n"), ("c", None, None), ("d", "1", "s")], key=repr)
    for most in (0, 2, 100):
        assert sorted(map(tuple, dedup_long_rows(df, **how, most=most).collect()), key=repr) == want
    assert dedup_long_rows(df.limit(0), **how).collect() == []
