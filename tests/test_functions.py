import datetime as dt

from pyspark.sql import functions as F

from creamery.functions import (
    DEFAULT_RULES,
    Rule,
    model_scorer,
    rules_scorer,
    safe_pct,
    to_double,
    to_int,
    to_timestamp,
    with_sentiment,
    yield_pct,
)


def test_to_int_is_tolerant(spark):
    df = spark.createDataFrame([("23",), ("23.0",), ("23.9",), ("-5.5",), ("abc",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(to_int("s")).collect()]
    assert got == [23, 23, 23, -5, None, None, None]


def test_to_double_and_timestamp(spark):
    df = spark.createDataFrame([("2026-07-30T10:00:00", "1.5"), ("not-a-date", "x")], "t string, d string")
    rows = df.select(to_timestamp("t").alias("t"), to_double("d").alias("d")).collect()
    assert rows[0].t == dt.datetime(2026, 7, 30, 10, 0, 0)
    assert rows[0].d == 1.5
    assert rows[1].t is None and rows[1].d is None


def test_safe_pct(spark):
    df = spark.createDataFrame([(1, 4), (0, 0), (None, 5), (3, None), (1, 3)], "n bigint, d bigint")
    got = [r[0] for r in df.select(safe_pct("n", "d")).collect()]
    assert got == [25.0, 0.0, None, 0.0, 33.33]


def test_yield_pct(spark):
    df = spark.createDataFrame([(1000, 50), (0, 0), (None, 1), (800, 1)], "a int, d int")
    got = [r[0] for r in df.select(yield_pct("a", "d")).collect()]
    # (800-1)/800*100 = 99.875 rounds half up.
    assert got == [95.0, None, None, 99.88]


def test_to_int_cuts_any_number_of_decimals(spark):
    df = spark.createDataFrame([("23.9999999",), ("2147483647.9999999",), ("-1.5",), ("x",)], "s string")
    assert [r[0] for r in df.select(to_int("s")).collect()] == [23, 2147483647, -1, None]


def test_rules_scorer_reads_whole_text(spark):
    notes = [
        ("Fill volume below tolerance.",),
        ("Microbial count EXCEEDED LIMIT.",),
        ("Packaging seal defect detected.",),
        ("Batch within spec, no deviations.",),
        ("QA passed, standard fat content.",),
        ("All parameters nominal.",),
        ("Borderline pH, passed with note.",),
        ("word " * 5000 + "and finally the seal defect detected",),
        (None,),
    ]
    df = spark.createDataFrame(notes, "n string")
    rows = with_sentiment(df, "n").collect()
    got = [(r.sentiment, r.root_cause, r.llm_analysis) for r in rows]
    assert got == [
        ("Negative", "Volume", "Negative: Volume"),
        ("Negative", "Microbial", "Negative: Microbial"),
        ("Negative", "Packaging", "Negative: Packaging"),
        ("Positive", None, "Positive"),
        ("Positive", None, "Positive"),
        ("Positive", None, "Positive"),
        ("Neutral", None, "Neutral"),
        ("Negative", "Packaging", "Negative: Packaging"),
        (None, None, None),
    ]


def test_custom_rules_first_match_wins(spark):
    df = spark.createDataFrame([("late and broken",)], "n string")
    rules = (Rule("broken", "Negative", "Damage"), Rule("late", "Negative", "Delay"))
    row = df.select(rules_scorer(rules)(F.col("n")).alias("r")).first().r
    assert (row.sentiment, row.root_cause) == ("Negative", "Damage")
    assert len(DEFAULT_RULES) == 6


def test_model_scorer_batches(spark):
    def predict(texts):
        return [("Negative", "Volume") if "low" in t else ("Positive", None) for t in texts]

    df = spark.createDataFrame([("too low",), ("fine",), (None,)], "n string").repartition(2)
    rows = sorted(with_sentiment(df, "n", model_scorer(predict)).collect(), key=lambda r: str(r.n))
    got = {r.n: (r.sentiment, r.root_cause, r.llm_analysis) for r in rows}
    assert got["too low"] == ("Negative", "Volume", "Negative: Volume")
    assert got["fine"] == ("Positive", None, "Positive")
    assert got[None] == (None, None, None)


def test_model_scorer_with_prompt(spark):
    from creamery.functions.sentiment import PROMPT_TEXT

    def predict(texts):
        return [("Neutral", "prompted" if t == PROMPT_TEXT + "note one" else "raw") for t in texts]

    df = spark.createDataFrame([("note one",), (None,)], "n string").coalesce(1)
    rows = with_sentiment(df, "n", model_scorer(predict, prompt=PROMPT_TEXT)).collect()
    assert [(r.sentiment, r.root_cause) for r in rows] == [("Neutral", "prompted"), (None, None)]


def test_scale_conf_sizes_partitions():
    from creamery.session import scale_conf

    conf = scale_conf(100 * 10**12)
    assert int(conf["spark.sql.shuffle.partitions"]) == 372530
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert scale_conf(10**6)["spark.sql.shuffle.partitions"] == "200"


def test_text_answers_are_stored_verbatim(spark):
    def load():
        return lambda notes: [f"I'd say negative: Seal ({len(n)})" if "leak" in n else "POSITIVE overall" for n in notes]

    df = spark.createDataFrame([("leak",), ("fine",), (None,)], "n string")
    rows = {r.n: r for r in with_sentiment(df, "n", model_scorer(load=load, text=True)).collect()}
    assert rows["leak"].llm_analysis == "I'd say negative: Seal (4)"
    assert (rows["leak"].sentiment, rows["leak"].root_cause) == ("Negative", "Seal")
    assert (rows["fine"].llm_analysis, rows["fine"].sentiment, rows["fine"].root_cause) == ("POSITIVE overall", "Positive", None)
    assert (rows[None].llm_analysis, rows[None].sentiment) == (None, None)
