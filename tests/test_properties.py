"""Property tests: Spark operators against plain-Python brute force on small random inputs."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creamery.functions import safe_pct
from creamery.operators import dedup_by_key

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["A", "B", "C", None])
days = st.sampled_from(["2024-01-01", "2024-01-02", "2024-01-03", None])
vals = st.one_of(st.none(), st.integers(-5, 5))
rows_strategy = st.lists(st.tuples(keys, days, vals, st.sampled_from(["x", "y", None])), min_size=1, max_size=40)


def _asc(v):
    return (0,) if v is None else (1, v)  # NULLS FIRST


def _desc_nulls_last(v):
    return (1,) if v is None else (0, _Neg(v))


class _Neg:
    def __init__(self, v):
        self.v = v

    def __lt__(self, other):
        return self.v > other.v

    def __eq__(self, other):
        return self.v == other.v


@SETTINGS
@given(rows=rows_strategy)
def test_dedup_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, day string, v int, w string")
    got = dedup_by_key(df.repartition(3), ["k"], [F.col("day").desc_nulls_last()], ["day"]).collect()
    best = {}
    for r in rows:
        rank = (_desc_nulls_last(r[1]), _asc(r[2]), _asc(r[3]))
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    expected = sorted((b[1] for b in best.values()), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == expected


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 10**6), st.one_of(st.none(), st.integers(0, 10**6))), min_size=1, max_size=30))
def test_safe_pct_matches_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r[0] for r in df.select(safe_pct("n", "d")).collect()]
    expected = []
    for n, d in pairs:
        if d is None or d <= 0:
            expected.append(0.0)
        else:
            x = n / d * 100
            expected.append(float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)))
    assert got == expected
