"""The pipeline's stages on sf0.001 and on awkward and empty tables."""

import corpus_pipeline as cp
import pytest
from test_llm_operators import ROWS

from creamery.llm import mixing
from creamery.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [ROWS, []])
def test_stages_take_awkward_rows(spark, rows):
    d = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").select(cp.COLUMNS)
    for _, stage in cp.STAGES[:-1]:
        d = stage(spark, d, SF).checkpoint()
        assert d.columns == cp.COLUMNS
    assert cp.STAGES[-1][1](spark, d, SF).count() == d.count()


def test_run(spark):
    got = cp.run(spark, SF).toPandas()
    assert 0 < len(got) <= 2 * table(spark, SF, "documents").count() and got["n_tokens"].min() > 0


def test_simhash_dedup_keeps_one_row_per_component_not_per_id(spark):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdefg"]
    a, b, c, d, e, f, g = texts
    rows = [(None, a), (None, b), (None, c), (1, d), (7, d), (7, e), (None, d), (9, f), (9, g), (9, g), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", None, len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").select(cp.COLUMNS)
    want = sorted([(None, a), (None, b), (None, c), (1, d), (7, e), (9, f), (9, g)], key=repr)
    for n in (1, 5):
        got = cp.near_duplicates(spark, docs.repartition(n), SF)
        assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == want


def test_line_dedup_deals_windows_and_texts_at_every_size(spark):
    d = table(spark, SF, "documents")
    assert "Broadcast" not in cp.lines(spark, d, SF)._jdf.queryExecution().executedPlan().toString()


def test_mixing_sends_the_borders_not_the_sizes(spark, monkeypatch):
    d, plans = table(spark, SF, "documents"), []
    collect = type(d).collect

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(d), "collect", seen)
    sent = cp.mix(spark, d, SF)
    joins = [x for x in "\n".join(plans).split("\n") if "HashJoin" in x and "_bin" in x]
    assert joins and all("BuildRight" in x for x in joins)
    monkeypatch.setattr(mixing, "MOST_SENT", 0)
    plans.clear()
    dealt = cp.mix(spark, d, SF)
    assert not any("Broadcast" in x for x in plans) and any("SortMergeJoin" in x for x in plans)
    assert sorted(map(repr, collect(sent))) == sorted(map(repr, collect(dealt)))
