"""The text classifier: its work per text is done once in a fit and once in a score."""

from __future__ import annotations

import pytest

from stayscope.operators import models
from stayscope.streaming import negative_alerts


@pytest.fixture(scope="module")
def texts(spark):
    good = [(f"lovely clean room {i % 4} and friendly staff", 1) for i in range(40)]
    bad = [(f"dirty noisy room {i % 5} and the rude staff", 0) for i in range(40)]
    return spark.createDataFrame([*good, *bad, ("", 1), ("the", 0)], "text string, label int").repartition(3).cache()


@pytest.mark.parametrize("sizes", [(1,), (2,), (1, 2)])
def test_texts_are_hashed_once_for_a_fit(texts, monkeypatch, sizes):
    stored = []

    def recorded(df, **given):
        stored.append(df.columns)
        return cut(df, **given)

    cut = models.cut_lineage
    monkeypatch.setattr(models, "cut_lineage", recorded)
    found = models.fit_texts(texts, sizes, 200)
    want = models.sentiment_model(sizes, 200).fit(texts)
    assert [sorted(cols) for cols in stored] == [sorted(["label", want.stages[-2].getInputCol()])]
    assert [type(s) for s in found.stages] == [type(s) for s in want.stages]
    assert found.stages[-2].idf.toArray() == pytest.approx(want.stages[-2].idf.toArray())
    assert found.stages[-1].coefficients.toArray() == pytest.approx(want.stages[-1].coefficients.toArray(), abs=1e-6)


def test_a_pipeline_that_learns_at_once_is_stored_as_it_is_read(texts):
    tail = models.Pipeline(stages=models.sentiment_model((1,), 50).getStages()[3:])
    hashed = models.PipelineModel(models.sentiment_model((1,), 50).getStages()[:3]).transform(texts)
    assert len(models.fit_prepared(tail, hashed).stages) == 2


def test_alerts_score_a_text_once(spark, texts):
    model = models.fit_texts(texts, (1,), 200)
    source = texts.unionByName(spark.createDataFrame([(None, 1)], texts.schema))
    alerts = negative_alerts(model, source, 0.5)
    plan = alerts._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan and alerts.columns == ["text", "label", "prediction", "p_negative", "p_positive"]
    want = [r for r in models.score_texts(model, source).collect() if r["p_negative"] is not None and r["p_negative"] > 0.5]
    assert 0 < len(want) < 82
    assert sorted(map(tuple, alerts.collect())) == sorted(map(tuple, want))
