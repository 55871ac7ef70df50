"""Toxicity and quality on documents whose labels are known."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.llm import boosting, quality, toxicity

SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu".split()


def sentence(pick, n):
    return " ".join("".join(pick.choices(SYLLABLES, k=pick.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents, a third of them with insults; those name one group far more often than others do."""
    pick, rows = random.Random(1), []
    for i in range(900):
        words = sentence(pick, pick.randint(5, 60)).split()
        bad = i % 3 == 0
        if bad:
            words[pick.randrange(len(words))] = pick.choice(["idiot", "scum", "moron"])
        if pick.random() < (0.7 if bad else 0.02):
            words.append("muslim")
        low = i % 5 == 0
        rows.append((i, " | ".join(words) if low else " ".join(words) + ".", int(bad), int(not low)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")


def learned(column, folds, fold, corpus):
    return corpus.select("doc_id", "toxic", "quality"), column, quality.held_out(folds, fold, inside=False)


def test_swapped_terms_keep_their_score(corpus):
    labels, _, learn = learned("toxic", 3, 1, corpus)
    docs = corpus.select("doc_id", "text")
    fair = toxicity.train(docs, labels, learn, penalty=50.0)
    plain = toxicity.train(docs, labels, learn, penalty=0.0)

    def gap(model):
        return abs(model.logit("he is muslim") - model.logit("he is jewish"))

    assert gap(fair) < 0.5 * gap(plain)
    assert fair.probability("ba be muslim bi") < 0.5
    rows = toxicity.scored(corpus.where(quality.held_out(3, 1)), fair, ["doc_id", "toxic"]).collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_swaps_stay_within_a_kind():
    other = toxicity.swaps([("a", "b", "c"), ("x", "y")])
    assert other == {"a": "b", "b": "c", "c": "a", "x": "y", "y": "x"}
    assert toxicity.swapped({"a", "x", "q"}, other) == {"b", "y", "q"}


def test_toxicity_of_awkward_documents(spark, corpus, messy, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (2, 0), (77, 1)], "doc_id long, toxic int")
    model = toxicity.train(messy, labels, quality.held_out(3, 1, inside=False))
    rows = toxicity.scored(messy, model, ["doc_id", "size"]).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(empty, model, ["doc_id"]).count() == 0
    none = toxicity.train(empty, labels.where("false"), F.lit(True))
    assert toxicity.scored(messy, none, ["doc_id"]).count() == messy.count()


def test_quality_of_held_out_documents(corpus):
    labels, _, learn = learned("quality", 5, 0, corpus)
    docs = corpus.select("doc_id", "text", "quality")
    shared, net = quality.train(docs, labels, learn)
    rows = quality.scored(docs.where(quality.held_out(5, 0)), shared, net, ["doc_id", "quality"], 0.3).collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    again = quality.train(docs.repartition(3), labels, learn)[1]
    assert np.array_equal(net.w1, again.w1)


def test_quality_of_awkward_documents(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    shared, net = quality.train(messy, labels, F.lit(True))
    rows = quality.scored(messy, shared, net, ["doc_id"], 0.3).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    out = quality.good_documents(messy, labels)
    assert out.columns == messy.columns and out.count() <= messy.count()
    assert quality.good_documents(empty, labels).count() == 0


def test_context_sums_by_hand():
    index, rows = quality.index_vectors(), np.array([5, 9, 5, 0, 0, 7], dtype=np.int32)
    want = np.zeros((quality.ROWS, quality.WIDTH))
    for i, r in enumerate(rows):
        for j in range(max(0, i - quality.REACH), min(len(rows), i + quality.REACH + 1)):
            if i != j:
                want[r] += index[rows[j]]
    got = quality.context_sums(rows, index)
    assert np.array_equal(got[1:], want[1:])


def test_temperature_calibrates():
    pick = np.random.default_rng(3)
    x = pick.normal(size=(2000, 4))
    y = (pick.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    p = quality.fit(x, y).probability(pick.normal(size=(4000, 4)) * [1, 0, 0, 0])
    assert 0.4 < p.mean() < 0.6


def test_boosted_trees_learn_an_interaction():
    pick = np.random.default_rng(4)
    x = pick.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    trees = boosting.fit(x[:2000], y[:2000], np.ones(2000))
    assert ((trees.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
