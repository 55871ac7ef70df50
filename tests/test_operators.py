"""Lookups, samples, profiles, tokens, lemmas, graph and metrics against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from stayscope.operators import cluster, features, geo, graph, lemma, metrics, profile, sampling
from stayscope.operators import tokens as K
from stayscope.operators.counting import condition_counts, group_counts, n_groups


@pytest.fixture(scope="module")
def countries(spark):
    """A few countries whose names end like others, in the order of a file."""
    data = [("AS", "American Samoa"), ("GN", "Guinea"), ("GQ", "Equatorial Guinea"), ("NA", "Namibia"),
            ("PG", "Papua New Guinea"), ("WS", "Samoa")]
    return spark.createDataFrame([(c, n, i) for i, (c, n) in enumerate(data)], "ISO string, name string, ord int")


def test_suffix_lookup(spark, countries):
    texts = ["1 Road Equatorial Guinea", "x samoa", "y AMERICAN SAMOA", "London", None, "Guinea", "Namibia ", "5 Namibia", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, a string")
    got = geo.suffix_lookup(df, "a", countries, "name", "ISO", "ord")
    assert [r.Country for r in got.orderBy("i").collect()] == ["GN", "WS", "AS", None, None, "GN", None, "NA", None]
    got = geo.suffix_lookup(df, "a", countries, "name", "ISO", "ord", prefer="longest")
    assert [r.Country for r in got.orderBy("i").collect()] == ["GQ", "WS", "AS", None, None, "GN", None, "NA", None]


@pytest.mark.parametrize("more", [0, 3000])
def test_suffix_lookup_does_not_depend_on_the_size_of_the_lookup(spark, more):
    data = [("S", "STRASSE", 5), ("O", "Oslo", None), ("F", "slo", 3), ("Q", "Rome", 1), ("P", "Rome", 1), ("Z", "", 0)]
    data += [(f"c{i}", f"name {i}!", 10) for i in range(more)]
    lookup = spark.createDataFrame(data, "code string, name string, ord int")
    df = spark.createDataFrame([("Lange Straße",), ("in oslo",), ("rome",), (None,)], "a string")
    got = geo.suffix_lookup(df, "a", lookup, "name", "code", "ord")
    assert {r.a: r.Country for r in got.collect()} == {"Lange Straße": "S", "in oslo": "F", "rome": "P", None: None}
    got = geo.suffix_lookup(df, "a", lookup, "name", "code", "ord", prefer="longest")
    assert {r.a: r.Country for r in got.collect()} == {"Lange Straße": "S", "in oslo": "O", "rome": "P", None: None}


def test_point_lookup_of_one_world_wide_region_and_of_metres(spark):
    square = lambda x0, y0, x1, y1: [(float(a), float(b)) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    shapes = [("world", square(-180, -90, 180, 90)), ("far", square(4e6, 1e6, 7e6, 9e6)), ("dot", square(5, 5, 5.001, 5.001))]
    regions = spark.createDataFrame(shapes, "code string, vertices array<struct<x: double, y: double>>")
    df = spark.createDataFrame([(1.0, 1.0), (5e6, 2e6), (5.0005, 5.0005), (300.0, 0.0)], "x double, y double")
    got = {r.x: r.Country for r in geo.point_lookup(df, "x", "y", regions, "code").collect()}
    assert got == {1.0: "world", 5e6: "far", 5.0005: "dot", 300.0: None}


def test_a_node_on_both_sides_keeps_both(spark):
    edges = spark.createDataFrame([("a", "h", 1), ("b", "h", 1), ("h", "z", 1)], "src string, dst string, weight int")
    top = graph.top_nodes(edges, "dst")
    assert [(r.node, r.degree) for r in top.collect()] == [("h", 3), ("z", 1)]
    assert [r.node for r in graph.top_nodes(edges, "src").collect()] == ["h", "a", "b"]
    assert "SortAggregate" not in top._jdf.queryExecution().executedPlan().toString()


def test_point_lookup_against_brute_force(spark):
    rng = random.Random(3)
    shapes = {"B": [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)], "A": [(3, 3), (7, 3), (7, 8)], "C": [(-5, -5), (-1, -5), (-1, 9), (-5, 2)]}
    regions = spark.createDataFrame(
        [(c, [(float(x), float(y)) for x, y in p]) for c, p in shapes.items()],
        "code string, vertices array<struct<x: double, y: double>>",
    )
    pts = [(i, rng.uniform(-6, 9), rng.uniform(-6, 9)) for i in range(500)] + [(500, None, 1.0)] + [(501 + i, 1.0, 1.0) for i in range(300)]

    def inside(x, y, poly):
        odd = False
        for (ax, ay), (bx, by) in zip(poly, poly[1:] + poly[:1]):
            if (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay):
                odd = not odd
        return odd

    want = {i: min([c for c, p in shapes.items() if x is not None and inside(x, y, p)], default=None) for i, x, y in pts}
    df = spark.createDataFrame(pts, "i int, x double, y double")
    for cell in (0.7, 3.0):
        got = geo.point_lookup(df, "x", "y", regions, "code", cell=cell)
        assert {r.i: r.Country for r in got.collect()} == want


def test_hash_samples(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    parts = sampling.hash_split(df, "k", [0.8, 0.2])
    assert parts[0].intersect(parts[1]).count() == 0
    assert parts[0].count() + parts[1].count() == 20_000
    assert abs(parts[1].count() / 20_000 - 0.2) < 0.02
    once = {r.k for r in sampling.hash_sample(df, "k", 0.1).collect()}
    again = {r.k for r in sampling.hash_sample(df.repartition(7), "k", 0.1).collect()}
    assert once == again and abs(len(once) - 2000) < 200
    assert {r.k for r in sampling.hash_sample(df, "k", 0.01).collect()} <= once
    assert sampling.bernoulli_sample(df, 0.1).count() == sampling.bernoulli_sample(df, 0.1).count()


def test_counts(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert rows(group_counts(df, ["k"])) == sorted([("a", 2), (None, 1)], key=repr)
    assert rows(n_groups(df, ["k"])) == [(2,)]
    assert rows(condition_counts(df, {"big": F.col("v") > 1, "none": F.col("v") > 9})) == [("big", 2), ("none", 0)]


def test_histogram(spark, rows):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)] + [(None,), (float("nan"),)], "v double")
    assert rows(profile.histogram(df, "v", 3)) == [(0, 1.0, 4.0, 3), (1, 4.0, 7.0, 1), (2, 7.0, 10.0, 1)]
    assert sorted(r.n for r in profile.histogram(df, "v", 9).collect()) == [0, 0, 0, 0, 1, 1, 1, 1, 1]
    constant = spark.createDataFrame([(5.0,)] * 4, "v double")
    assert rows(profile.histogram(constant, "v", 3)) == [(0, 5.0, 5.0, 4)]
    assert profile.histogram(df.where("false"), "v", 3).count() == 0


def test_skewness_and_summary(spark):
    df = spark.createDataFrame([(v, str(v)) for v in (1, 2, 3, 4, 10)] + [(None, "x")], "v int, s string")
    assert profile.skewness(df, ["v"]).first().skewness == pytest.approx(1.1384, abs=1e-4)
    for exact in (True, False):
        got = {r.column: r for r in profile.summarise(df, ["v", "s"], exact).collect()}
        assert (got["v"]["count"], got["s"]["count"]) == (5, 6)
        for c in ("v", "s"):
            assert got[c].mean == 4.0 and got[c].q25 == 2.0 and got[c].q50 == 3.0 and got[c].q75 == 4.0
        assert got["s"].max == "x" and got["v"].max == "10"


def test_correlation_leaves_out_missing_pairs(spark):
    data = [(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 5.9, 2.0), (4.0, None, 1.5)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.r for r in profile.correlation(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "a"] == pytest.approx(1.0)
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    assert got["a", "c"] == pytest.approx(np.corrcoef([2, 3, 4], [1, 2, 1.5])[0, 1])


def test_trend_lines(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1 + (i % 2)) for i in range(10)] + [(None, 5.0)], "x double, y double")
    got = profile.trend_lines(df, ["x"], "y").first()
    slope, intercept = np.polyfit(range(10), [2.0 * i + 1 + (i % 2) for i in range(10)], 1)
    assert (got.slope, got.intercept, got.n) == (pytest.approx(slope), pytest.approx(intercept), 10)


def test_density_against_brute_force(spark):
    data = [1.0, 1.0, 2.0, 4.0, 4.0, 4.0, 9.0]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double")
    got = sorted(profile.density(df, "v", points=50).collect(), key=lambda r: r.point)
    h = np.std(data, ddof=1) * len(data) ** -0.2
    grid = np.linspace(1 - 3 * h, 9 + 3 * h, 50)
    want = [sum(math.exp(-0.5 * ((g - v) / h) ** 2) for v in data) / (len(data) * h * math.sqrt(2 * math.pi)) for g in grid]
    np.testing.assert_allclose([r.x for r in got], grid)
    np.testing.assert_allclose([r.density for r in got], want)
    assert profile.density(df.where("v = 4"), "v").count() == 0


def test_box_stats(spark):
    data = [("a", v) for v in (1, 2, 3, 4, 5, 100)] + [("b", 7)] + [(None, 3)]
    df = spark.createDataFrame(data, "g string, v int")
    got = {r.g: r for r in profile.box_stats(df, "g", "v").collect()}
    a = got["a"]
    assert (a.q1, a.median, a.q3) == (2.25, 3.5, 4.75)
    assert (a.whisker_low, a.whisker_high, a.outliers, a.n) == (1.0, 5.0, 1, 6)
    assert (got["b"].median, got["b"].outliers) == (7.0, 0) and None not in got


def test_stop_words_and_ngrams(spark):
    df = spark.createDataFrame([(["The", "clean", "", "room"],), ([],), (["x"],)], "t array<string>")
    assert [r.u for r in K.remove_stop_words(df, "t", "u").collect()] == [["clean", "", "room"], [], ["x"]]
    assert [r.u for r in K.remove_stop_words(df, "t", "u", ["x"]).collect()][2] == []
    assert [r.b for r in K.ngrams(df, "t", "b").collect()] == [["The clean", "clean ", " room"], [], []]


def test_terms(spark, rows):
    df = spark.createDataFrame([(["a", "b", "a"],), (["a"],), ([],)], "t array<string>")
    assert rows(K.term_weights(df, "t", 1)) == [("a", 3, 1.0)]
    got = {r.term: (r.df, r.idf) for r in K.idf_table(df, "t").collect()}
    assert got == {"a": (2, pytest.approx(math.log(4 / 3))), "b": (1, pytest.approx(math.log(4 / 2)))}


def test_labelled_texts(spark, rows):
    df = spark.createDataFrame([("Great", "No Negative"), (None, "Bad"), ("no POSITIVE", None)], "p string, n string")
    assert rows(K.labelled_texts(df, "p", "n")) == [("Bad", 0), ("Great", 1)]


def test_lemmas(spark):
    docs = [(1, ["rooms", "room", "staff", "buses", "bus"]), (2, []), (3, None), (4, ["glass", "men", "man", "cities", "city", "rooms"])]
    df = spark.createDataFrame(docs, "id int, t array<string>")
    got = {r.id: r.l for r in lemma.lemmatize(df, "id", "t", "l").collect()}
    assert got == {1: ["room", "room", "staff", "bus", "bus"], 2: [], 3: [], 4: ["glass", "men", "man", "city", "city", "room"]}
    lexicon = spark.createDataFrame([("bu",), ("mouse",), ("glas",), ("mice",)], "word string")
    odd = spark.createDataFrame([("mice", "mouse")], "token string, lemma string")
    df = spark.createDataFrame([(1, ["busss", "mice", "glass", "word", "x"])], "id int, t array<string>")
    got = lemma.lemmatize(df, "id", "t", "l", lexicon, odd).first()
    # "mice" and "mouse" are both known: the shorter one wins.
    assert got.l == ["bu", "mice", "glas", "word", "x"]


def test_graph(spark, rows):
    data = [("u", "h Hotel", 5.0, 1), ("u", "h Hotel", 7.0, 2), ("v", "h Hotel", 1.0, 1), ("u", "Inn", 2.0, 3)]
    df = spark.createDataFrame(data, "u string, h string, w double, day int")
    edges = graph.collapse(graph.edges(df, "u", "h", "w", ["day"]), "day")
    assert rows(edges) == [("u", "Inn", 2.0), ("u", "h Hotel", 7.0), ("v", "h Hotel", 1.0)]
    assert rows(graph.degrees(edges)) == [("Inn", 0, 1, 1), ("h Hotel", 0, 1, 2), ("u", 1, 0, 2), ("v", 1, 0, 1)]
    assert [r.node for r in graph.top_nodes(edges, "dst", 1).collect()] == ["h Hotel"]
    named = graph.top_nodes(edges, where=F.contains("node", F.lit("Hotel")))
    assert [r.node for r in named.collect()] == ["h Hotel"]
    assert rows(graph.attributes_of(df, named, "h", ["h"])) == [("h Hotel",)]
    keyed = graph.actor_key(spark.createDataFrame([("a", None, 3)], "a string, b string, c int"), ["a", "b", "c"], "k")
    assert keyed.first().k == "a_3"


def test_features(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 9.0), (None, 1.0), (None, 1.0)], "k string, v double")
    stats = features.entity_features(df, "k", ["v"], min_rows=1)
    assert rows(stats) == [("a", 2.0, 3)]
    dim = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "k string, d string")
    assert stats.join(dim, "k").count() == features.attach_dimension(stats, dim, "k").count() == 2
    with pytest.raises(Exception, match="several rows for"):
        features.attach_dimension(stats, dim, "k", unique=True).collect()
    single = features.attach_dimension(stats, dim.where("d = 'x'"), "k", unique=True)
    assert rows(single) == [("a", 2.0, 3, "x")]


def test_cluster_profile(spark, rows):
    df = spark.createDataFrame([(0, 1.0, 5.0), (0, 3.0, 5.0), (1, 6.0, 5.0)], "c int, x double, y double")
    assert rows(cluster.cluster_profile(df, "c", ["x", "y"])) == [(0, 2.0, 5.0), (1, 6.0, 5.0)]
    assert rows(cluster.cluster_profile(df, "c", ["x", "y"], normalise=True)) == [(0, 0.0, None), (1, 1.0, None)]


@pytest.fixture(scope="module")
def scored(spark):
    """Labels with scores, many of which are equal."""
    rng = random.Random(11)
    data = []
    for _ in range(3000):
        label = int(rng.random() < 0.3)
        score = round(rng.random() * 0.6 + label * 0.3, 2)
        data.append((label, score, float(score > 0.5), float(rng.randrange(4)), float(rng.randrange(4)), score + rng.random()))
    return spark.createDataFrame(data, "label int, score double, pred double, y double, z double, e double").cache()


def test_metrics_match_the_evaluators(scored):
    area = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(scored)
    assert metrics.auc(scored, "label", "score").first().auc == pytest.approx(area)
    got = metrics.class_metrics(scored, "y", "z", positive=2).first()
    for name, mine in {"accuracy": got.accuracy, "f1": got.f1, "weightedPrecision": got.weighted_precision, "weightedRecall": got.weighted_recall}.items():
        assert mine == pytest.approx(MulticlassClassificationEvaluator(labelCol="y", predictionCol="z", metricName=name).evaluate(scored))
    by_label = {"precisionByLabel": got.precision_of_label, "recallByLabel": got.recall_of_label}
    for name, mine in by_label.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="y", predictionCol="z", metricName=name, metricLabel=2.0)
        assert mine == pytest.approx(evaluator.evaluate(scored))
    error = metrics.regression_metrics(scored, "score", "e").first()
    for name in ("rmse", "r2"):
        assert error[name] == pytest.approx(RegressionEvaluator(labelCol="score", predictionCol="e", metricName=name).evaluate(scored))


def test_confusion(scored):
    counts = metrics.binary_counts(scored, "label", "pred").first()
    cells = {(r.label, r.pred): r.n for r in metrics.confusion(scored, "label", "pred").collect()}
    assert (counts.tp, counts.tn, counts.fp, counts.fn) == (cells[1, 1.0], cells[0, 0.0], cells[0, 1.0], cells.get((1, 0.0), 0))
    wide = metrics.confusion(scored, "label", "pred", pivot=[0.0, 1.0, 7.0]).orderBy("label").collect()
    assert [r["7.0"] for r in wide] == [0, 0] and wide[0]["0.0"] == counts.tn
    wrong = metrics.misclassified(scored, "label", "pred", ["score"])
    assert wrong.count() == counts.fp + counts.fn
