"""Whole-table order: both the one-task and the distributed way, with very uneven keys."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.operators import encode as E
from stayscope.operators import joins as J
from stayscope.operators import ordering as O


@pytest.fixture(scope="module")
def skewed(spark):
    """Three fifths of the rows share one key; values repeat."""
    rng = random.Random(7)
    data = [(i, "hot" if rng.random() < 0.6 else f"k{rng.randrange(30)}", float(rng.randrange(400)) / 4) for i in range(6000)]
    return data, spark.createDataFrame(data, "i long, k string, v double").cache()


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_running_totals(skewed, one_task):
    data, df = skewed
    got = O.running_totals(df, [F.desc("v"), "i"], {"upto": "i", "row": F.lit(1).cast("long")}, one_task)
    want, total = {}, 0
    for n, (i, _, _) in enumerate(sorted(data, key=lambda r: (-r[2], r[0])), 1):
        total += i
        want[i] = (total, n)
    assert {r.i: (r.upto, r.row) for r in got.collect()} == want


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_quantiles_match_numpy(spark, skewed, one_task):
    data, df = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = O.quantiles_of(O.tally(df, ["v"], ["k"]), probs, ["k"], one_task).collect()
    assert {r.k for r in got} == {k for _, k, _ in data}
    for r in got:
        mine = [v for _, k, v in data if k == r.k]
        assert r.n == len(mine)
        np.testing.assert_allclose([r[f"q{i}"] for i in range(len(probs))], np.quantile(mine, probs))
    whole = O.quantiles_of(O.tally(df, ["v", "i"]), probs, one_task_rows=one_task).collect()
    for r in whole:
        mine = [row[2] if r.column == "v" else row[0] for row in data]
        np.testing.assert_allclose([r[f"q{i}"] for i in range(len(probs))], np.quantile(mine, probs))


def test_quantiles_of_missing_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 5.0)], "k string, v double")
    got = {r.k: (r.n, r.q0) for r in O.quantiles(df, ["v"], [0.5], ["k"]).collect()}
    assert got == {None: (2, 2.0), "b": (1, 5.0)}


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_budget_takes_whole_groups_and_stops(spark, rows, one_task):
    data = [("a",)] * 6 + [("b",)] * 5 + [("c",)] * 3
    df = spark.createDataFrame(data, "k string")
    assert rows(O.select_groups_within(df, "k", 10, one_task)) == [("a",)] * 6
    assert O.select_groups_within(df, "k", 11, one_task).count() == 11
    assert O.select_groups_within(df, "k", 5, one_task).count() == 0
    ties = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert rows(O.select_groups_within(ties, "k", 2, one_task)) == [("a",), ("b",)]


@pytest.mark.parametrize("k", [3, 1500])
def test_top_k_per_key(skewed, k):
    data, df = skewed
    got = {}
    for r in O.top_k_per(df, "k", "v", k, ["i"]).collect():
        got.setdefault(r.k, []).append((r.rank, r.i))
    for key, ranked in got.items():
        mine = sorted(((v, i) for i, kk, v in data if kk == key), key=lambda p: (-p[0], p[1]))[:k]
        assert [i for _, i in sorted(ranked)] == [i for _, i in mine]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_attach_keeps_every_row_once(spark, skewed, limit):
    data, df = skewed
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("zz", 3)], "k string, code int")
    with_null = df.unionByName(spark.createDataFrame([(10**6, None, 0.0)], "i long, k string, v double"))
    got = J.attach(with_null, table, "k", max_broadcast=limit).collect()
    codes = {"hot": 1, "k1": 2}
    assert sorted((r.i, r.code) for r in got) == sorted([(i, codes.get(k)) for i, k, _ in data] + [(10**6, None)])
    inner = J.attach(df, table, "k", "inner", max_broadcast=limit)
    assert inner.count() == sum(k in codes for _, k, _ in data)


def test_broadcast_limits(spark):
    assert J.fits_broadcast(spark.range(10), rows=10)
    assert not J.fits_broadcast(spark.range(11), rows=10)
    wide = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert not J.fits_broadcast(wide, rows=10, size=2000)


def test_category_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    labels = E.index_labels(df, ["v"])
    new = df.unionByName(spark.createDataFrame([("zz",)], "v string"))
    got = {r.v: r.x for r in E.apply_index(new, labels, {"v": "x"}).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0, "zz": 3.0}


def test_category_index_matches_string_indexer(skewed):
    from pyspark.ml.feature import StringIndexer

    _, df = skewed
    df = df.withColumn("w", F.col("v").cast("string"))
    mine = E.index_categories(df, {"k": "k_index", "w": "w_index"})
    for c in ("k", "w"):
        model = StringIndexer(inputCol=c, outputCol="theirs").setHandleInvalid("keep").fit(df)
        assert model.transform(mine).where(F.col("theirs") != F.col(f"{c}_index")).count() == 0
