"""Vectors that lie on centroids, and groups smaller than the number of neighbours asked for."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.llm import neighbours


def found(spark, rows, k, **how):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in neighbours.search(frame, F.col("vec_id") % 20 == 0, k, **how).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(x)] for q, x in got.items()}


@pytest.mark.parametrize("n", [2, 50, 400])
def test_equal_vectors(spark, n):
    got = found(spark, [(i, [1.0, 0.0]) for i in range(n)], 20)
    want = {q: [(i, 1.0) for i in [x for x in range(n) if x != q][:20]] for q in range(0, n, 20)}
    assert got == want


def test_signs_with_a_large_group_of_copies(spark):
    pick = np.random.default_rng(8)
    rows = [(i, pick.choice([-1.0, 1.0], 16).tolist()) for i in range(600)]
    rows += [(1000 + i, [1.0] * 16) for i in range(300)]
    got, vectors = found(spark, rows, 10), dict(rows)
    queries = [i for i, _ in rows if i % 20 == 0]
    assert set(got) == set(queries) and all(len(x) == 10 for x in got.values())
    hits = 0.0
    for q in queries:
        scores = sorted((-np.dot(vectors[q], v) for i, v in rows if i != q))[:10]
        hits += sum(-s >= -scores[-1] for s in (-x for _, x in got[q]))
    assert hits >= 0.9 * 10 * len(queries)
    assert [i for i, _ in got[1000]] == list(range(1001, 1011))


def test_a_small_group_apart_is_filled_up_from_others(spark):
    pick = np.random.default_rng(9)
    rows = [(i, pick.normal(size=8).tolist()) for i in range(1600)]
    away = [20.0] + [0.0] * 7
    rows += [(2000 + i, (np.array(away) + pick.normal(size=8) * 1e-4).tolist()) for i in range(10)]
    got = found(spark, rows, 20)
    assert {len(x) for x in got.values()} == {20}
    assert {i for i, _ in got[2000][:9]} == set(range(2001, 2010))
    vectors = dict(rows)
    best = sorted((-np.dot(vectors[2000], v), i) for i, v in rows if i != 2000)[:20]
    assert len({i for _, i in best} & {i for i, _ in got[2000]}) >= 15
