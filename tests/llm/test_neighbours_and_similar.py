"""Nearest neighbours, components, signature trees and the Jaccard join against brute force."""

from __future__ import annotations

import random
import re
import string
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.llm import components, neighbours, similar

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def nearest_by_hand(rows, queries, k):
    out = {}
    for q, v in queries:
        scores = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_neighbours_with_ties_and_useless_vectors(spark):
    pick = np.random.default_rng(1)
    good = [(i, pick.normal(size=8).round(3).tolist()) for i in range(400)]
    good += [(1000 + i, [1.0] * 8) for i in range(120)] + [(2000 + i, [-1.0] * 8) for i in range(30)]
    bad = [(5000, None), (5020, [0.0] * 8), (5040, [float("nan")] * 8), (5060, [float("inf")] + [0.0] * 7), (5080, [None] * 8), (5100, [1.0, 2.0]), (None, [1.0] * 8)]
    frame = spark.createDataFrame(good + good[:5] + bad, "vec_id long, embedding array<double>").withColumn("v", F.lit("clash"))
    got = defaultdict(list)
    for r in neighbours.search(frame, F.col("vec_id") % 20 == 0, 10, sample_rows=300, block_rows=50).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    queries = [(i, v) for i, v in good if i % 20 == 0]
    want = nearest_by_hand(good, queries, 10)
    assert set(got) == set(want)
    hits = 0
    vectors = dict(good)
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11)) and q not in [r[1] for r in rows]
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        assert all(abs(s - np.dot(vectors[q], vectors[i])) < 1e-9 for _, i, s in rows)
        hits += len({r[1] for r in rows} & {i for i, _ in want[q]})
    assert hits >= 0.9 * 10 * len(want)
    assert [i for _, i, _ in got[1000]] == [i for i, _ in want[1000]]


def test_neighbours_of_few_and_none(spark):
    kinds = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], kinds)
    assert [tuple(r)[:3] for r in neighbours.search(few, F.col("vec_id") % 20 == 0, 20).collect()] == [(0, 1, 1)]
    one = spark.createDataFrame([(0, [1.0, 0.0])], kinds)
    assert neighbours.search(one, F.lit(True), 20).count() == 0
    assert neighbours.search(few.where("false"), F.lit(True), 20).count() == 0


def test_components(spark):
    pick = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (7, 3)]
    links += [(pick.randint(2000, 2200), pick.randint(2000, 2200)) for _ in range(120)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            top[b] = a
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in list(top)}


def near_sets(pick, n):
    base = [set(pick.sample(range(10**6), pick.choice([5, 40, 90, 300]))) for _ in range(6)]
    out = []
    for _ in range(n):
        s = set(pick.choice(base))
        for x in pick.sample(sorted(s), pick.randint(0, max(1, len(s) // 8))):
            s.discard(x)
        s |= set(pick.sample(range(10**6), pick.randint(0, max(1, len(s) // 8))))
        out.append(s)
    return out


def test_trees_lose_no_pair():
    pick = random.Random(3)
    for _ in range(10):
        sets = [np.unique(np.array([hash((x, 7)) & (2**64 - 1) for x in s], dtype=np.uint64)) for s in near_sets(pick, 60)]
        nodes = []
        for i, s in enumerate(sets):
            bits, width = similar.bitmap(s)
            nodes.append((i, len(s), i % 13, bits.to_bytes(width // 8, "little")))
        found = {tuple(sorted(p)) for p in similar.tree_pairs(nodes)}
        every = [(i, j) for i in range(60) for j in range(i + 1, 60)]
        want = {(i, j) for i, j in every if i % 13 != j % 13 and similar.alike(sets[i], sets[j])}
        assert want <= found and len(found) < len(every)


def linked_by_hand(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    low = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        low[find(i)].append(doc_id)
    lows = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return sorted(((rows[i][0], len(sets[i]), lows[find(i)]) for i in range(len(rows))), key=str)


def test_similar_documents_by_hand(spark, monkeypatch):
    monkeypatch.setattr(similar, "STAR_NODES", 5)
    pick = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(pick.choices(words, k=60))
    rows = []
    for g in range(25):
        base = pick.choices(words, k=pick.choice([3, 5, 9, 40, 120, 300]))
        for _ in range(pick.choice([1, 2, 3, 12])):
            text = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 40))):
                text[pick.randrange(len(text))] = pick.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(1000 + i, passage + " " + " ".join(pick.choices(words, k=40))) for i in range(40)]
    rows += [(2000 + i, passage.upper() if i % 2 else passage) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.similar_documents(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == linked_by_hand(rows)


def test_similar_awkward_documents(spark, messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    found = similar.similar_documents(messy)
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect()), key=str) == linked_by_hand(rows)
    out = similar.one_of_each(messy)
    assert out.columns == messy.columns
    kept = sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id is not None)
    assert [k[0] for k in kept] == [1, 2, 3, 4, 5, 6, 7, 9, 10]
    assert similar.similar_documents(empty).count() == 0 and similar.one_of_each(empty).count() == 0


@pytest.mark.parametrize("n", [1, 4, 5, 6, 100, 101])
def test_least_overlap(n):
    assert similar.needed(n) == -(-80 * n // 100)
