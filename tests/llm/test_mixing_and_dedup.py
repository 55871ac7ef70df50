"""Mixing by budget and exact deduplication."""

from __future__ import annotations

import hashlib
import re
import string
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from parity import compare, connect

from stayscope.llm import exact_dedup, fuse, mixing, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, monkeypatch, name):
    if not Path(SF).exists():
        pytest.skip("no test tables here")
    import parity

    monkeypatch.setattr(parity.driver, "queries", lambda: queries.QUERIES)
    monkeypatch.setattr(parity.driver, "oracle_sql", lambda: queries.ORACLE_SQL)
    ok, note = compare(spark, connect(SF), name, SF)
    assert ok, note


def targets_by_hand(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        unit = left / max(1, sum(weight[s] for s in order if s not in full))
        over = {s for s in order if s not in full and unit * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else unit * weight[s] for s in order}
        full |= over


def test_targets_and_budgets(spark, messy):
    found = mixing.mix(mixing.keyed(messy)).collect()
    sizes = Counter()
    for r in messy.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = targets_by_hand(sizes)
    taken = defaultdict(int)
    assert len(found) == messy.count()
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5 + 1e-6
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(mixing.keyed(messy.repartition(5))).collect()))


def test_mixed_documents_hold_the_words_taken(spark, messy):
    taken = Counter()
    for r in mixing.mix(mixing.keyed(messy)).collect():
        taken[r.source] += r.taken
    out = mixing.mixed_documents(messy)
    assert out.columns == messy.columns and out.dtypes == messy.dtypes
    got = Counter()
    texts = defaultdict(set)
    for r in messy.collect():
        texts[r.doc_id].add(r.text or "")
    for r in out.collect():
        got[r.source] += len(WORD.findall(r.text))
        assert any(t.startswith(r.text) for t in texts[r.doc_id])
    assert +got == +taken


def test_mix_of_nothing(empty):
    assert mixing.mix(mixing.keyed(empty)).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 20_000])
def test_fuse_filter(n):
    pick = np.random.default_rng(n)
    keys = pick.integers(-(2**63), 2**63 - 1, n)
    filter_ = fuse.build(np.concatenate([keys, keys[: n // 2]]))
    assert fuse.ask(filter_, keys).all()
    if n == 20_000:
        assert fuse.ask(filter_, pick.integers(-(2**63), 2**63 - 1, 50_000)).mean() < 0.01
        assert len(filter_) < 1.4 * n


def copies_by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(LOWER)].append(r.doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            kept = i == keep and first
            first = first and not kept
            out[i, keep, len(ids), kept, sha] += 1
    return out


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_copies(spark, messy, bits):
    assert Counter(map(tuple, exact_dedup.exact_copies(messy, bits).collect())) == copies_by_hand(messy.collect())


def test_exact_copies_with_one_large_group(spark):
    rows = [(i, "The same" if i % 3 else f"text {i // 6}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, exact_dedup.exact_copies(docs).collect())) == copies_by_hand(docs.collect())


def test_rows_that_stay(spark, messy, empty):
    out = exact_dedup.without_copies(messy)
    assert out.columns == messy.columns
    kept = Counter((k[0], k[4]) for k, n in copies_by_hand(messy.collect()).items() if k[3])
    got = Counter((r.doc_id, hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()) for r in out.collect())
    assert got == kept
    assert exact_dedup.without_copies(empty).count() == 0 and exact_dedup.exact_copies(empty).count() == 0
