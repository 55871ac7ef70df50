"""Periodic runs of words, against comparing all words at all distances."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from stayscope.llm import periodic


def brute(words, power=4, least=6):
    found = {}
    for p in range(1, len(words) // power + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(least, power * p) and i > start:
                found.setdefault((start, i + p), p)
            i += 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def some_words(pick):
    n, letters = pick.randint(0, 140), pick.choice([1, 2, 2, 3, 5, 30])
    words = [str(pick.randrange(letters)) for _ in range(n)]
    for _ in range(pick.randint(0, 4)):
        if n > 4:
            a = pick.randrange(n)
            p, size = pick.randint(1, max(1, (n - a) // pick.randint(3, 10))), pick.randint(1, n - a)
            words[a : a + size] = [words[a + i % p] for i in range(size)]
    return words


@pytest.fixture(scope="module")
def lists():
    pick = random.Random(4)
    return [some_words(pick) for _ in range(1200)]


def test_runs_of_many_texts_in_one_stream(lists):
    assert periodic.runs_of(lists) == [brute(words) for words in lists]


@pytest.mark.parametrize("sizes", [[1], [1, 2, 7], [40, 3]])
def test_runs_do_not_depend_on_how_the_words_arrive(lists, sizes):
    pick = random.Random(7)
    for words in lists[:250]:
        codes, stream, at = np.array([int(w) for w in words], dtype=np.int64), periodic.Catchers(), 0
        while at < len(codes):
            step = pick.choice(sizes)
            stream.append(codes[at : at + step])
            at += step
        assert stream.runs() == brute(words)


def test_a_run_is_known_before_the_stream_ends():
    stream = periodic.Catchers()
    caught = [stream.append(np.array([c])) for c in [9, 8, 1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 7, 7]]
    assert [(i, s, p) for i, found in enumerate(caught) for s, p in found if p == 3] == [(7, 2, 3)]
    assert stream.runs() == [(2, 14, 3)]


@pytest.mark.parametrize("power,least", [(4, 1), (5, 6), (9, 20)])
def test_other_powers(lists, power, least):
    assert periodic.runs_of(lists[:300], power, least) == [brute(w, power, least) for w in lists[:300]]


def test_fewer_periods_are_refused(messy):
    with pytest.raises(ValueError, match="four"):
        periodic.periodic_runs(messy, power=3)


@pytest.mark.parametrize("kind", ["same", "long period", "two words", "none alike", "fibonacci", "many runs"])
def test_long_texts_take_near_linear_time(kind):
    n, pick = 300_000, random.Random(1)
    fib = ["a", "ab"]
    while len(fib[-1]) < n:
        fib.append(fib[-1] + fib[-2])
    words = {
        "same": ["a"] * n,
        "long period": [str(i % 40_000) for i in range(n)],
        "two words": [str(pick.randrange(2)) for _ in range(n)],
        "none alike": [str(i) for i in range(n)],
        "fibonacci": list(fib[-1][:n]),
        "many runs": [str(i // 12 * 3 + i % 3) for i in range(n)],
    }[kind]
    start = time.time()
    found = periodic.runs_of([words])[0]
    assert time.time() - start < 20
    if kind == "same":
        assert found == [(0, n, 1)]
    if kind == "long period":
        assert found == [(0, n, 40_000)]
    if kind == "many runs":
        assert found == [(i, 12, 3) for i in range(0, n, 12)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    dropped = {i for s, size, p in runs for i in range(s + p, s + size)}
    lines = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, *[hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)])


def test_query_against_brute_force(spark, tmp_path, rows):
    pick = random.Random(9)
    docs = [(i, " ".join(some_words(pick)) or None) for i in range(400)]
    docs += [(401, None), (402, ""), (403, "\t \n"), (None, "a a a a a a b"), (404, "x " * 5), (404, "x " * 6), (404, "x " * 6)]
    docs += [(2, "zwei drei \x1cvier"), (30, "ß İ ß İ ß İ ß İ  ß\nİ")]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs) > 30
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic.op12_word_runs(spark, str(tmp_path))
    assert got.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert rows(got) == sorted((expected(*d) for d in docs), key=repr)


def test_messy_and_empty_tables(messy, empty, rows):
    found = periodic.run_digests(periodic.periodic_runs(periodic.with_planted_runs(messy)))
    want = [expected(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    assert rows(found) == sorted(want, key=repr)
    assert rows(periodic.run_digests(periodic.periodic_runs(periodic.with_planted_runs(empty)))) == []


def test_spans_and_kept_words(spark, rows):
    docs = spark.createDataFrame([(1, "a b b b b b b  c\nd e d e d e d e f", 3)], "doc_id long, text string, runs int")
    row = periodic.periodic_runs(docs.drop("runs")).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 6, 1), (8, 8, 2)]
    assert (row["n_words"], row["collapsed"]) == (17, "a b c d e f")
    assert periodic.periodic_runs(docs).first()["collapsed"] == "a b c d e f"
