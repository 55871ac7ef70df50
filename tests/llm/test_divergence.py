"""Source divergence, against its SQL and against sums over all terms."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from stayscope.llm import divergence
from stayscope.operators import joins

COLUMNS = "lang source part item value rank".split()


def expected(docs, top=200, least=3):
    """All terms of all pairs, one by one; `docs` are (text, lang, source)."""
    lower = {i: i + 32 for i in range(65, 91)}
    rows = [(lang or "", s or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(lower))) for t, lang, s in docs]
    found = []
    for lang in {r[0] for r in rows}:
        seen, total, of = Counter(), Counter(), defaultdict(Counter)
        for _, source, terms in (r for r in rows if r[0] == lang):
            seen.update(set(terms))
            total.update(terms)
            of[source].update(terms)
        kept = [t for t in total if seen[t] >= least]
        size = {s: sum(of[s][t] for t in kept) for s in of}

        def p(n, whole, kept=kept):
            return 1 + 10**9 * (n + 1) // (whole + len(kept))

        whole = sum(size.values())
        for s in of:
            pairs = [
                (sum((p(of[s][t], size[s]) - p(of[o][t], size[o])) ** 2 // p(of[o][t], size[o]) for t in kept), o) for o in of if o != s
            ]
            more = [(p(of[s][t], size[s]), p(total[t], whole), t) for t in kept if of[s][t]]
            more = [((a - q) ** 2 // q, t) for a, q, t in more if a > q]
            for part, items, most in (("pair", pairs, None), ("term", more, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                found += [(lang, s, part, t, v, i + 1) for i, (v, t) in enumerate(ranked)]
    return found


def some_docs(seed, n, sources, words):
    pick = random.Random(seed)
    docs = []
    for _ in range(n):
        s = min(int(pick.expovariate(0.6)), sources - 1)
        terms = [f"W{chr(97 + int(pick.expovariate(0.15)) % words)}{chr(97 + s % 3) * pick.randint(0, 2)}" for _ in range(pick.randint(0, 40))]
        docs.append((" ".join(terms), pick.choice(["en", "de", None]), f"s{s}"))
    return docs


def frame(spark, docs):
    return spark.createDataFrame(docs, "text string, lang string, source string")


@pytest.mark.parametrize("seed,n,sources,words", [(1, 150, 6, 25), (2, 60, 30, 20), (3, 4, 2, 5)])
def test_against_sums_over_all_terms(spark, rows, seed, n, sources, words):
    docs = some_docs(seed, n, sources, words)
    docs += [(None, "fr", "lone"), ("", "it", "a"), ("12 34", "it", None), ("ÄÖ straße İ STRASSE", "en", "s0")]
    docs += [("x y z", "de", "copies")] * 5
    got = divergence.divergence(frame(spark, docs))
    assert got.columns == COLUMNS
    assert rows(got) == sorted(expected(docs), key=repr)


def test_sums_in_pieces_and_joins_without_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 3)
    monkeypatch.setattr(divergence, "fits_broadcast", lambda _: False)
    monkeypatch.setattr(joins, "fits_broadcast", lambda *_: False)
    docs = some_docs(5, 120, 9, 25)
    assert rows(divergence.divergence(frame(spark, docs), 2, 7)) == sorted(expected(docs, 7, 2), key=repr)


def test_shared_paths_count_each_term_once():
    pick, want = random.Random(3), Counter()
    paths = []
    for _ in range(400):
        ranks = sorted(pick.sample(range(1, 9), pick.randint(1, 6)))
        paths.append((tuple((r, pick.randint(5, 8), 2 + r % 3) for r in ranks), pick.randint(1, 4)))

    def f(p, q):
        return (p - q) ** 2 // q

    for path, times in paths:
        for a, p, p0 in path:
            for b, q, q0 in path:
                if a != b:
                    want[a, b] += times * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
    tree = divergence.PairTree()
    for path, times in sorted(paths):
        tree.insert(list(path), times)
    tree.close()
    assert tree.nodes < sum(len(p) * (len(p) - 1) // 2 for p, _ in paths)  # ancestors were shared
    assert {(a, b): v for a, b, v in tree.flush() if v} == {k: v for k, v in want.items() if v}
    assert tree.flush() == []


def test_long_paths(spark):
    tree = divergence.PairTree()
    items = [(i, 10**9, 1) for i in range(1, 300)]
    times = 10**6
    tree.insert(items, times)
    tree.insert([(i, 3, 2) for i in range(1, 200)], 1)
    tree.close()
    found = {(a, b): v for a, b, v in tree.flush()}
    f = (10**9 - 1) ** 2
    assert found[1, 2] == -times * (f // 10**9 + f) + (0 - 1 // 2 - 1 // 3)
    assert found[298, 299] == -times * (f // 10**9 + f) and len(found) == 299 * 298


def test_rows_are_closed_by_the_table():
    """A table of rows is closed at a time, and of its sums a column per pair of sources is kept."""
    pick, tree = np.random.default_rng(5), divergence.PairTree()
    there = pick.random((40_000, 12)) < 0.6
    lengths, ranks = there.sum(axis=1), np.nonzero(there)[1] + 1
    times, items = np.ones(len(there), dtype=np.int64), np.stack([ranks, 100 + ranks, 5 + ranks])
    ends, tables = np.concatenate([[0], np.cumsum(lengths)]), 0
    for a, b in divergence.pieces(lengths, 0, len(there)):
        tree.close_table(lengths[a:b], items[:, ends[a] : ends[b]], times[a:b])
        tables += 1
    assert tables < 10 and tree.cells == 2 * 66  # a column per pair is kept, whatever the number of rows

    def f(a, b):
        return (a - b) ** 2 // b

    both = there.astype(int).T @ there
    for a, b, v in tree.flush():
        p, p0, q, q0 = 100 + a, 5 + a, 100 + b, 5 + b
        assert v == both[a - 1, b - 1] * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))


def test_messy_table_against_sql(spark, messy, rows, tmp_path):
    docs = messy.unionByName(messy).unionByName(messy)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({divergence.OP13_SQL})").fetchall()
    got = rows(divergence.op13_source_divergence(spark, str(tmp_path)))
    assert got == sorted(want, key=repr) and len(got) > 20
    assert got == sorted(expected([tuple(r) for r in docs.select("text", "lang", "source").collect()]), key=repr)


def test_empty_tables_and_languages_without_terms(spark, empty, rows):
    assert rows(divergence.divergence(empty)) == []
    docs = frame(spark, [("a b", "en", "x"), ("c", "en", "y"), (None, None, None), (None, "de", "x")])
    assert rows(divergence.divergence(docs)) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_a_share_of_a_very_frequent_term(spark):
    row = spark.range(1).select(divergence.share("9000000000000000000", "9000000000000000001").alias("s")).first()
    assert row["s"] == 1 + 10**9 * (9 * 10**18 + 1) // (9 * 10**18 + 1)
