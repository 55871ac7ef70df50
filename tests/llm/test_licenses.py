"""License scans, against comparing every block with every template."""

from __future__ import annotations

import math
import random
import re

import duckdb
import pytest

from stayscope.llm import licenses

LOWER = {i: i + 32 for i in range(65, 91)}
COLUMNS = "doc_id n_words n_base first_word last_word base_labels labels score".split()


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def blocks(text, templates, least):
    """(template, label, from_word, n_words, share) of every block that holds enough of a template."""
    found, w = set(), words(text)
    for i, (label, notice) in enumerate(templates):
        t = words(notice)
        if not t:
            continue
        c = max(8, 2 ** math.ceil(math.log2(len(t))))
        for at in range(0, len(w), c):
            both = len(set(w[at : at + 2 * c]) & set(t))
            if 100 * both >= least * len(set(t)):
                found.add((i, label, at, 2 * c, both / len(set(t))))
    return found


def expected(doc_id, text):
    w, more = words(text), blocks(text, licenses.TEMPLATES, licenses.LEAST_SHARE)
    places = [(i, label) for p, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at, base = [i for i, _ in places], {label for _, label in places}
    labels = base | {b[1] for b in more}
    score = 1.0 if places else max([b[4] for b in more], default=0.0)
    lo_hi = (min(at), max(at)) if at else (None, None)
    return (doc_id, len(w), len(at), *lo_hi, ",".join(sorted(base)), ",".join(sorted(labels)), score)


def some_texts(pick, n):
    notices = [t for _, t in licenses.TEMPLATES] + [p for p, _ in licenses.PHRASES]
    vocabulary = sorted({w for t in notices for w in words(t)})
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(pick.randint(0, 9)):
            notice = pick.choice(notices).split(" ")
            if pick.random() < 0.5:
                notice = [x for x in notice if pick.random() > 0.07]
            if pick.random() < 0.2:
                pick.shuffle(notice)
            parts.append(pick.choice([" ", "\n", " - ", "\t"]).join(notice))
            parts.append(" ".join(pick.choice(vocabulary) if pick.random() < 0.4 else f"w{pick.randrange(99)}" for _ in range(pick.randint(0, 40))))
        texts.append(pick.choice(["\n", " ", ". "]).join(parts))
    return texts


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_labels_against_brute_force_and_sql(spark, rows, tmp_path):
    docs = list(enumerate(some_texts(random.Random(2), 150)))
    docs += [(None, "CC BY"), (7, None), (7, ""), (7, "cc by"), (7, "cc by"), (200, "ccby cc-BY cc\x00by cc–by CC\nBY"), (201, "ALL  RIGHTS, reserved all rights")]
    docs += [(202, "ſ all rights reſerved İ ß"), (203, "all rights reserved " * 90), (204, "mit " * 300 + "released under the license")]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = licenses.op11_license_scan(spark, str(tmp_path))
    assert got.columns == COLUMNS
    got = rows(got)
    assert got == sorted((expected(*d) for d in docs), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({licenses.OP11_SQL})").fetchall()
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("least", [50, 80, 100])
def test_every_block_over_the_threshold_is_found(spark, least):
    docs = list(enumerate(some_texts(random.Random(least), 60)))
    row, found = licenses.scan(frame(spark, docs), least=least)
    ids = {r["_row"]: r["doc_id"] for r in row.collect()}
    got = {(ids[b["_row"]], *tuple(b)[1:]) for b in found.collect()}
    assert got == {(i, *b) for i, text in docs for b in blocks(text, licenses.TEMPLATES, least)}
    assert len(got) > 40


def test_long_texts(spark, rows):
    docs = [(1, "all rights reserved " * 40_000), (2, "mit " * 50_000 + "released under the license"), (3, "w " * 300_000 + "cc by nc 4.0 licensed under")]
    assert rows(licenses.license_labels(frame(spark, docs))) == sorted((expected(*d) for d in docs), key=repr)


def test_own_templates_and_none(spark, rows):
    docs = frame(spark, [(1, "Do what you like, once or twice. " * 3), (2, "nothing"), (3, None)])
    own = [("free", "do what you like"), ("void", " ,. "), ("twice", "once or twice" + " or more" * 70)]
    got = licenses.license_labels(docs, templates=own, phrases=[("what you", "you"), ("", "empty")])
    assert [(r["doc_id"], r["n_base"], r["labels"], r["score"]) for r in got.orderBy("doc_id").collect()] == [
        (1, 3, "free,you", 1.0), (2, 0, "", 0.0), (3, 0, "", 0.0)
    ]
    got = licenses.license_labels(docs, templates=[], phrases=[])
    assert rows(got.select("doc_id", "n_words", "labels")) == [(1, 21, ""), (2, 1, ""), (3, 0, "")]


def test_rare_words_come_first(spark):
    docs = frame(spark, [(1, "the of the of zymurgy"), (2, "the of"), (3, "the")])
    ready = licenses._template_rows(spark, [("x", "the zymurgy of the")]).collect()
    counts = licenses._counts(docs, "text", ["of", "the", "zymurgy"])
    assert counts == {"the": 4, "of": 3, "zymurgy": 1}
    assert [(t["words"], t["need"], t["prefix"]) for t in licenses.prefixes(ready, counts, 60)] == [(["zymurgy", "of", "the"], 2, ["zymurgy", "of"])]


def test_messy_and_empty_tables(messy, empty, rows):
    want = [expected(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    assert rows(licenses.license_labels(messy)) == sorted(want, key=repr)
    assert rows(licenses.license_labels(empty)) == []
    clashing = empty.selectExpr("doc_id", "text", "1 _row", "2 _keep", "3 _words", "4 places", "5 _pieces", "6 hits", "7 rank", "8 label")
    assert licenses.license_labels(clashing).columns == COLUMNS


def test_plan_has_no_python(spark, messy):
    found = licenses.license_labels(messy.select("doc_id", "text"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas"))
