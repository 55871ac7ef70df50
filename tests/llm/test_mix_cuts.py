"""The mix by one cut key per source, against what `mix` takes of every row."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayscope.llm import mixing
from stayscope.llm.tokens import WordTokenizer, widened
from stayscope.operators import joins

KIND = "doc_id long, text string, source string, n_chars long, row string, key string, part int, epochs int, left int, id int, n int, first int, cut string"


def some_docs(seed, copies):
    pick, docs = random.Random(seed), []
    for i in range(300):
        text = pick.choice(["", " "]) + "  ".join(f"w{pick.randrange(50)}" for _ in range(pick.randint(0, 12)))
        docs.append((i, pick.choice([text, text, None]), pick.choice(["a", "a", "a", "b", "c", None])))
    docs += [(900, "same words here again", "a")] * copies + [(901, "one", "=")] * 3 + [(902, "x y z", "")] * 2
    return [(*d, 1, "r", "k", 5, 6, 7, 8, 9, 10, "zz") for d in docs]


@pytest.mark.parametrize("seed,copies,rows_of_range", [(1, 0, 100_000), (2, 400, 100_000), (3, 40, 0.01)])
def test_documents_are_those_that_the_mix_takes(spark, seed, copies, rows_of_range, monkeypatch):
    docs = spark.createDataFrame(some_docs(seed, copies), KIND)
    monkeypatch.setattr(mixing.source_cuts, "__defaults__", (*mixing.source_cuts.__defaults__[:-1], rows_of_range))
    taken = mixing.mix(mixing.keyed(docs)).groupBy("doc_id", "source").agg(F.sum("taken").alias("n"))
    want = {(r.doc_id, r.source): r.n for r in taken.collect() if r.n}
    got, texts = Counter(), {r.doc_id: r.text for r in docs.collect()}
    out = mixing.mixed_documents(docs)
    assert out.schema == docs.schema
    whole = re.compile(r"[^\x20\x09-\x0D]+")
    for r in out.collect():
        got[r.doc_id, r.source] += len(whole.findall(r.text))
        assert texts[r.doc_id].lstrip().startswith(r.text.lstrip()) and (r.row, r.part, r.cut) == ("r", 5, "zz")
        assert r.n_chars == (1 if r.text == texts[r.doc_id] else len(r.text))
    assert got == want


def test_without_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame(some_docs(4, 30), KIND)
    one = Counter((r.doc_id, r.text) for r in mixing.mixed_documents(docs).collect())
    monkeypatch.setattr(mixing, "fits_broadcast", lambda _: False)
    monkeypatch.setattr(joins, "fits_broadcast", lambda *_: False)
    assert Counter((r.doc_id, r.text) for r in mixing.mixed_documents(docs).collect()) == one


def test_texts_are_not_moved(spark, messy):
    plan = mixing.mixed_documents(messy)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange rangepartitioning" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the first number per source at a cut


def test_ids_widen_and_narrow_vocabularies_are_checked(tmp_path):
    lists = [[1, 2], [], [65535], [7, 8, 9]]
    ids = pa.array([np.array(x, dtype="<u2").tobytes() for x in lists], pa.binary())
    for at in range(5):
        assert [np.frombuffer(x, "<u4").tolist() for x in widened(ids[at:], 2).to_pylist()] == lists[at:]
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Ünïcode words, and 12 more <|x|>"
    two, four = (np.frombuffer(WordTokenizer(path, width=w).ids(text), f"<u{w}").tolist() for w in (2, 4))
    assert two == four
    with pytest.raises(ValueError, match="bytes"):
        WordTokenizer(path, width=1)
