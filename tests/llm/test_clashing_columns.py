"""Stages of the pipeline carry columns of any name."""

from __future__ import annotations

import pytest

from stayscope.llm import exact_dedup, mixing, similar

NAMES = "_lost _id _sha _gone _row _n _copy _node node label component_id _lost_doc_id size n sha keep_id carried_column_0".split()


@pytest.mark.parametrize("stage", [exact_dedup.without_copies, similar.one_of_each, mixing.mixed_documents])
def test_columns_of_helpers_names(spark, stage):
    texts = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "other words that share an id here"), (3, None), (4, "h i j k l m n o")]
    docs = spark.createDataFrame([(i, t, "s", *[f"{i}{c}" for c in NAMES]) for i, t in texts], ["doc_id", "text", "source", *NAMES])
    plain = docs.select("doc_id", "text", "source")
    got = stage(docs)
    assert got.columns == docs.columns
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    assert all(list(r[3:]) == [f"{r[0]}{c}" for c in NAMES] for r in found)
    assert [r[:3] for r in found] == sorted((tuple(r) for r in stage(plain).collect()), key=repr)
