"""What reviews move: digests instead of texts, and nothing for an index that is not used."""

from __future__ import annotations

import pytest
from catalogue import learning
from pyspark.sql import functions as F

from stayscope.operators import encode as E
from stayscope.operators import joins as J
from stayscope.plans import reviews as R


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def raw(spark):
    """Reviews with NULLs, repeats, zeros of both signs and rows that differ in one text or one missing value only."""
    rows = []
    for i in range(120):
        text = [None, "", "N/A", "Nothing", "not at all", "The room was small", 'a "quoted", text', "No Negative"][i % 8]
        other = [None, "Lovely staff", "na", "No Positive", "fine, fine"][i % 5]
        rows.append((f"Street {i % 3}" if i % 7 else None, i % 4, "1/2/2017", [0.0, -0.0, 8.5, None][i % 4], f"H{i % 2}", " x ", text, 3,
                     9 if i % 6 else None, other, 2, i % 2, [5.0, float("nan"), None][i % 3], "['a', 'b']", "3 days", "NA", "1.5"))
    return spark.createDataFrame(rows * 2, R.RAW_SCHEMA)


def test_digests_tell_the_same_rows_apart(spark, raw, rows):
    cols = [*R.REVIEW_SEGMENT_FEATURES, *R.HOTEL_COLUMNS]
    moved = R.repair_to(raw, lambda df: R.tokenised(R.typed(df)), cols)
    whole = R.tokenised(R.typed(R.repair(raw))).select(*cols)
    assert moved.columns == whole.columns and repr(rows(moved)) == repr(rows(whole)) and whole.count() > whole.distinct().count()


def test_texts_are_not_moved(spark, raw, rows, monkeypatch):
    monkeypatch.setattr(learning, "raw_reviews", lambda *_: raw)
    monkeypatch.setattr(learning, "table", lambda *_: raw)
    few = learning._cleaned(spark, "x", R.REVIEW_SEGMENT_FEATURES)
    monkeypatch.setattr(learning, "WHOLE_LINES", 10)
    many = learning._cleaned(spark, "x", R.REVIEW_SEGMENT_FEATURES)
    assert repr(rows(few)) == repr(rows(many))

    def moved(df):
        return next(line for line in _plan(df).splitlines() if "hashpartitioning" in line)

    assert "Positive_Review" in moved(few) and "Review#" not in moved(many) and "_whole" in moved(many)


def test_an_index_that_is_not_used_moves_nothing(spark, rows, monkeypatch):
    df = spark.range(300).select("id", F.concat(F.lit("v"), (F.col("id") % 40).cast("string")).alias("v"))
    expected = rows(E.index_categories(df, {"v": "code"}))
    monkeypatch.setattr(J, "fits_broadcast", lambda *_: False)
    coded = E.index_categories(df, {"v": "code"})
    assert rows(coded) == expected and "SortMergeJoin" in _plan(coded)
    assert "Join" not in _plan(coded.select("id", "v"))
