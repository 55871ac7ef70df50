"""Tables that hold every awkward case at once."""

from __future__ import annotations

import pytest

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, _row string, node string, sha string"


@pytest.fixture(scope="module")
def messy(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    long = " ".join(f"word{i % 977} tail{i}" for i in range(12_000))
    texts = [
        (1, "Alpha beta gamma delta epsilon zeta eta theta", "b"), (2, "alpha BETA gamma delta epsilon zeta eta theta", "a"),
        (2, "alpha BETA gamma delta epsilon zeta eta theta", "a"), (3, None, "a"), (4, "", None), (5, "  \t\n", "a"),
        (6, "one", "a"), (7, long, "b"), (8, long + " more", "b"), (None, "no id at all here", "a"), (9, "ÄÖ straße İ", None),
        (10, "tie tie tie tie tie tie tie", "c"), (11, "tie tie tie tie tie tie tie", "c"), (2, "another text with the same id", "c"),
    ]
    rows = [(i, t, None if i == 6 else "en", s, len(t or ""), 5, "k", "r", "n", None) for i, t, s in texts]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="module")
def empty(messy):
    """The same columns without rows."""
    return messy.where("false")
