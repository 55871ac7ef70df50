"""Hotels whose remarks of one side all say nothing take part in every model and clustering."""

from __future__ import annotations

import pytest
from catalogue import growing, learning
from pyspark.sql import functions as F

MEANS = {*learning.R.REGRESSION_FEATURES, *learning.R.STAR_FEATURES, *learning.R.SEGMENT_FEATURES}
N = 60


@pytest.fixture()
def hotels(spark, monkeypatch):
    """Sixty hotels; every tenth has no mean of words on one side."""
    i = F.col("id")
    rows = spark.range(N).withColumns({c: ((i * (k + 3)) % 11 + 1).cast("double") for k, c in enumerate(sorted(MEANS))})
    rows = rows.withColumns({
        "Hotel_Name": F.concat(F.lit("h"), i.cast("string")), "Hotel_Address": F.lit("a"),
        "avg_Negative_Lemma_Count": F.when(i % 20 != 0, (i % 7).cast("double")),
        "avg_Positive_Lemma_Count": F.when(i % 20 != 10, (i % 5).cast("double")),
    })
    rows = learning.R.with_stars(rows)
    few = learning.L.regressors(trees=2, rounds=2)
    monkeypatch.setattr(learning.L, "regressors", lambda: few)
    for module in (learning, growing):
        monkeypatch.setattr(module, "_hotels", lambda *_: rows)
    return rows


def test_no_words_are_zero_words(spark, hotels):
    filled = learning._hotel_rows(spark, "")
    got = {r["id"]: (r["avg_Positive_Lemma_Count"], r["avg_Negative_Lemma_Count"]) for r in filled.collect()}
    assert got == {i: (float(i % 5) if i % 20 != 10 else 0.0, float(i % 7) if i % 20 else 0.0) for i in range(N)}
    assert filled.columns == hotels.columns
    missing = hotels.withColumn("avg_Num_Tags", F.lit(None).cast("double"))
    assert learning.R.without_words_zero(missing).where("avg_Num_Tags IS NULL").count() == N


def held_out(hotels):
    return learning.hash_split(hotels, ["Hotel_Name", "Hotel_Address"], [0.8, 0.2])[1].count()


# What each query says of how many rows or hotels it took, and what that must be.
WHOLE = {
    "actual_and_predicted_scores": (lambda df: df.count(), held_out),
    "hotel_score_regressors": (lambda df: [r["n"] for r in df.collect()], lambda hotels: [held_out(hotels)] * 3),
    "hotel_scores_with_segments": (lambda df: [r["n"] for r in df.groupBy("params").agg(F.sum("n").alias("n")).collect()], [N] * 4),
    "hotel_segment_means": (lambda df: df.count(), 4),
    "hotel_segments": (lambda df: {r["method"]: r["n"] for r in df.groupBy("method").agg(F.sum("n").alias("n")).collect()}, {"kmeans": N, "bisecting": N}),
    "hotels_in_two_dimensions": (lambda df: {r["Hotel_Name"] for r in df.collect()}, {f"h{i}" for i in range(N)}),
    "misjudged_hotels": (lambda df: df.where("avg_Average_Score IS NULL").count(), 0),
    "segment_elbow": (lambda df: [r["k"] for r in df.collect()], [2, 3, 4, 5, 6, 7, 8]),
    "segment_silhouettes": (lambda df: {r["method"] for r in df.collect()}, {"kmeans", "bisecting"}),
    "star_classifiers": (lambda df: df.count(), 4),
    "star_importances": (lambda df: df.count(), len(learning.R.STAR_FEATURES)),
}


@pytest.mark.parametrize("name", WHOLE)
def test_every_hotel_takes_part(spark, hotels, name):
    found, expected = WHOLE[name]
    query = getattr(learning, name, None) or getattr(growing, name)
    got = found(query(spark, ""))
    assert got == (expected(hotels) if callable(expected) else expected)
