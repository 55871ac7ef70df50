"""The number of a row's segment as a feature, learnt with the model and on the same rows only."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler

CLUSTERERS = {"kmeans": KMeans, "bisecting": BisectingKMeans}


def with_segments(
    estimator: Estimator, k: int, method: str = "kmeans", scale: bool = True, keep: bool = True, seed: int = 42
) -> Pipeline:
    """An estimator that also sees the segment of each row, as k - 1 columns of 0 and 1.

    Scaler, clusterer and estimator are stages of one pipeline, so a fit on the training folds
    (`validation.out_of_fold`, `fit_folds`) never learns a segment from a held-out row, and a saved
    model places new rows itself. Segment 0 is the row of zeros, which keeps the columns independent
    of an intercept; a segment without training rows is an ordinary column of zeros. Without `keep`
    the estimator sees nothing but the segment. `features` with a missing value fail in the
    clusterer: skip or fill them when they are assembled.
    """
    if k < 2:
        raise ValueError("one segment tells nothing")
    source = estimator.getFeaturesCol()
    placed, spread, made = (f"{source}__{part}" for part in ("segment", "scaled", "with_segment"))
    hot = [f"{placed}_{i}" for i in range(1, k)]
    stages: list = [StandardScaler(inputCol=source, outputCol=spread, withMean=True)] if scale else []
    clusterer = CLUSTERERS[method](featuresCol=spread if scale else source, predictionCol=placed, k=k, seed=seed)
    flags = ", ".join(f"CAST(`{placed}` = {i} AS DOUBLE) AS `{c}`" for i, c in enumerate(hot, 1))
    stages += [
        clusterer,
        SQLTransformer(statement=f"SELECT *, {flags} FROM __THIS__"),
        VectorAssembler(inputCols=[source, *hot] if keep else hot, outputCol=made),
        estimator.copy({estimator.featuresCol: made}),
    ]
    return Pipeline(stages=stages)


def with_and_without(estimators: dict[str, Estimator], k: int, **options) -> dict[str, Estimator]:
    """Every estimator as it is and with segments, by name, for one table of out-of-fold errors."""
    return {
        name: made
        for plain, e in estimators.items()
        for name, made in ((plain, e), (f"{plain} + {k} segments", with_segments(e, k, **options)))
    }
