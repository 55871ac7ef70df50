"""Segmentation of rows by numeric features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.operators.features import assemble
from stayscope.operators.quality import map_columns


def cluster_input(
    df: DataFrame, cols: Sequence[str], nulls: str = "error", scale: bool = False
) -> DataFrame:
    """Rows with a `features` vector; missing values fail (`error`), drop the row (`skip`) or are 0 (`zero`)."""
    if nulls == "zero":
        df = map_columns(df, cols, lambda c: F.coalesce(c, F.lit(0)))
    raw = "_unscaled" if scale else "features"
    vectors = assemble(df, cols, raw, "skip" if nulls == "skip" else "error")
    if not scale:
        return vectors
    scaler = StandardScaler(inputCol=raw, outputCol="features", withMean=True)
    return scaler.fit(vectors).transform(vectors).drop(raw)


def segment(
    df: DataFrame,
    cols: Sequence[str],
    k: int,
    method: str = "kmeans",
    seed: int = 42,
    nulls: str = "error",
    scale: bool = False,
) -> DataFrame:
    """Add `features` and the `cluster` of each row, by k-means or ``method="bisecting"``."""
    estimator = {"kmeans": KMeans, "bisecting": BisectingKMeans}[method]
    rows = cluster_input(df, cols, nulls, scale)
    held = rows.persist()
    try:
        model = estimator(featuresCol="features", predictionCol="cluster", k=k, seed=seed).fit(held)
    finally:
        held.unpersist()
    return model.transform(rows)


def elbow(
    df: DataFrame,
    cols: Sequence[str],
    ks: Sequence[int] = tuple(range(2, 9)),
    seed: int = 42,
    nulls: str = "error",
) -> DataFrame:
    """Sum of squared distances to the cluster centres for each number of clusters: (k, wss)."""
    held = cluster_input(df, cols, nulls).select("features").persist()
    try:
        costs = [(k, KMeans(k=k, seed=seed).fit(held).summary.trainingCost) for k in ks]
    finally:
        held.unpersist()
    return df.sparkSession.createDataFrame(costs, "k int, wss double")


def silhouette(df: DataFrame, cluster: str = "cluster", features: str = "features") -> float:
    """Mean silhouette under squared Euclidean distance."""
    evaluator = ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, metricName="silhouette", distanceMeasure="squaredEuclidean"
    )
    return evaluator.evaluate(df)


def cluster_profile(
    df: DataFrame, cluster: str, cols: Sequence[str], normalise: bool = False
) -> DataFrame:
    """Mean of each feature per cluster; normalised, each feature runs from 0 to 1 over the clusters."""
    means = df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols])
    if not normalise:
        return means
    spans = means.agg(
        F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]).alias("s")
    ).scalar()
    at = {c: F.col(f"_span.{c}") for c in cols}
    return means.withColumn("_span", spans).select(
        cluster,
        *[F.try_divide(F.col(c) - at[c]["lo"], at[c]["hi"] - at[c]["lo"]).alias(c) for c in cols],
    )
