"""Per-entity feature tables and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_dimension(df: DataFrame, dim: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Inner join with a dimension table on `key`.

    A key that stands for several dimension rows multiplies; with `unique` it fails the query.
    """
    if unique:
        rest = [c for c in dim.columns if c != key]
        rows = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_d"))
        problem = F.raise_error(F.concat(F.lit("several rows for "), F.col(key).cast("string")))
        single = F.when(F.col("_n") == 1, F.col("_d")).otherwise(problem.cast(rows.schema["_d"].dataType))
        dim = rows.select(key, single.alias("_d")).select(key, "_d.*")
    return df.join(dim, key)


def entity_features(
    df: DataFrame,
    key: str,
    mean_cols: Sequence[str],
    min_rows: int = 30,
    dim: DataFrame | None = None,
) -> DataFrame:
    """Means and row count of every entity with more than `min_rows` rows, in one aggregation."""
    stats = df.groupBy(key).agg(
        *[F.avg(c).alias(f"avg_{c}") for c in mean_cols], F.count(F.lit(1)).alias("review_count")
    )
    stats = stats.where((F.col("review_count") > min_rows) & F.col(key).isNotNull())
    return stats if dim is None else attach_dimension(stats, dim, key)


def assemble(
    df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error"
) -> DataFrame:
    """Add one vector of the columns; a missing value is an error, skipped or kept."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def project_2d(df: DataFrame, features: str = "features") -> DataFrame:
    """Add the first two principal components as pc1 and pc2."""
    model = PCA(k=2, inputCol=features, outputCol="_pca").fit(df)
    placed = model.transform(df).withColumn("_pca", vector_to_array("_pca"))
    return placed.withColumns({"pc1": F.get("_pca", F.lit(0)), "pc2": F.get("_pca", F.lit(1))}).drop("_pca")
