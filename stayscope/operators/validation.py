"""Cross-validation: folds by hash, grid points fitted side by side, every row predicted once per point."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.operators.sampling import hash_position
from stayscope.sources.checkpoints import cut_lineage

FOLD = "fold"


def fold_of(key: str | Sequence[str], k: int, salt: str = "folds") -> Column:
    """Number of a row's fold, from 0, by its key alone: rows with one key are never on both sides."""
    return (hash_position(key, salt) % k).cast("int")


def grid(estimator: Estimator, choices: Mapping[str, Mapping]) -> dict[str, Estimator]:
    """Copies of an estimator by name, each with the parameters (name: value) of one point of a grid."""
    return {name: estimator.copy({estimator.getParam(p): v for p, v in given.items()}) for name, given in choices.items()}


def fit_folds(rows: DataFrame, estimators: Mapping[str, Estimator], k: int, at_once: int = 4) -> dict[tuple[str, int], Model]:
    """A model per estimator and fold that has not seen the fold; `rows` has its fold and is stored."""
    tasks = [(name, i) for i in range(k) for name in estimators]

    def fit(task: tuple[str, int]) -> Model:
        return estimators[task[0]].fit(rows.where(F.col(FOLD) != task[1]))

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tasks, pool.map(inheritable_thread_target(rows.sparkSession)(fit), tasks), strict=True))


def out_of_fold(
    df: DataFrame, estimators: Mapping[str, Estimator], key: str | Sequence[str], label: str = "label",
    k: int = 5, features: str = "features", salt: str = "folds", at_once: int = 4,
) -> DataFrame:
    """Predictions of rows by models that have not seen them: params, fold, the key, label, prediction.

    The assembled table is stored once and read by all fits, of which `at_once` run side by side; at most
    estimators x folds models are held. A fold without rows gives none. Rows with a NULL label are left out.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.where(F.col(label).isNotNull()).select(*keys, label, features, fold_of(keys, k, salt).alias(FOLD))
    rows = cut_lineage(rows)
    parts = []
    for (name, i), model in fit_folds(rows, estimators, k, at_once).items():
        found = model.transform(rows.where(F.col(FOLD) == i))
        parts.append(found.select(F.lit(name).alias("params"), FOLD, *keys, F.col(label).alias("label"), "prediction"))
    return reduce(DataFrame.unionByName, parts)


def fold_errors(predictions: DataFrame) -> DataFrame:
    """Per point and fold: params, fold, n, rmse, r2 (NULL for a fold of one label), in one pass."""
    error = F.col("label") - F.col("prediction")
    spread = F.var_pop("label")
    return predictions.groupBy("params", FOLD).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.when(spread > 0, 1 - F.avg(error * error) / spread).alias("r2"),
    )


def fold_hits(predictions: DataFrame) -> DataFrame:
    """Per point and fold: params, fold, n, accuracy."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return predictions.groupBy("params", FOLD).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def best_point(metrics: DataFrame, metric: str, larger: bool = False) -> str | None:
    """The point with the best mean of a metric over its folds, each weighted by its rows; ties by name."""
    mean = F.sum(F.col(metric) * F.col("n")) / F.sum(F.when(F.col(metric).isNotNull(), F.col("n")))
    ranked = metrics.groupBy("params").agg(mean.alias("mean")).where("mean IS NOT NULL")
    best = ranked.orderBy(F.desc("mean") if larger else F.asc("mean"), "params").first()
    return best and best["params"]
