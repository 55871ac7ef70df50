"""Quality of predictions as tables, counted in one pass over labels and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.operators.ordering import running_totals


def confusion(
    df: DataFrame, label: str, pred: str, pivot: Sequence[float] | None = None
) -> DataFrame:
    """Rows per label and prediction; with `pivot`, one column per prediction and 0 for none."""
    if pivot is None:
        return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    return df.groupBy(label).pivot(pred, list(pivot)).agg(F.count(F.lit(1))).fillna(0)


def binary_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: true and false positives and negatives."""

    def both(a: int, b: int) -> object:
        return F.count_if((F.col(label) == a) & (F.col(pred) == b))

    return df.agg(
        both(1, 1).alias("tp"), both(0, 0).alias("tn"), both(0, 1).alias("fp"), both(1, 0).alias("fn")
    )


def label_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per label: precision, recall, f1 and number of rows.

    Everything derives from the label-by-prediction counts, a table as small as the labels.
    """
    cells = (
        df.select(F.col(label).cast("double").alias("l"), F.col(pred).cast("double").alias("p"))
        .groupBy("l", "p")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ends = F.array(
        F.struct(F.col("l").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("guessed")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("guessed")),
    )
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(F.lit(0)) / 2
    sums = (
        cells.select(hit.alias("hit"), F.inline(ends))
        .groupBy("label")
        .agg(F.sum("hit").alias("hit"), F.sum("actual").alias("rows"), F.sum("guessed").alias("guessed"))
    )
    none = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hit", F.col("guessed").cast("double")), none)
    recall = F.coalesce(F.try_divide("hit", F.col("rows").cast("double")), none)
    both = F.col("precision") + F.col("recall")
    return (
        sums.select("label", precision.alias("precision"), recall.alias("recall"), "rows", "hit")
        .withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), none))
        .select("label", "precision", "recall", "f1", "rows", "hit")
    )


def class_metrics(
    df: DataFrame, label: str, pred: str, positive: float | None = None
) -> DataFrame:
    """One row: accuracy and the label-weighted f1, precision and recall.

    With `positive`, also precision and recall of that label.
    """
    per_label = label_metrics(df, label, pred)
    total = F.sum("rows")

    def weighted(c: str) -> object:
        return F.try_divide(F.sum(F.col(c) * F.col("rows")), total)

    values = [
        F.try_divide(F.sum("hit"), total.cast("double")).alias("accuracy"),
        weighted("f1").alias("f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
    ]
    if positive is not None:
        mine = F.col("label") == float(positive)
        values += [
            F.max(F.when(mine, F.col("precision"))).alias("precision_of_label"),
            F.max(F.when(mine, F.col("recall"))).alias("recall_of_label"),
        ]
    return per_label.agg(*values)


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: root mean squared error, share of explained variance, rows used and rows left out.

    Left out are rows without label or prediction, such as pairs a recommender has no factors for.
    """
    actual, guess = F.col(label).cast("double"), F.col(pred).cast("double")
    there = guess.isNotNull() & ~F.isnan(guess)
    actual = F.when(there, actual)
    error = (actual - guess) * (actual - guess)
    spread = F.var_pop(actual) * F.count(actual)
    return df.agg(
        F.sqrt(F.avg(error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error), spread)).alias("r2"),
        F.count(actual).alias("n"),
        (F.count(F.lit(1)) - F.count(actual)).alias("left_out"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: exact area under the ROC curve; equal scores count half.

    Rows are counted per distinct score first; the ranks then come from distributed running
    totals, so neither many equal scores nor many different ones meet in one task.
    """
    positive = F.col(label).cast("double") > 0.5
    scored = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranked = running_totals(scored, ["score"], {"below": "neg"})
    wins = F.col("pos") * (F.col("below") - F.col("neg") / 2.0)
    area = F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg"))
    return ranked.agg(area.alias("auc"))


def misclassified(df: DataFrame, label: str, pred: str, cols: Sequence[str]) -> DataFrame:
    """Rows whose prediction differs from the label."""
    return df.where(F.col(label) != F.col(pred)).select(*cols, label, pred)

