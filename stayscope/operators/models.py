"""Regressors and classifiers on feature vectors, and text classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    NGram,
    StopWordsRemover,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.operators.metrics import class_metrics, regression_metrics
from stayscope.sources.checkpoints import cut_lineage


def regressors(
    features: str = "features", label: str = "label", trees: int = 100, rounds: int = 100, seed: int = 42
) -> dict[str, Estimator]:
    """Linear regression, random forest and gradient-boosted trees."""
    cols = {"featuresCol": features, "labelCol": label}
    return {
        "Linear Regression": LinearRegression(**cols),
        "Random Forest": RandomForestRegressor(**cols, numTrees=trees, seed=seed),
        "Gradient Boosted Trees": GBTRegressor(**cols, maxIter=rounds, seed=seed),
    }


def classifiers(
    n_features: int, n_classes: int = 5, features: str = "features", label: str = "label",
    trees: int = 100, seed: int = 42,
) -> dict[str, Estimator]:
    """Logistic regression, decision tree, random forest and a perceptron with ten hidden units."""
    cols = {"featuresCol": features, "labelCol": label}
    return {
        "Logistic Regression": LogisticRegression(**cols, maxIter=100),
        "Decision Tree": DecisionTreeClassifier(**cols, seed=seed),
        "Random Forest": RandomForestClassifier(**cols, numTrees=trees, seed=seed),
        "Multilayer Perceptron": MultilayerPerceptronClassifier(
            **cols, layers=[n_features, 10, n_classes], maxIter=100, seed=seed
        ),
    }


def fit_prepared(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit a pipeline whose first stages learn nothing, with what they make of the rows stored once.

    Estimators read their input several times and would have every text cut, cleaned and hashed again each
    time. Only the columns that the later stages name are stored, so no text takes the place of their caches.
    """
    stages = pipeline.getStages()
    learnt = next((i for i, stage in enumerate(stages) if not isinstance(stage, Transformer)), len(stages))
    made = PipelineModel(stages[:learnt]).transform(train)
    given = [s.getOrDefault(p) for s in stages[learnt:] for p in s.params if "Col" in p.name and s.isDefined(p)]
    named = {c for value in given for c in (value if isinstance(value, list) else [value])}
    stored = cut_lineage(made.select(*[c for c in made.columns if c in named]))
    return PipelineModel([*stages[:learnt], *Pipeline(stages=stages[learnt:]).fit(stored).stages])


def fit_texts(train: DataFrame, ngrams: Sequence[int] = (1,), features: int = 10_000) -> PipelineModel:
    """The text classifier fitted on texts and labels; see `sentiment_model`."""
    return fit_prepared(sentiment_model(ngrams, features), train)


def fit_all(train: DataFrame, estimators: Mapping[str, Estimator]) -> dict[str, Model]:
    """Fit every estimator on one cached copy of the training rows."""
    train = train.persist()
    try:
        return {name: estimator.fit(train) for name, estimator in estimators.items()}
    finally:
        train.unpersist()


def _compared(models: Mapping[str, Model], test: DataFrame, metrics) -> DataFrame:
    rows = [
        metrics(model.transform(test)).select(F.lit(name).alias("name"), "*")
        for name, model in models.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def compare_regressors(
    train: DataFrame, test: DataFrame, estimators: Mapping[str, Estimator], label: str = "label"
) -> DataFrame:
    """Fit each estimator and report it on the test rows: (name, rmse, r2)."""
    models = fit_all(train, estimators)
    return _compared(models, test, lambda p: regression_metrics(p, label, "prediction"))


def compare_classifiers(
    train: DataFrame, test: DataFrame, estimators: Mapping[str, Estimator], label: str = "label"
) -> DataFrame:
    """Fit each estimator and report it on the test rows: (name, accuracy, f1)."""
    models = fit_all(train, estimators)
    scored = _compared(models, test, lambda p: class_metrics(p, label, "prediction"))
    return scored.select("name", "accuracy", "f1")


def importances(model: Model, cols: Sequence[str], df: DataFrame) -> DataFrame:
    """Feature importances of a tree model: (feature, importance); `df` lends its session."""
    rows = [(c, float(v)) for c, v in zip(cols, model.featureImportances.toArray(), strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def actual_vs_predicted(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Label and prediction side by side."""
    return df.select(F.col(pred).alias("prediction"), F.col(label).alias("label"))


def sentiment_model(
    ngrams: Sequence[int] = (1,), features: int = 10_000, text: str = "text", label: str = "label"
) -> Pipeline:
    """Text classifier: tokens without stop words, hashed n-gram weights, logistic regression.

    The hashed features are shared out evenly over the n-gram sizes.
    """
    stages = [
        Tokenizer(inputCol=text, outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="terms_1"),
    ]
    hashed = []
    for n in ngrams:
        if n > 1:
            stages.append(NGram(n=n, inputCol="terms_1", outputCol=f"terms_{n}"))
        hashed.append(f"hashed_{n}")
        stages.append(
            HashingTF(inputCol=f"terms_{n}", outputCol=hashed[-1], numFeatures=features // len(ngrams))
        )
    raw = hashed[0]
    if len(hashed) > 1:
        raw = "hashed"
        stages.append(VectorAssembler(inputCols=hashed, outputCol=raw))
    stages += [
        IDF(inputCol=raw, outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label),
    ]
    return Pipeline(stages=stages)


def score_texts(model: Model, df: DataFrame, text: str = "text") -> DataFrame:
    """Add to each text the predicted label and the probability of label 0 and of label 1; NULL for NULL."""
    given = df.select(F.struct(*df.columns).alias("_row"), F.coalesce(text, F.lit("")).alias("text"))
    chance = vector_to_array("probability")
    there = F.col("_row")[text].isNotNull()
    return model.transform(given).select(
        *[F.col("_row")[c].alias(c) for c in df.columns],
        F.when(there, F.col("prediction")).alias("prediction"),
        F.when(there, F.get(chance, F.lit(0))).alias("p_negative"),
        F.when(there, F.get(chance, F.lit(1))).alias("p_positive"),
    )
