"""Scores for a stream of texts, and alerts for those that are probably negative."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from stayscope.operators.models import score_texts


def negative_alerts(model: Model, texts: DataFrame, threshold: float, text: str = "text") -> DataFrame:
    """Texts whose chance of being negative exceeds `threshold`; for tables and for streams.

    The condition looks at the finished row: as a filter, Spark would move it below the model and score each text twice.
    """
    scored = score_texts(model, texts, text)
    row = F.struct(*scored.columns)
    return scored.select(F.inline(F.filter(F.array(row), lambda r: r["p_negative"] > threshold)))


def score_stream(
    model: Model, stream: DataFrame, threshold: float, path: str, checkpoint: str, text: str = "text"
) -> StreamingQuery:
    """Write the alerts of a stream as parquet, once each, and stop when the input is used up.

    Rows are scored on their own, so there is no state to keep and nothing to shuffle.
    """
    return (
        negative_alerts(model, stream, threshold, text)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
