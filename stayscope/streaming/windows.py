"""Alerts per entity and stretch of time, on a stream of reviews that may repeat or come late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from stayscope.operators.models import score_texts


def once(reviews: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Reviews without repeats: rows of one key and time count once, for tables and for streams.

    A stream remembers keys until the watermark, `delay` behind the latest time seen, passes them; what
    comes later still is dropped, so repeats never count and the state holds `delay` worth of keys.
    Rows without a time can't be placed and are left out.
    """
    return reviews.where(F.col(time).isNotNull()).withWatermark(time, delay).dropDuplicates([*key, time])


def windowed_counts(
    reviews: DataFrame, entity: str, key: Sequence[str], time: str, flagged: Column, width: str, delay: str
) -> DataFrame:
    """Per entity and window of `width`: window_start, window_end, the entity, n and how many are flagged.

    On a stream a window comes out once, when the watermark passes its end. A flag that is NULL is not set.
    """
    rows = once(reviews.withColumn("__flagged", F.coalesce(flagged, F.lit(False))), key, time, delay)
    counted = rows.groupBy(F.window(time, width).alias("__window"), entity).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("__flagged").alias("flagged")
    )
    ends = F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end")
    return counted.select(*ends, entity, "n", "flagged")


def closed_windows(counts: DataFrame, reviews: DataFrame, time: str, delay: str) -> DataFrame:
    """The windows of a table that a stream over its rows would have sent when its input ends."""
    latest = reviews.agg((F.max(time) - F.expr(f"INTERVAL {delay}")).alias("t")).scalar()
    return counts.where(F.col("window_end") <= latest)


def window_alerts(counts: DataFrame, share: float, least: int = 1) -> DataFrame:
    """Windows with `least` reviews or more of which at least this share is flagged."""
    return counts.where((F.col("n") >= least) & (F.col("flagged") >= share * F.col("n")))


def negative_windows(
    model: Model, reviews: DataFrame, entity: str, key: Sequence[str], time: str, width: str, delay: str,
    threshold: float = 0.9, text: str = "text",
) -> DataFrame:
    """`windowed_counts` of texts whose chance of being negative exceeds `threshold`."""
    flagged = F.col("p_negative") > threshold
    return windowed_counts(score_texts(model, reviews, text), entity, key, time, flagged, width, delay)


def write_windows(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write closed windows as parquet, once each, and stop when the input is used up.

    Started again with the same checkpoint it goes on with the open windows and known keys.
    """
    return (
        counts.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
