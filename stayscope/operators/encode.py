"""Category indices by falling frequency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.operators.joins import attach
from stayscope.operators.ordering import row_numbers
from stayscope.sources.checkpoints import cut_lineage


def index_labels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The values of each column with their index: (column, value, index).

    The most frequent value has index 0, equal counts are alphabetical. All columns are counted
    in one pass over the rows; their distinct values, of which there may be as many as rows, are
    ranked by one distributed sort.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    )
    counts = (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = cut_lineage(row_numbers(counts, ["column", F.desc("_n"), "value"], "_row"))
    first = ranked.groupBy("column").agg(F.min("_row").alias("_first"))  # one row per column
    index = (F.col("_row") - F.col("_first")).cast("double")
    return ranked.join(F.broadcast(first), "column").select("column", "value", index.alias("index"))


def apply_index(df: DataFrame, labels: DataFrame, outs: Mapping[str, str]) -> DataFrame:
    """Add to each column in `outs` its index under the given name.

    NULL and values without a label take the number of labels of their column. `labels` holds a value of
    a column once; rows do not move for an index that nothing uses later.
    """
    for col, out in outs.items():
        mine = labels.where(F.col("column") == col)
        unknown = mine.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
        key = f"_{col}_key"
        table = mine.select(F.col("value").alias(key), F.col("index").alias(out))
        coded = attach(df.withColumn(key, F.col(col).cast("string")), table, key, unique=True)
        df = coded.select(*df.columns, F.coalesce(F.col(out), unknown).alias(out))
    return df


def index_category(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add the frequency index of one column."""
    return index_categories(df, {col: out})


def index_categories(df: DataFrame, outs: Mapping[str, str]) -> DataFrame:
    """Add the frequency index of several columns, ranked together."""
    return apply_index(df, index_labels(df, list(outs)), outs)
