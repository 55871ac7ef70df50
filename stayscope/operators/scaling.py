"""Scalers as small tables: fitted in one pass, saved, and applied as expressions to tables and streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.operators.ordering import quantiles

KINDS = ("standard", "minmax", "quantile")


def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "standard", probs: tuple[float, float, float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What to take off each column and what to divide by then: column, shift, scale, a row per column.

    `standard`: mean and population deviation; `minmax`: least value and range; `quantile`: the middle of
    three exact quantiles and the distance of the outer ones. NULL and NaN are left out; a constant
    column is divided by 1, a column without values has NULLs. One pass over the table whatever the number of columns.
    """
    if kind not in KINDS:
        raise ValueError(f"{kind} is none of {KINDS}")
    if kind == "quantile":
        found = quantiles(df, cols, probs).select("column", F.col("q1").alias("shift"), (F.col("q2") - F.col("q0")).alias("scale"))
        names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
        found = names.join(found, "column", "left")
    else:
        ends = []
        for i, c in enumerate(cols):
            value = F.col(c).cast("double")
            value = F.when(~F.isnan(value), value)
            shift = F.avg(value) if kind == "standard" else F.min(value)
            scale = F.stddev_pop(value) if kind == "standard" else F.max(value) - F.min(value)
            ends += [shift.alias(f"_a{i}"), scale.alias(f"_b{i}")]
        lines = [F.struct(F.lit(c).alias("column"), F.col(f"_a{i}").alias("shift"), F.col(f"_b{i}").alias("scale")) for i, c in enumerate(cols)]
        found = df.agg(*ends).select(F.inline(F.array(*lines)))
    return found.select("column", "shift", F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale")).alias("scale"))


def scaled(df: DataFrame, scaler: DataFrame, suffix: str = "") -> DataFrame:
    """`df` with the scaler's columns scaled, in place or beside them under a suffix; NULL stays NULL.

    The scaler's few rows become literals, so a stream is scaled as a table is.
    """
    known = {r["column"]: r for r in scaler.collect()}
    number = lambda x: F.lit(x).cast("double")
    made = {c + suffix: (F.col(c).cast("double") - number(r["shift"])) / number(r["scale"]) for c, r in known.items()}
    return df.withColumns(made)
