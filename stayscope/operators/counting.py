"""Counts per group and per condition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_of(pairs: Mapping[str, Column], name: str, value: str) -> Column:
    """Turn named expressions of a one-row table into (name, value) rows with `inline`."""
    return F.inline(
        F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in pairs.items()])
    )


def group_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Rows per group; NULL is a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def n_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of groups, one of which may be NULL."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_groups"))


def condition_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows meeting each condition, all counted in one pass: (condition, n)."""
    counted = df.agg(*[F.count_if(c).alias(f"_c{i}") for i, c in enumerate(conditions.values())])
    return counted.select(
        rows_of({k: F.col(f"_c{i}") for i, k in enumerate(conditions)}, "condition", "n")
    )
