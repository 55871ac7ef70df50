"""Seasons: months without gaps per group, and a yearly wave fitted to them by normal equations."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERMS = 3  # level, cosine, sine
LEAST_DETERMINANT = 1e-6


def months_without_gaps(df: DataFrame, by: Sequence[str], date: str, value: str | None = None) -> DataFrame:
    """Every month from a group's first to its last: `by`, month (its first day), n, and mean of `value` (NULL without rows).

    Rows are counted before anything moves; the calendar is made from one row per group. Rows without a
    date are left out, NULL is a group of its own.
    """
    month = F.trunc(date, "month").alias("_month")
    found = [F.count(F.lit(1)).alias("_n")] + ([F.avg(value).alias("_mean")] if value else [])
    counts = df.where(F.col(date).isNotNull()).groupBy(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], month).agg(*found)
    keys = [F.col(f"_by_{i}").alias(c) for i, c in enumerate(by)]
    ends = counts.groupBy(*[f"_by_{i}" for i in range(len(by))]).agg(F.min("_month").alias("_a"), F.max("_month").alias("_b"))
    calendar = ends.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    same = F.col("month") == F.col("_month")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    filled = calendar.join(counts, same, "left")
    more = [F.col("_mean").alias("mean")] if value else []
    return filled.select(*by, "month", F.coalesce("_n", F.lit(0)).cast("long").alias("n"), *more)


def _determinant(m: list[list[Column]]) -> Column:
    a, b, c = m
    return a[0] * (b[1] * c[2] - b[2] * c[1]) - a[1] * (b[0] * c[2] - b[2] * c[0]) + a[2] * (b[0] * c[1] - b[1] * c[0])


def yearly_wave(months: DataFrame, by: Sequence[str], value: str, month: str = "month") -> DataFrame:
    """Least-squares level + cosine + sine of the year per group: `by`, months, level, cosine, sine, amplitude, peak.

    `peak` is the place of the maximum in months after January, from 0 to below 12. The sums of products are plain
    aggregates, made in one pass; the three equations are solved per group in expressions. Months
    with a NULL value are left out; a group whose months don't determine the wave has NULLs.
    """
    angle = (F.month(month) - 1) * (2 * math.pi / 12)
    basis = [F.lit(1.0), F.cos(angle), F.sin(angle)]
    rows = months.where(F.col(value).isNotNull())
    sums = [F.count(F.lit(1)).alias("months")]
    for i in range(TERMS):
        sums += [F.sum(basis[i] * basis[j]).alias(f"_m{i}{j}") for j in range(i, TERMS)]
        sums.append(F.sum(basis[i] * F.col(value)).alias(f"_v{i}"))
    found = rows.groupBy(*by).agg(*sums)
    matrix = [[F.col(f"_m{min(i, j)}{max(i, j)}") for j in range(TERMS)] for i in range(TERMS)]
    whole = _determinant(matrix)
    solved = []
    for k, name in enumerate(("level", "cosine", "sine")):
        changed = [[F.col(f"_v{i}") if j == k else matrix[i][j] for j in range(TERMS)] for i in range(TERMS)]
        solved.append(F.when(F.abs(whole) > LEAST_DETERMINANT, _determinant(changed) / whole).alias(name))
    found = found.select(*by, "months", *solved)
    turn = F.atan2("sine", "cosine") * (12 / (2 * math.pi))
    return found.withColumns({"amplitude": F.hypot("cosine", "sine"), "peak": F.when(turn < 0, turn + 12).otherwise(turn)})
