"""Column profiles: summaries, histograms, densities, correlation, trend lines, box statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayscope.operators.joins import attach
from stayscope.operators.ordering import as_number, quantiles_of, tally
from stayscope.sources.checkpoints import cut_lineage

QUARTILES = [0.25, 0.5, 0.75]


def summarise(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Per column: count, mean, stddev, min, quartiles and max; min and max as text.

    Text columns count every value, and take the rest over those that are numbers, except for
    min and max, which follow the text. Without `exact` the quartiles are elements of the data
    within 1/10000 of the asked rank, found in the same pass. Numbers and texts are read in one
    pass each, over their own columns.
    """

    def pass_over(names: list[str]) -> DataFrame:
        parts = []
        for c in names:
            number = as_number(df, c)
            quartiles = F.percentile_approx(number, QUARTILES, 10_000)
            facts = {
                "count": F.count(c),
                "mean": F.avg(number),
                "stddev": F.stddev_samp(number),
                "min": F.min(c).cast("string"),
                "q": F.lit(None).cast("array<double>") if exact else quartiles,
                "max": F.max(c).cast("string"),
            }
            parts.append(F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in facts.items()]))
        wide = df.agg(*[part.alias(f"_c{i}") for i, part in enumerate(parts)])
        return wide.select(F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(names))])))

    # Smallest and largest texts cannot be kept in a hash aggregation; numbers need not wait for them.
    texts = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    kinds = [kind for kind in ([c for c in cols if c not in texts], texts) if kind]
    long = reduce(DataFrame.unionByName, [pass_over(kind) for kind in kinds])
    names = ["q25", "q50", "q75"]
    if not exact:
        qs = [F.get("q", F.lit(i)).alias(n) for i, n in enumerate(names)]
        return long.select("column", "count", "mean", "stddev", "min", *qs, "max")
    ranked = quantiles_of(tally(df, cols), QUARTILES)
    ranked = ranked.select("column", *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])
    joined = long.drop("q").join(ranked, "column", "left")
    return joined.select("column", "count", "mean", "stddev", "min", *names, "max")


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population skewness per column, in one pass."""
    wide = df.agg(*[F.skewness(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("skewness")) for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*pairs)))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max: bin, low, high, n; the last bin is closed.

    Empty bins are kept; a constant column gives one bin; NULL and NaN are left out.
    """
    data = df.select(F.col(col).cast("double").alias("v")).where("v is not null and not isnan(v)")
    span = data.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    steps = F.floor((F.col("v") - F.col("s.lo")) / F.nullif(width, F.lit(0.0)))
    place = F.least(F.coalesce(steps, F.lit(0)), F.lit(bins - 1))
    counts = (
        data.withColumn("s", span)
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .withColumn("s", span)
        .where("s.lo is not null and (bin = 0 or s.hi > s.lo)")
    )
    last = (F.col("bin") == bins - 1) | (width == 0)
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("s.lo") + F.col("bin") * width).alias("low"),
        F.when(last, F.col("s.hi")).otherwise(F.col("s.lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs in one pass: (col_a, col_b, r), both ways round.

    Rows missing either value of a pair are left out of that pair.
    """
    pairs = list(combinations_with_replacement(cols, 2))
    wide = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            rows.append(F.struct(F.lit(left).alias("col_a"), F.lit(right).alias("col_b"), F.col(f"_c{i}").alias("r")))
    return wide.select(F.inline(F.array(*rows)))


def trend_lines(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    """Least-squares line of `y` over each feature: (feature, slope, intercept, r2, n), one pass."""
    target = F.col(y).cast("double")
    parts = []
    for i, x in enumerate(xs):
        feature = F.col(x).cast("double")
        parts.append(
            F.struct(
                F.lit(x).alias("feature"),
                F.regr_slope(target, feature).alias("slope"),
                F.regr_intercept(target, feature).alias("intercept"),
                F.regr_r2(target, feature).alias("r2"),
                F.regr_count(target, feature).alias("n"),
            ).alias(f"_c{i}")
        )
    return df.agg(*parts).select(F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(xs))])))


def density(
    df: DataFrame, col: str, points: int = 200, bandwidth: float | None = None, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density on an even grid: (point, x, density).

    The bandwidth follows Scott's rule unless given; the grid reaches `cut` bandwidths past
    both ends. Equal values are counted first, so scores and counts cost one kernel per
    distinct value and grid point, and each task adds its kernels up before the shuffle.
    """
    data = df.select(F.col(col).cast("double").alias("v")).where("v is not null and not isnan(v)")
    scott = F.stddev_samp("v") * F.pow(F.count("v").cast("double"), F.lit(-0.2))
    h = scott if bandwidth is None else F.lit(float(bandwidth))
    facts = data.agg(
        F.struct(
            F.min("v").alias("lo"), F.max("v").alias("hi"), F.nullif(h, F.lit(0.0)).alias("h"), F.count("v").alias("n")
        ).alias("s")
    ).scalar()
    low = F.col("s.lo") - cut * F.col("s.h")
    step = (F.col("s.hi") - F.col("s.lo") + 2 * cut * F.col("s.h")) / max(points - 1, 1)
    counted = data.groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    z = (F.col("x") - F.col("v")) / F.col("s.h")
    scale = F.col("s.n") * F.col("s.h") * math.sqrt(2 * math.pi)
    sums = (
        counted.withColumn("s", facts)
        .where("s.h is not null")
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", low + F.col("point") * step)
        .groupBy("point")
        .agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("k"))
    )
    return sums.withColumn("s", facts).select(
        "point", (low + F.col("point") * step).alias("x"), (F.col("k") / scale).alias("density")
    )


def box_stats(df: DataFrame, group: str, col: str, whisker: float = 1.5) -> DataFrame:
    """Per group: quartiles, the furthest values within the whiskers' reach, and outliers beyond."""
    counted = cut_lineage(tally(df, [col], [group]).where(F.col(group).isNotNull()))
    quartiles = quantiles_of(counted, QUARTILES, [group], stored=True).select(
        group, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    reach = whisker * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        attach(counted, cut_lineage(quartiles), group, "inner")
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("outliers"),
            F.sum("n").alias("n"),
        )
    )
