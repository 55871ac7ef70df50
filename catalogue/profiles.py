"""Column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Entries, table
from stayscope.operators import profile as P

entries = Entries()

_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _summary(c, text=False):
    number = f"TRY_CAST({c} AS DOUBLE)"
    q = [f"round(quantile_cont({number}, {p}::DOUBLE), 6)" for p in (0.25, 0.5, 0.75)]
    ends = [f"{f}({c})" if text else f"round({f}({number}), 6)" for f in ("min", "max")]
    ends = [e if text else "NULL" for e in ends]
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({number}), 6) AS mean, "
        f"round(stddev_samp({number}), 6) AS stddev, {ends[0]} AS min, {q[0]} AS q25, {q[1]} AS q50, "
        f"{q[2]} AS q75, {ends[1]} AS max FROM lineitem"
    )


@entries.add(" UNION ALL ".join([_summary(c) for c in _NUMBERS] + [_summary("l_returnflag", True)]))
def exact_summary(spark, sf_dir):
    """Count, mean, deviation and exact quartiles per column."""
    out = P.summarise(_lines(spark, sf_dir), [*_NUMBERS, "l_returnflag"])
    # Numbers print differently in the two engines; their ends are compared in extremes().
    for end in ("min", "max"):
        out = out.withColumn(end, F.when(F.col("column") == "l_returnflag", F.col(end)))
    return out.select(
        "column", "count", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "stddev", "q25", "q50", "q75")]
    )


@entries.add(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS \"count\", min({c}) AS min, max({c}) AS max FROM lineitem"
        for c in _NUMBERS
    )
)
def extremes(spark, sf_dir):
    """Smallest and largest value per column, from the single-pass summary."""
    out = P.summarise(_lines(spark, sf_dir), _NUMBERS, exact=False)
    return out.select("column", "count", F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"))


@entries.add()
def quick_summary(spark, sf_dir):
    """Summary with approximate quartiles, in a single pass."""
    return P.summarise(_lines(spark, sf_dir), [*_NUMBERS, "l_returnflag"], exact=False)


@entries.add(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round((avg({c}^3) - 3 * avg({c}) * avg({c}^2) + 2 * avg({c})^3) "
        f"/ var_pop({c})^1.5, 4) AS skewness FROM {t}"
        for c, t in (("l_discount", "lineitem"), ("l_quantity", "lineitem"))
    )
)
def column_skewness(spark, sf_dir):
    """Population skewness."""
    out = P.skewness(_lines(spark, sf_dir), ["l_discount", "l_quantity"])
    return out.withColumn("skewness", F.round("skewness", 4))


@entries.add(
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 30 AS w FROM events),
    c AS (SELECT CAST(least(floor((value - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n FROM events, s GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 6) AS low,
      round(CASE WHEN i = 29 THEN hi ELSE lo + (i + 1) * w END, 6) AS high, coalesce(n, 0) AS n
    FROM range(30) r(i) CROSS JOIN s LEFT JOIN c ON bin = i"""
)
def value_histogram(spark, sf_dir):
    """Thirty equal bins, empty ones included."""
    out = P.histogram(table(spark, sf_dir, "events"), "value", 30)
    return out.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


@entries.add(
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for a in _NUMBERS for b in _NUMBERS
    )
)
def correlations(spark, sf_dir):
    """Pearson correlation of all pairs of columns."""
    return P.correlation(_lines(spark, sf_dir), _NUMBERS).withColumn("r", F.round("r", 6))


@entries.add(
    " UNION ALL ".join(
        f"SELECT '{x}' AS feature, round(regr_slope(l_extendedprice, {x}), 4) AS slope, "
        f"round(regr_intercept(l_extendedprice, {x}), 4) AS intercept, "
        f"round(regr_r2(l_extendedprice, {x}), 6) AS r2, CAST(regr_count(l_extendedprice, {x}) AS BIGINT) AS n FROM lineitem"
        for x in ("l_quantity", "l_discount", "l_tax")
    )
)
def price_trends(spark, sf_dir):
    """Least-squares lines of the price over three features."""
    out = P.trend_lines(_lines(spark, sf_dir), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return out.select(
        "feature", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round("r2", 6).alias("r2"), "n",
    )


@entries.add(
    """WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, count(*) AS n,
      stddev_samp(l_quantity) * pow(count(*)::DOUBLE, -0.2::DOUBLE) AS h FROM lineitem),
    v AS (SELECT l_quantity AS v, count(*) AS w FROM lineitem GROUP BY 1),
    g AS (SELECT CAST(i AS INTEGER) AS point, lo - 3 * h + i * ((hi - lo + 6 * h) / 199) AS x, n, h FROM range(200) r(i), s)
    SELECT point, round(x, 6) AS x,
      round(sum(w * exp(-0.5::DOUBLE * ((x - v) / h)^2)) / any_value(n * h * sqrt(2 * pi())), 8) AS density
    FROM g, v GROUP BY point, x"""
)
def quantity_density(spark, sf_dir):
    """Gaussian kernel density on 200 points."""
    out = P.density(_lines(spark, sf_dir), "l_quantity")
    return out.select("point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@entries.add(
    """WITH q AS (SELECT l_linenumber, quantile_cont(l_extendedprice, 0.25::DOUBLE) AS q1,
      quantile_cont(l_extendedprice, 0.5::DOUBLE) AS median, quantile_cont(l_extendedprice, 0.75::DOUBLE) AS q3
      FROM lineitem GROUP BY 1),
    j AS (SELECT *, l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM lineitem JOIN q USING (l_linenumber))
    SELECT l_linenumber, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
      round(min(l_extendedprice) FILTER (inside), 6) AS whisker_low,
      round(max(l_extendedprice) FILTER (inside), 6) AS whisker_high,
      count(*) FILTER (NOT inside) AS outliers, count(*) AS n
    FROM j GROUP BY l_linenumber, q1, median, q3"""
)
def price_boxes(spark, sf_dir):
    """Quartiles, whiskers and outliers per group."""
    out = P.box_stats(_lines(spark, sf_dir), "l_linenumber", "l_extendedprice")
    cols = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return out.select("l_linenumber", *[F.round(c, 6).alias(c) for c in cols], "outliers", "n")
