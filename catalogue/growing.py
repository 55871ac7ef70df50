"""Segments as features, densities of continuous columns, stored sketches and windows over a stream."""

from __future__ import annotations

import uuid

from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from catalogue.base import Entries, table
from catalogue.learning import _hotel_rows, _hotels
from stayscope.operators import sketches as K
from stayscope.operators import validation as V
from stayscope.operators.binned import binned_density
from stayscope.operators.elbows import elbow_at_once
from stayscope.operators.features import assemble
from stayscope.operators.joins import attach
from stayscope.operators.segment_features import with_and_without
from stayscope.plans import reviews as R
from stayscope.sources import shared_folder
from stayscope.streaming import windows as W

entries = Entries()

_KEY = ["l_orderkey", "l_linenumber"]
_X = "l_quantity + 1000 * (l_linenumber % 3)"
_FOLD = "(CAST(concat('0x', substr(md5('folds' || '|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 1, 8)) AS BIGINT) % 5)::INTEGER"


@entries.add(
    f"""WITH f AS (SELECT ({_X})::DOUBLE AS x, l_extendedprice::DOUBLE AS y, l_linenumber % 3 AS g, {_FOLD} AS fold FROM lineitem),
    t AS (SELECT k.fold, g, count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS xy, var_pop(x) AS xx
      FROM f JOIN (SELECT DISTINCT fold FROM f) k ON k.fold <> f.fold GROUP BY 1, 2),
    b AS (SELECT fold, sum(n * xy) / sum(n * xx) AS b FROM t GROUP BY 1),
    l AS (SELECT k.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS c FROM f JOIN (SELECT DISTINCT fold FROM f) k ON k.fold <> f.fold GROUP BY 1),
    p AS (SELECT 'line' AS params, fold, y, a * x + c AS guess FROM f JOIN l USING (fold)
      UNION ALL SELECT 'line + 3 segments', fold, y, my + b * (x - mx) FROM f JOIN t USING (fold, g) JOIN b USING (fold))
    SELECT params, fold, count(*) AS n, round(sqrt(avg((y - guess) ** 2)), 3) AS rmse,
      round(1 - avg((y - guess) ** 2) / var_pop(y), 6) AS r2 FROM p GROUP BY 1, 2"""
)
def prices_with_segments(spark, sf_dir):
    """Error per fold of a line, and of one that also knows to which of three heaps a value belongs."""
    lines = table(spark, sf_dir, "lineitem").select(*_KEY, F.col("l_extendedprice").alias("label"), F.expr(_X).alias("x"))
    both = with_and_without({"line": LinearRegression(solver="normal")}, 3, scale=False)
    found = V.fold_errors(V.out_of_fold(assemble(lines, ["x"]), both, _KEY))
    return found.select("params", "fold", "n", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


@entries.add()
def hotel_scores_with_segments(spark, sf_dir):
    """Out-of-fold errors of two regressors of the mean score, each with and without the hotel's segment."""
    rows = assemble(_hotel_rows(spark, sf_dir), R.REGRESSION_FEATURES).withColumn("label", F.col("avg_Average_Score"))
    plain = {"line": LinearRegression(), "forest": RandomForestRegressor(numTrees=20, seed=42)}
    return V.fold_errors(V.out_of_fold(rows, with_and_without(plain, 4), ["Hotel_Name", "Hotel_Address"], k=3))


@entries.add(
    """WITH s AS (SELECT *, h * sqrt(8 * 0.0001::DOUBLE) AS gap FROM (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n,
      stddev_samp(l_extendedprice) * pow(count(*)::DOUBLE, -0.2::DOUBLE) AS h FROM lineitem)),
    b AS (SELECT (l_extendedprice - lo) / gap AS p FROM lineitem, s),
    w AS (SELECT node, sum(w) AS w FROM (SELECT floor(p) AS node, 1 - (p - floor(p)) AS w FROM b
      UNION ALL SELECT floor(p) + 1, p - floor(p) FROM b) GROUP BY 1),
    g AS (SELECT CAST(i AS INTEGER) AS point, lo - 3 * h + i * ((hi - lo + 6 * h) / 199) AS x, lo, gap, n, h FROM range(200) r(i), s)
    SELECT point, round(x, 4) AS x,
      round(1e6::DOUBLE * sum(w * exp(-0.5::DOUBLE * ((x - lo - node * gap) / h)^2)) / any_value(n * h * sqrt(2 * pi())), 6) AS density FROM g, w GROUP BY point, x"""
)
def price_density(spark, sf_dir):
    """Kernel density, per million, of a column in which most values differ."""
    out = binned_density(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return out.select("point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density"))


@entries.add(
    """WITH p AS (SELECT l_quantity + 1000 * (l_linenumber % 3) AS x, l_linenumber % 3 AS g FROM lineitem)
    SELECT 1::INTEGER AS k, round(var_pop(x) * count(*) / 1e6, 3)::DOUBLE AS wss FROM p
    UNION ALL SELECT 3, round(sum(s) / 1e6, 3)::DOUBLE FROM (SELECT var_pop(x) * count(*) AS s FROM p GROUP BY g)"""
)
def elbow_of_heaps(spark, sf_dir):
    """Squared distances, in millions, for one and three clusters of values that lie in three heaps."""
    found = elbow_at_once(table(spark, sf_dir, "lineitem").select(F.expr(_X).alias("x")), ["x"], [1, 3])
    return found.select("k", F.round(F.col("wss") / 1e6, 3).alias("wss"))


@entries.add()
def hotel_elbow_at_once(spark, sf_dir):
    """Within-segment distances of hotels for two to eight segments, from shared scans."""
    return elbow_at_once(_hotels(spark, sf_dir), R.SEGMENT_FEATURES)


_COLS = ["o_totalprice", "o_custkey"]
_PROBS = [0.25, 0.5, 0.75]


@entries.add(
    """SELECT year(o_orderdate)::INTEGER AS year, c.name AS "column", prob, count(*) AS n, true AS close
    FROM orders, (VALUES ('o_totalprice'), ('o_custkey')) c(name), (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) q(prob) GROUP BY 1, 2, 3"""
)
def quartiles_of_stored_sketches(spark, sf_dir):
    """Quartiles per year, merged from the sketches of two batches, and whether their ranks are within the error."""
    folder = f"{shared_folder(spark)}/sketches-{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey", *_COLS)
    for batch, rows in (("even", orders.where("o_orderkey % 2 = 0")), ("odd", orders.where("o_orderkey % 2 <> 0"))):
        K.add_sketches(K.quantile_sketches(rows, _COLS, ["year"]), folder, batch)
    merged = K.merged_quantiles(K.stored_sketches(spark, folder), _PROBS, ["year"])
    values = orders.unpivot(["year"], [F.col(c).cast("double").alias(c) for c in _COLS], "column", "v")
    ranked = attach(values, merged, ["year", "column"], "inner").groupBy("year", "column", "prob", "n").agg(
        F.avg((F.col("v") < F.col("value")).cast("int")).alias("below"), F.avg((F.col("v") <= F.col("value")).cast("int")).alias("to")
    )
    error = 2 * K.rank_error(K.SIZE)
    close = (F.col("below") <= F.col("prob") + error) & (F.col("to") >= F.col("prob") - error)
    return ranked.select("year", "column", "prob", "n", close.alias("close"))


_WIDTH, _DELAY = "30 days", "10 days"


def _reviews_in_two_parts(spark, sf_dir):
    """Lines as reviews in a folder per arrival: those up to a day, then the later ones and repeats of earlier ones."""
    folder = f"{shared_folder(spark)}/arrivals-{uuid.uuid4().hex}"
    lines = table(spark, sf_dir, "lineitem").select(*_KEY, "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("at"), "l_returnflag")
    early = F.col("at") < F.lit("1998-06-01").cast("timestamp")
    repeats = lines.where(F.col("l_linenumber") % 3 == 0)
    return folder, [lines.where(early), lines.where(~early).unionByName(repeats)]


def _windows(reviews):
    return W.windowed_counts(reviews, "l_suppkey", [*_KEY, "l_suppkey", "l_returnflag"], "at", F.col("l_returnflag") == "R", _WIDTH, _DELAY)


@entries.add(
    """WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, l_shipdate::TIMESTAMP AS t, l_returnflag FROM lineitem),
    c AS (SELECT epoch_us(t) // 2592000000000 AS w, l_suppkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS flagged FROM r GROUP BY 1, 2)
    SELECT strftime(make_timestamp(w * 2592000000000), '%Y-%m-%d') AS window_start, l_suppkey, n, flagged FROM c
    WHERE make_timestamp((w + 1) * 2592000000000) <= (SELECT max(t) - INTERVAL 10 DAY FROM r)
      AND n >= 3 AND flagged >= 0.5 * n"""
)
def alerts_per_window(spark, sf_dir):
    """Suppliers and 30-day windows in which half of the reviews are bad, from a stream stopped and started again."""
    folder, arrivals = _reviews_in_two_parts(spark, sf_dir)
    for rows in arrivals:
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        W.write_windows(_windows(stream), f"{folder}/out", f"{folder}/progress").awaitTermination()
    found = W.window_alerts(spark.read.parquet(f"{folder}/out"), 0.5, 3)
    return found.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "l_suppkey", "n", "flagged")
