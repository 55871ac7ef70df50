"""Rows chosen for training, folds of a cross-validation and scaled features."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from catalogue.base import Entries, table
from stayscope.operators import resampling as S
from stayscope.operators import validation as V
from stayscope.operators.features import assemble
from stayscope.operators.scaling import fit_scaler, scaled
from stayscope.operators.seasons import months_without_gaps, yearly_wave

entries = Entries()

_KEY = ["l_orderkey", "l_linenumber"]


def _sql_hash(salt: str, key: list[str], digits: int) -> str:
    parts = " || '|' || ".join([f"'{salt}'", *[f"CAST({k} AS VARCHAR)" for k in key]])
    return f"CAST(concat('0x', substr(md5({parts}), 1, {digits})) AS BIGINT)"


_LINE_HASH = _sql_hash("42", _KEY, 15)


@entries.add(
    f"""WITH r AS (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_returnflag) AS n,
      row_number() OVER (PARTITION BY l_returnflag ORDER BY {_LINE_HASH}) AS place FROM lineitem),
    q AS (SELECT (count(*) // 3)::BIGINT AS quota FROM lineitem)
    SELECT l_returnflag, l_orderkey, l_linenumber, copy::INTEGER AS copy FROM (
      SELECT *, unnest(range(1, quota // n + CASE WHEN place <= quota % n THEN 2 ELSE 1 END)) AS copy FROM r, q)"""
)
def lines_in_equal_classes(spark, sf_dir):
    """As many lines of every return flag, a third of all: one class is cut, two are repeated."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", *_KEY)
    return S.equal_classes(lines, ["l_returnflag"], _KEY, lines.count() // 3)


@entries.add(
    """SELECT l_returnflag, count(*) AS n, round((SELECT count(*) FROM lineitem) / (count(*) * 3.0), 9)::DOUBLE AS weight,
      round(count(*) * ((SELECT count(*) FROM lineitem) / (count(*) * 3.0)), 3)::DOUBLE AS total FROM lineitem GROUP BY 1"""
)
def class_weights(spark, sf_dir):
    """The weight of every return flag, and what all its lines weigh."""
    lines = S.with_class_weights(table(spark, sf_dir, "lineitem").select("l_returnflag", *_KEY), "l_returnflag")
    found = lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"))
    return found.select("l_returnflag", "n", F.round("weight", 9).alias("weight"), F.round(F.col("n") * F.col("weight"), 3).alias("total"))


_TOTAL = 400
_QUOTA = f"""q AS (SELECT n_name, n, t, (n * t) // a AS share, (n * t) % a AS rest, sum((n * t) // a) OVER () AS given FROM (
      SELECT n_name, count(*) AS n, sum(count(*)) OVER () AS a, least({_TOTAL}, sum(count(*)) OVER ()) AS t
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)),
    w AS (SELECT n_name, n, (share + CASE WHEN row_number() OVER (ORDER BY rest DESC, n_name) <= t - given THEN 1 ELSE 0 END)::BIGINT AS quota FROM q)"""


def _customers(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf_dir, "customer").join(F.broadcast(nations), "c_nationkey").select("n_name", "c_custkey")


@entries.add(f"WITH {_QUOTA} SELECT n_name, n, quota FROM w")
def quotas_by_nation(spark, sf_dir):
    """How many of 400 customers each nation gets, by its share and the largest remainders."""
    return S.proportional_quotas(S.stratum_sizes(_customers(spark, sf_dir), ["n_name"]), ["n_name"], _TOTAL)


@entries.add(
    f"""WITH {_QUOTA} SELECT n_name, c_custkey FROM (
      SELECT n_name, c_custkey, row_number() OVER (PARTITION BY n_name ORDER BY {_sql_hash("42", ["c_custkey"], 15)}) AS place
      FROM customer JOIN nation ON c_nationkey = n_nationkey) JOIN w USING (n_name) WHERE place <= quota"""
)
def customers_by_nation_share(spark, sf_dir):
    """A sample of 400 customers in which every nation has its share."""
    return S.proportional_sample(_customers(spark, sf_dir), ["n_name"], ["c_custkey"], _TOTAL)


def _price_folds(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*_KEY, F.col("l_extendedprice").alias("label"), F.col("l_quantity").cast("double").alias("x"))
    points = {"line": {}, "through zero": {"fitIntercept": False}}
    return V.out_of_fold(assemble(lines, ["x"], "features"), V.grid(LinearRegression(solver="normal"), points), _KEY)


_FOLDS = f"""f AS (SELECT l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE AS y, ({_sql_hash("folds", _KEY, 8)} % 5)::INTEGER AS fold FROM lineitem),
    s AS (SELECT k.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b, sum(x * y) / sum(x * x) AS c
      FROM f JOIN (SELECT DISTINCT fold FROM f) k ON k.fold <> f.fold GROUP BY k.fold),
    p AS (SELECT 'line' AS params, fold, y, a * x + b AS guess FROM f JOIN s USING (fold)
      UNION ALL SELECT 'through zero', fold, y, c * x FROM f JOIN s USING (fold))"""


@entries.add(
    f"""WITH {_FOLDS} SELECT params, fold, count(*) AS n, round(sqrt(avg((y - guess) ** 2)), 3) AS rmse,
      round(1 - avg((y - guess) ** 2) / var_pop(y), 6) AS r2 FROM p GROUP BY 1, 2"""
)
def cross_validated_prices(spark, sf_dir):
    """Error of two lines per fold, on lines that they have not seen."""
    found = V.fold_errors(_price_folds(spark, sf_dir))
    return found.select("params", "fold", "n", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _scaled(spark, sf_dir, kind):
    lines = table(spark, sf_dir, "lineitem").select(*_KEY, *_COLS)
    made = scaled(lines, fit_scaler(lines, _COLS, kind), "_scaled")
    return made.select(*_KEY, *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in _COLS])


def _scaled_sql(shift: str, scale: str) -> str:
    ends = ", ".join(f"{shift.format(c)} AS a{i}, {scale.format(c)} AS b{i}" for i, c in enumerate(_COLS))
    made = ", ".join(f"round((CAST({c} AS DOUBLE) - a{i}) / b{i}, 6) AS {c}_scaled" for i, c in enumerate(_COLS))
    return f"WITH s AS (SELECT {ends} FROM lineitem) SELECT l_orderkey, l_linenumber, {made} FROM lineitem, s"


@entries.add(_scaled_sql("avg(CAST({0} AS DOUBLE))", "stddev_pop(CAST({0} AS DOUBLE))"))
def standardised_lines(spark, sf_dir):
    """Three columns less their mean, by their deviation."""
    return _scaled(spark, sf_dir, "standard")


@entries.add(_scaled_sql("min({0})::DOUBLE", "(max({0}) - min({0}))::DOUBLE"))
def lines_from_zero_to_one(spark, sf_dir):
    """Three columns brought to the range from 0 to 1."""
    return _scaled(spark, sf_dir, "minmax")


@entries.add(_scaled_sql("quantile_cont({0}::DOUBLE, 0.5)", "quantile_cont({0}::DOUBLE, 0.75) - quantile_cont({0}::DOUBLE, 0.25)"))
def lines_by_quartiles(spark, sf_dir):
    """Three columns less their median, by the distance of their quartiles."""
    return _scaled(spark, sf_dir, "quantile")


def _order_months(spark, sf_dir):
    return months_without_gaps(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_totalprice")


_MONTHS = """c AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n, avg(o_totalprice) AS mean
      FROM orders GROUP BY 1, 2),
    k AS (SELECT o_custkey, unnest(generate_series(min(month)::TIMESTAMP, max(month)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM c GROUP BY 1),
    m AS (SELECT o_custkey, month, coalesce(n, 0)::BIGINT AS n, mean FROM k LEFT JOIN c USING (o_custkey, month))"""


@entries.add(f"WITH {_MONTHS} SELECT o_custkey, strftime(month, '%Y-%m') AS month, n, round(mean, 4) AS mean FROM m")
def orders_per_month(spark, sf_dir):
    """Orders of every customer in every month from the first to the last, and their mean price."""
    month = F.date_format("month", "yyyy-MM").alias("month")
    return _order_months(spark, sf_dir).select("o_custkey", month, "n", F.round("mean", 4).alias("mean"))


@entries.add(
    f"""WITH {_MONTHS}, b AS (SELECT o_custkey, n AS y, cos((month(month) - 1) * pi() / 6) AS p, sin((month(month) - 1) * pi() / 6) AS q FROM m),
    s AS (SELECT o_custkey, count(*) AS months, avg(y) AS my, avg(p) AS mp, avg(q) AS mq,
      covar_pop(p, p) AS pp, covar_pop(p, q) AS pq, covar_pop(q, q) AS qq, covar_pop(p, y) AS py, covar_pop(q, y) AS qy FROM b GROUP BY 1),
    r AS (SELECT *, pp * qq - pq * pq AS d FROM s),
    w AS (SELECT o_custkey, months, my, mp, mq, CASE WHEN d * months ** 3 > 1e-6 THEN (py * qq - qy * pq) / d END AS c,
      CASE WHEN d * months ** 3 > 1e-6 THEN (qy * pp - py * pq) / d END AS s FROM r)
    SELECT o_custkey, months, round(my - c * mp - s * mq, 6) AS level, round(c, 6) AS cosine, round(s, 6) AS sine,
      round(sqrt(c * c + s * s), 6) AS amplitude FROM w"""
)
def order_seasons(spark, sf_dir):
    """The yearly wave of every customer's orders per month."""
    found = yearly_wave(_order_months(spark, sf_dir), ["o_custkey"], "n")
    return found.select("o_custkey", "months", *[F.round(c, 6).alias(c) for c in ("level", "cosine", "sine", "amplitude")])
