"""Segments as features, binned densities, stored sketches, windows over a stream, shared elbow scans."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from stayscope.operators import elbows as E
from stayscope.operators import sketches as K
from stayscope.operators import validation as V
from stayscope.operators.binned import binned_density
from stayscope.operators.features import assemble
from stayscope.operators.profile import density
from stayscope.operators.segment_features import with_and_without, with_segments
from stayscope.streaming import windows as W


def heaps(spark):
    rows = [(i, float(100 * (i % 3) + i % 7), [5.0, -40.0, 90.0][i % 3] + 2.0 * (i % 7)) for i in range(300)]
    return assemble(spark.createDataFrame(rows, "id int, x double, label double"), ["x"])


def test_a_segment_explains_what_a_line_cannot(spark):
    both = with_and_without({"line": LinearRegression(solver="normal")}, 3, scale=False)
    errors = V.fold_errors(V.out_of_fold(heaps(spark), both, "id", k=3)).collect()
    assert {r["params"] for r in errors} == {"line", "line + 3 segments"} and len(errors) == 6
    assert all((r["rmse"] < 1e-6) == (r["params"] != "line") for r in errors)


def test_segments_come_from_the_training_rows_only(spark):
    rows = heaps(spark)
    train = rows.where("x < 150")  # two heaps of three
    model = with_segments(LinearRegression(), 2, scale=False).fit(train)
    centres = sorted(c[0] for c in model.stages[0].clusterCenters())
    assert centres == pytest.approx([3.0, 103.0], abs=0.2)
    placed = model.transform(rows.where("x >= 150"))
    assert placed.count() == 100 and placed.select("features__segment").distinct().count() == 1


def test_saved_segments(spark, tmp_path):
    model = with_segments(LinearRegression(regParam=0.1), 3, method="bisecting", keep=False).fit(heaps(spark))
    model.write().save(f"{tmp_path}/m")
    one, two = (m.transform(heaps(spark)).select("id", "prediction").toPandas() for m in (model, PipelineModel.load(f"{tmp_path}/m")))
    assert one.equals(two) and one["prediction"].nunique() == 3
    with pytest.raises(ValueError, match="tells nothing"):
        with_segments(LinearRegression(), 1)


@pytest.mark.parametrize("tolerance", [1e-2, 1e-4])
def test_binned_density_keeps_its_bound(spark, tolerance):
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.normal(0, 1, 600), rng.exponential(3, 300), [250.0]])
    nothing = [(None,), (math.nan,), (math.inf,), (-math.inf,)]
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    got = sorted(binned_density(df.unionByName(spark.createDataFrame(nothing, "v double")), "v", tolerance=tolerance).collect())
    h = np.std(data, ddof=1) * len(data) ** -0.2
    want = sorted(density(df, "v").collect())
    assert [r.point for r in got] == list(range(200)) == [r.point for r in want]
    np.testing.assert_allclose([r.x for r in got], [r.x for r in want])
    off = np.abs(np.array([r.density for r in got]) - [r.density for r in want]).max()
    assert 0 < off <= tolerance / (h * math.sqrt(2 * math.pi))


def test_binned_density_of_few_values(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert binned_density(df, "v").isEmpty() and binned_density(df.where("v is null"), "v", bandwidth=1.0).isEmpty()
    got = binned_density(df, "v", points=7, bandwidth=1.0).orderBy("point").collect()
    np.testing.assert_allclose([r.density for r in got], [math.exp(-0.5 * z * z) / math.sqrt(2 * math.pi) for z in range(-3, 4)], rtol=1e-4)
    assert binned_density(df, "v", points=1).dtypes == binned_density(df, "v", bandwidth=1.0).dtypes


def test_rows_met_by_the_grid_do_not_grow_with_the_values(spark):
    few, many = (spark.range(n).select((F.col("id") / n).alias("v")) for n in (2_000, 200_000))
    sizes = []
    for df in (few, many):
        binned_density(df, "v", bandwidth=0.1).collect()
        gap = 0.1 * math.sqrt(8e-4)
        sizes.append(df.select(F.floor(F.col("v") / gap)).distinct().count())
    assert sizes[1] <= sizes[0] + 1 <= 1 / gap + 2


def test_merged_sketches_keep_ranks(spark, tmp_path):
    root = str(tmp_path / "s")
    df = spark.range(60_000).selectExpr("id % 5 AS day", "id", "(id * 7919) % 60000 AS v", "CAST(NULL AS DOUBLE) AS none")
    for day in range(5):
        K.add_sketches(K.quantile_sketches(df.where(f"day = {day}"), ["v", "none"], ["day"], size=400), root, f"{day:02d}")
    K.add_sketches(K.quantile_sketches(df.where("day = 3"), ["v", "none"], ["day"], size=400), root, "03")  # stored again
    stored = K.stored_sketches(spark, root)
    assert {r["batch"] for r in stored.select("batch").collect()} == {"00", "01", "02", "03", "04"}
    got = {(r["column"], r["prob"]): r for r in K.merged_quantiles(stored, [0.0, 0.1, 0.5, 0.99, 1.0]).collect()}
    assert len(got) == 10 and got["none", 0.5]["value"] is None and got["none", 0.5]["n"] == 0
    for p in (0.0, 0.1, 0.5, 0.99, 1.0):
        assert got["v", p]["n"] == 60_000 and abs(got["v", p]["value"] / 60_000 - p) <= 2 * K.rank_error(400)
    per_day = K.merged_quantiles(stored, [0.5], ["day"]).where("column = 'v'")
    assert {r["day"]: r["n"] for r in per_day.collect()} == {d: 12_000 for d in range(5)}


def test_sketches_of_odd_numbers(spark):
    df = spark.createDataFrame([("a", math.nan, "x"), ("a", 3.0, "7"), (None, None, None), (None, 1.0, "2")], "g string, v double, t string")
    got = K.merged_quantiles(K.quantile_sketches(df, ["v", "t"], ["g"]), [0.5], ["g"]).collect()
    assert {(r["g"], r["column"]): (r["n"], r["value"]) for r in got} == {("a", "v"): (1, 3.0), ("a", "t"): (1, 7.0), (None, "v"): (1, 1.0), (None, "t"): (1, 2.0)}
    none = K.merged_quantiles(K.quantile_sketches(df.limit(0), ["v"], ["g"]), [0.5], ["g"])
    assert none.count() == 0


def reviews(spark, rows):
    start = dt.datetime(2024, 1, 1)
    made = [(i, h, None if d is None else start + dt.timedelta(days=d), b) for i, h, d, b in rows]
    return spark.createDataFrame(made, "id int, hotel string, at timestamp, bad boolean").coalesce(1)


def counts(df):
    return W.windowed_counts(df, "hotel", ["id"], "at", F.col("bad"), "7 days", "3 days")


def test_stream_with_repeats_late_rows_and_a_restart(spark, tmp_path):
    first = [(1, "a", 0, True), (2, "a", 1, False), (3, "b", 2, None), (4, "a", 9, True), (5, "b", 12, True), (6, "b", None, True)]
    again = [(4, "a", 9, True), (5, "b", 12, True), (7, "a", 10, False), (1, "a", 0, True), (8, None, 11, True)]  # 1 is late: seen, and its window sent
    last = [(9, "a", 40, False)]
    sent = []
    for part in (first, again, last):
        reviews(spark, part).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(reviews(spark, part).schema).parquet(f"{tmp_path}/in")
        W.write_windows(counts(stream), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
        sent.append(spark.read.parquet(f"{tmp_path}/out").count())
    table = reviews(spark, first + again + last)
    want = W.closed_windows(counts(table), table, "at", "3 days").collect()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and sent[0] < sent[2] == len(want)
    assert sorted((r["hotel"] or "", r["n"], r["flagged"]) for r in got) == sorted((r["hotel"] or "", r["n"], r["flagged"]) for r in want)
    alerts = W.window_alerts(spark.read.parquet(f"{tmp_path}/out"), 0.5, 2).collect()
    assert all(r["n"] >= 2 and r["flagged"] * 2 >= r["n"] for r in alerts) and alerts


def test_empty_stream_and_table(spark):
    empty = reviews(spark, [(1, "a", 0, True)]).limit(0)
    assert W.closed_windows(counts(empty), empty, "at", "3 days").isEmpty()


def lloyd(x, centres, iterations=20, tolerance=1e-4):
    for i in range(iterations + 1):
        gaps = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        place, cost = gaps.argmin(axis=1), gaps.min(axis=1).sum()
        moved = np.array([x[place == j].mean(axis=0) if (place == j).any() else c for j, c in enumerate(centres)])
        if np.sqrt(((moved - centres) ** 2).sum(axis=1)).max() <= tolerance or i == iterations:
            return cost
        centres = moved


def test_shared_scans_cost_what_separate_fits_cost(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 2)) + rng.integers(0, 4, size=(400, 1)) * 5, 1)
    x = np.vstack([x, np.repeat(x[:1], 200, axis=0)])  # a third of all rows are one point
    odd = [(None, 1.0), (math.nan, 2.0)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + odd, "a double, weight double")
    points = E.counted_points(df, ["a", "weight"])
    assert points.agg(F.sum(E.WEIGHT)).first()[0] == 600
    starts = E.spread_starts(points, [1, 2, 4, 6])
    got = E.fit_at_once(points, starts)
    for k, start in starts.items():
        assert got[k][0] == pytest.approx(lloyd(x, start), rel=1e-9)
        assert got[k][0] == pytest.approx(E.fit_at_once(points, {k: start})[k][0], rel=1e-12)
    assert got[1][0] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())


def test_elbow_of_few_points(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (5.0,), (None,)], "v double")
    assert [tuple(r) for r in E.elbow_at_once(df, ["v"], [1, 2, 5]).collect()] == [(1, pytest.approx(32 / 3)), (2, 0.0), (5, 0.0)]
    assert E.elbow_at_once(df.where("v is null"), ["v"], [2]).isEmpty()
