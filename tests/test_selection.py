"""Quotas per stratum, class weights, cross-validation and scalers."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from stayscope.operators import joins, resampling as S, validation as V
from stayscope.operators.features import assemble
from stayscope.operators.scaling import fit_scaler, scaled
from stayscope.sources import load_checkpoint, save_checkpoint

KIND = "class string, id long, copy int, _row string, quota int, n int"


def place(key, salt="42"):
    text = "|".join([salt, *[str(k) for k in key if k is not None]])
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@pytest.fixture(scope="module")
def table(spark):
    rows = [("big" if i % 3 else "small" if i % 2 else None, i, 9, "r", 8, 7) for i in range(1500)]
    return spark.createDataFrame(rows + [("one", 5000, 9, "r", 8, 7)], KIND).repartition(5)


@pytest.mark.parametrize("bits,broadcast", [(12, True), (0, True), (3, False)])
@pytest.mark.parametrize("n", [0, 1, 100, 777])
def test_exactly_the_first_rows_by_hash(spark, table, n, bits, broadcast, monkeypatch):
    if n not in (1, 777) and bits != 3:
        pytest.skip("one way is enough")
    monkeypatch.setattr(S, "CELL_BITS", bits)
    if not broadcast:
        monkeypatch.setattr(joins, "fits_broadcast", lambda *_: False)
    plain = table.drop("copy")
    got = Counter((r["class"], r["id"]) for r in S.equal_classes(plain, ["class"], ["id"], n).collect())
    classes = defaultdict(list)
    for r in plain.collect():
        classes[r["class"]].append(r["id"])
    want = Counter()
    for c, ids in classes.items():
        ranked = sorted(ids, key=lambda i: place([i]))
        for i, x in enumerate(ranked):
            times = n // len(ids) + (i < n % len(ids))
            if times:
                want[c, x] = times
    assert got == want


def test_equal_keys_and_one_hot_class(spark):
    rows = [("hot", 1)] * 3000 + [("hot", 2)] * 10 + [("cold", 3)] * 4
    df = spark.createDataFrame(rows, "class string, id long").repartition(4)
    quotas = spark.createDataFrame([("hot", 1000), ("cold", 9), ("absent", 5)], "class string, quota int")
    got = S.resample(df, ["class"], ["id"], quotas)
    assert {r["class"]: r["count"] for r in got.groupBy("class").count().collect()} == {"hot": 1000, "cold": 9}
    assert {r["copy"] for r in got.collect()} == {1, 2, 3}
    assert S.resample(df.where("false"), ["class"], ["id"], quotas).count() == 0


@pytest.mark.parametrize("total", [0, 1, 10, 101, 10_000])
def test_quotas_by_largest_remainder(spark, table, total):
    sizes = {(r["class"]): r["n"] for r in S.stratum_sizes(table, ["class"]).collect()}
    got = {r["class"]: r["quota"] for r in S.proportional_quotas(S.stratum_sizes(table, ["class"]), ["class"], total).collect()}
    total, rows = min(total, sum(sizes.values())), sum(sizes.values())
    want = {c: n * total // rows for c, n in sizes.items()}
    order = sorted(sizes, key=lambda c: (-(sizes[c] * total % rows), c is not None, c or ""))
    for c in order[: total - sum(want.values())]:
        want[c] += 1
    assert got == want and sum(got.values()) == total
    assert S.proportional_sample(table.drop("copy"), ["class"], ["id"], total).count() == total
    assert S.proportional_quotas(S.stratum_sizes(table.where("false"), ["class"]), ["class"], 5).count() == 0


def test_weights_balance_a_fit(spark):
    rows = [(float(i % 10 + (3 if i % 20 == 0 else 0)), int(i % 20 == 0)) for i in range(800)]
    df = assemble(spark.createDataFrame(rows + [(1.0, None)], "x double, label int"), ["x"])
    weighted = S.with_class_weights(df, "label")
    sums = {r["label"]: r["w"] for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert sums == {0: pytest.approx(400), 1: pytest.approx(400), None: None}
    known = weighted.where("label IS NOT NULL")
    plain, fair = (LogisticRegression(**w).fit(known).transform(known) for w in ({}, {"weightCol": "weight"}))
    share = [p.agg(F.avg("prediction")).first()[0] for p in (plain, fair)]
    assert share[0] < 0.1 < share[1]


def test_every_row_is_predicted_once_per_point(spark):
    rows = [(i, i // 2, float(i % 17), float(3 * (i % 17) + i % 3)) for i in range(400)] + [(400, 7, 1.0, None)]
    df = assemble(spark.createDataFrame(rows, "id int, pair int, x double, label double"), ["x"])
    points = V.grid(LinearRegression(), {"free": {}, "flat": {"regParam": 1e9}, "zero": {"fitIntercept": False}})
    got = V.out_of_fold(df, points, "pair", k=4).cache()
    assert got.columns == ["params", "fold", "pair", "label", "prediction"]
    assert got.groupBy("params").count().collect() and {r["count"] for r in got.groupBy("params").count().collect()} == {400}
    assert got.groupBy("pair").agg(F.count_distinct("fold").alias("n")).where("n > 1").isEmpty()
    errors = V.fold_errors(got)
    assert V.best_point(errors, "rmse") == "free" and V.best_point(errors, "r2", larger=True) == "free"
    flat = {r["fold"]: r for r in got.where("params = 'flat'").groupBy("fold").agg(F.avg("prediction").alias("p"), F.avg("label").alias("y")).collect()}
    total = got.where("params = 'flat'").agg(F.sum("label").alias("s"), F.count("*").alias("n")).first()
    sizes = {r["fold"]: r["count"] for r in got.where("params = 'flat'").groupBy("fold").count().collect()}
    for f, r in flat.items():  # the mean of the other folds: the fold itself was not seen
        assert r["p"] == pytest.approx((total["s"] - r["y"] * sizes[f]) / (total["n"] - sizes[f]), rel=1e-6)
    got.unpersist()


def test_hits_of_classifiers(spark):
    rows = [("a", 0, 3, 3.0), ("a", 0, 1, 2.0), ("a", 1, 2, 2.0), ("b", 0, 1, 0.0)]
    got = V.fold_hits(spark.createDataFrame(rows, "params string, fold int, label int, prediction double"))
    assert {(r.params, r.fold): (r.n, r.accuracy) for r in got.collect()} == {("a", 0): (2, 0.5), ("a", 1): (1, 1.0), ("b", 0): (1, 0.0)}
    assert V.best_point(got, "accuracy", larger=True) == "a"


@pytest.mark.parametrize("kind,want", [("standard", (2.5, 1.25**0.5)), ("minmax", (1.0, 3.0)), ("quantile", (2.5, 1.5))])
def test_scalers(spark, tmp_path, kind, want):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 5, None), (2.0, 5, None), (3.0, 5, None), (4.0, 5, None), (None, None, None)], "x double, y int, z double")
    df = df.unionByName(spark.createDataFrame([(nan, 5, None)], df.schema)) if kind != "quantile" else df
    fitted = fit_scaler(df, ["x", "y", "z"], kind)
    found = {r["column"]: (r["shift"], r["scale"]) for r in fitted.collect()}
    assert found["x"] == pytest.approx(want) and found["y"] == (5.0, 1.0) and found["z"] == (None, None)
    saved = save_checkpoint(fitted, str(tmp_path), kind)
    one, two = (scaled(df, s, "_s").select("x_s", "y_s", "z_s").toPandas() for s in (fitted, load_checkpoint(spark, str(tmp_path), kind)))
    assert one.equals(two) and saved.count() == 3
    rows = scaled(df.where("x = 4"), fitted).first()
    assert (rows["x"], rows["y"], rows["z"]) == (pytest.approx((4 - want[0]) / want[1]), 0.0, None)


def test_a_stream_is_scaled_like_a_table(spark, tmp_path):
    table = spark.range(50).selectExpr("id", "id * 1.5D AS x")
    table.write.parquet(f"{tmp_path}/in")
    fitted = fit_scaler(table, ["x"])
    stream = scaled(spark.readStream.schema(table.schema).parquet(f"{tmp_path}/in"), fitted)
    query = stream.writeStream.format("memory").queryName("scaled_rows").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    query.awaitTermination()
    assert sorted(spark.table("scaled_rows").collect()) == sorted(scaled(table, fitted).collect())


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="none of"):
        fit_scaler(spark.range(1), ["id"], "other")
