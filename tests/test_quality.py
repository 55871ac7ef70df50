"""Repair of missing, disguised and repeated values."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayscope.operators import quality as Q
from stayscope.operators import tokens as K


def test_blanks_and_tokens(spark, rows):
    df = spark.createDataFrame([("", 1), ("   ", 2), ("x", 3), (None, 4)], "a string, i int")
    assert rows(Q.blank_to_null(df)) == sorted([(None, 1), (None, 2), ("x", 3), (None, 4)], key=repr)
    df = spark.createDataFrame([("N/A",), (" na ",), (" N A",), ("None",), ("ok ",)], "a string")
    got = [r.a for r in Q.nullify(df, ["a"], Q.DISGUISED_NULLS).collect()]
    assert got == [None, None, "N A", None, "ok"]
    df = spark.createDataFrame([("No Negative",), ("no negative",)], "a string")
    assert [r.a for r in Q.nullify(df, ["a"], ["No Negative"], trim=False).collect()] == [None, "no negative"]


def test_floats(spark):
    df = spark.createDataFrame([("NA",), ("48.25",), (None,), ("x",)], "lat string")
    assert [r.lat for r in Q.to_float(df, ["lat"]).collect()] == [None, 48.25, None, None]


def test_counts(spark, rows):
    df = spark.createDataFrame([("NA", 1.0), (None, float("nan")), ("x", None)], "a string, b double")
    assert rows(Q.null_counts(df)) == [("a", 1), ("b", 1)]
    assert rows(Q.invalid_counts(df, ["a", "b"])) == [("a", 1, 0), ("b", 1, 1)]
    assert rows(Q.disguised_null_counts(df)) == [("a", 1)]
    empty = df.where("false")
    assert rows(Q.null_counts(empty)) == [("a", 0), ("b", 0)]


def test_dedupe(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "c"), (None, "c")], "k int, v string")
    assert rows(Q.dedupe(df)) == sorted([(1, "a"), (1, "b"), (None, "c")], key=repr)
    assert rows(Q.dedupe(df, ["k"])) == sorted([(1, "a"), (None, "c")], key=repr)
    assert rows(Q.dedupe_report(df)) == [(3, 5, 0.6)]
    assert rows(Q.dedupe_report(df.where("false"))) == [(0, 0, None)]


def test_places(spark, rows):
    df = spark.createDataFrame([("a street", "NA", "1"), ("b", "2", "3"), ("c street", None, "1")], "adr string, lng string, lat string")
    assert rows(Q.non_matching(df, ["lng", "lat"], "[0-9]", ["adr"])) == [("a street",)]
    assert rows(Q.non_matching(df, ["lng", "lat"], "[0-9]", ["adr"], missing=True)) == [("a street",), ("c street",)]
    assert rows(Q.short_values(df, "adr", 3).select("adr")) == [("b",)]


def test_neutralise_and_audit(spark, rows):
    texts = ["not at all", "not at all x", "not at all x y", "was not at all", "nothing", "nothing really",
             "nothing was bad", "I have no negative comments", "The only negative was no mirror", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("n", F.lit(7))
    df = K.tokenize(df, "text", "t")
    rules = {"all": K.short_not_at_all("t"), "nothing": K.short_nothing("t"), "no": K.says_no("t", "negative")}
    after = df
    for rule in rules.values():
        after = Q.neutralise(after, rule, "text", "t", "n")
    assert rows(Q.rule_audit(df, after, rules)) == [("all", 2, 0), ("no", 1, 0), ("nothing", 2, 0)]
    kept = [r.text for r in after.where("text is not null").collect()]
    assert kept == ["not at all x y", "was not at all", "nothing was bad", "The only negative was no mirror"]
    emptied = after.where("text is null and t is not null").select(F.size("t").alias("s"), "n").collect()
    assert [(r.s, r.n) for r in emptied] == [(0, 0)] * 5
    again = after
    for rule in rules.values():
        again = Q.neutralise(again, rule, "text", "t", "n")
    assert rows(again) == rows(after)
