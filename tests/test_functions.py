"""Column expressions on edge rows."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import RegexTokenizer, Tokenizer
from pyspark.sql import functions as F

from stayscope import functions as fn


def values(spark, data, kind, expr):
    """Results of an expression over one column `c`, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, c {kind}")
    return [r.v for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def test_dates(spark):
    got = values(spark, ["8/3/2017", "13/45/2017", None], "string", fn.parse_date("c").cast("string"))
    assert got == ["2017-08-03", None, None]


def test_days(spark):
    got = values(spark, ["0 days", "1 day", "3 weeks", "x days", None], "string", fn.parse_days("c"))
    assert got == [0, 1, None, None, None]
    assert values(spark, ["12 days", None], "string", fn.parse_days("c", strict=True)) == [12, None]
    with pytest.raises(Exception, match="not a number of days"):
        values(spark, ["3 weeks"], "string", fn.parse_days("c", strict=True))


def test_tags(spark):
    data = ["[' Leisure trip ', ' Couple ']", "[]", "", None]
    assert values(spark, data, "string", fn.tag_count("c")) == [2, 0, 0, None]
    assert values(spark, data, "string", fn.tag_list("c")) == [["Leisure trip", "Couple"], [], [], None]
    data = ["""["Couple's trip", 'Leisure']""", "[a, b]", "[ 'one' ]", "''", "ab", "['', 'x']"]
    assert values(spark, data, "string", fn.tag_count("c")) == [2, 2, 1, 0, 0, 2]
    assert values(spark, data, "string", fn.tag_list("c")) == [["Couples trip", "Leisure"], ["a", "b"], ["one"], [], [], ["", "x"]]


def test_words(spark):
    data = ["  Hello  the World ", "", None]
    assert values(spark, data, "string", fn.word_count("c")) == [3, 1, 0]
    assert values(spark, data, "string", fn.text_or_empty("c")) == ["Hello  the World", "", ""]
    assert values(spark, ["A,b! Ç-1"], "string", fn.normalise_text("c")) == ["a b 1"]


def test_tokens_match_the_library_tokenizers(spark):
    texts = ["Café été didn't WORK", "  Hello  the World ", "", "   ", " a", "tab\tand\nline", "x,,y"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    word = RegexTokenizer(inputCol="c", outputCol="w", pattern="\\W")
    space = Tokenizer(inputCol="c", outputCol="s")
    got = space.transform(word.transform(df)).select(
        "w", fn.word_tokens("c").alias("mine_w"), "s", fn.space_tokens("c").alias("mine_s")
    )
    for r in got.collect():
        assert r.w == r.mine_w
        assert r.s == r.mine_s
    assert values(spark, [None], "string", fn.word_tokens("c")) == [None]


def test_token_count(spark):
    assert values(spark, [[], None, ["a"]], "array<string>", fn.token_count("c")) == [None, None, 1]


def test_sequences(spark):
    data = [["no", "negative"], ["no", "x", "negative"], ["no"], None, ["casino", "negative"], ["a", "no", "negative"]]
    got = values(spark, data, "array<string>", fn.contains_sequence("c", ["no", "negative"]))
    assert got == [True, False, False, False, False, True]
    data = [["not", "at", "all"], ["not", "at", "all", "x"], ["not", "at", "all", "x", "y"], ["was", "not", "at", "all"], [], None]
    got = values(spark, data, "array<string>", fn.starts_with_tokens("c", ["not", "at", "all"], [3, 4]))
    assert got == [True, True, False, False, False, False]


def test_buckets(spark):
    scores = [9.0, 8.99, 8.0, 6.0, 5.0, 4.9, None]
    assert values(spark, scores, "double", fn.star_rating("c")) == [5, 4, 4, 3, 2, 1, 1]
    assert values(spark, [8.0, 6.0, 5.9], "double", fn.marker_colour("c")) == ["green", "orange", "red"]
    assert values(spark, [3.0], "double", fn.bucket(F.col("c"), [(1, "x")], "y")) == ["x"]
