"""What must not grow with the input, read off plans and partitions of small tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from catalogue import enrichment, graphs, learning
from stayscope.operators import cluster as C
from stayscope.operators import geo
from stayscope.operators import joins as J
from stayscope.sources import cut_lineage, even_rows, tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_table_beyond_the_limit_is_never_broadcast(spark):
    df = spark.range(200).select((F.col("id") % 50).alias("k"), "id")
    table = cut_lineage(spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")))
    for how in ("left", "inner"):
        joined = J.attach(df, table, "k", how, max_broadcast=10)
        assert "SortMergeJoin" in _plan(joined) and "Broadcast" not in _plan(joined)
        assert sorted(map(tuple, joined.collect())) == sorted((i % 50, i, i % 50 * 2) for i in range(200))
        assert "BroadcastHashJoin" in _plan(J.attach(df, table, "k", how))


def test_no_split_keeps_more_rows_than_allowed(spark):
    scan = cut_lineage(spark.range(1000).selectExpr("id", "id % 3 AS x").coalesce(1))
    dealt = even_rows(scan, 100)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) <= 150
    assert sorted(map(tuple, dealt.collect())) == [(i, i % 3) for i in range(1000)]
    assert even_rows(scan, 1000).rdd.getNumPartitions() == scan.rdd.getNumPartitions()


def test_reviews_are_dealt_out_before_they_are_segmented(spark, monkeypatch):
    reviews = spark.range(900).select(*[(F.col("id") % (i + 5)).cast("int").alias(c) for i, c in enumerate(learning.R.REVIEW_SEGMENT_FEATURES)])
    seen = []

    def segmented(df, *_, **__):
        seen.append(df.rdd.getNumPartitions())
        return df.withColumn("cluster", F.lit(0))

    monkeypatch.setattr(learning.R, "tokenised", lambda df: reviews.withColumn("Reviewer_Score", F.lit(1.0)).coalesce(1))
    monkeypatch.setattr(learning.R, "typed", lambda df: df)
    monkeypatch.setattr(learning.R, "repair", lambda df: df)
    monkeypatch.setattr(learning, "raw_reviews", lambda *_: None)
    monkeypatch.setattr(C, "segment", segmented)
    monkeypatch.setattr(learning, "even_rows", lambda scan: even_rows(scan, 100))
    learning.review_segments(spark, "")
    learning.reviews_in_segments(spark, "")
    assert seen == [9, 9] and tables.ROWS_PER_TASK <= 2_000_000


def test_reviews_per_country_makes_the_reviews_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            made.add(1)
            yield row

    reviews = spark.createDataFrame([(f"Street {i} PERU", f"hotel{i % 4}") for i in range(40)], "Hotel_Address string, Hotel_Name string")
    schema = reviews.schema
    monkeypatch.setattr(enrichment, "typed_reviews", lambda *_: spark.createDataFrame(reviews.rdd.mapPartitions(counted), schema))
    nations = spark.createDataFrame([("N1", "Peru", 1)], "ISO string, name string, ord int")
    monkeypatch.setattr(enrichment, "nation_lookup", lambda *_: nations)
    got = enrichment.reviews_per_country(spark, "").collect()
    assert [tuple(r) for r in got] == [("N1", 40, 4)]
    assert made.value == 40


def test_edges_move_only_the_columns_they_are_made_of(spark, monkeypatch):
    texts = ["Hotel_Address", "Negative_Review", "Positive_Review", "days_since_review"]
    rows = [("A", " ", "t", 3, 7.0, "1/2/2020", "x"), ("A", None, "t", 3, 8.0, "1/2/2020", "y"), ("A", " ", "t", 3, 9.0, "1/1/2020", "z"), ("B", "N", "t", 3, 5.0, None, "x")]
    raw = spark.createDataFrame(
        rows, "Hotel_Name string, Reviewer_Nationality string, Tags string, Total_Number_of_Reviews_Reviewer_Has_Given int, "
        "Reviewer_Score double, Review_Date string, Negative_Review string",
    )
    raw = raw.withColumns({c: F.col("Negative_Review") for c in texts if c != "Negative_Review"}).withColumn("Average_Score", F.lit(4.0))
    monkeypatch.setattr(graphs, "raw_reviews", lambda *_: raw)
    found = graphs.guest_hotel_edges(spark, "")
    assert sorted(map(tuple, found.collect())) == [("N_t_3", "B", 5.0), ("t_3", "A", 8.0)]
    assert not any(c in _plan(found).split("Scan ExistingRDD")[0] for c in texts)
    assert sorted(map(tuple, graphs.scores_of_top_hotels(spark, "").collect())) == [("A", 4.0), ("B", 4.0)]


def test_points_meet_only_outlines_whose_box_holds_them(spark, monkeypatch):
    met = []

    def counted(df, table, on, how="left", **given):
        if on == "_region":
            met.append(df.count())
        return J.attach(df, table, on, how, **given)

    monkeypatch.setattr(geo, "attach", counted)
    corners = [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 1.0}]
    regions = spark.createDataFrame([(code, corners) for code in range(20)], "code long, vertices array<struct<x double, y double>>")
    points = spark.createDataFrame([(1, 0.2, 0.2), (2, 0.9, 0.9), (3, 1.5, 1.5), (4, None, 1.0)], "id long, x double, y double")
    found = geo.point_lookup(points, "x", "y", regions, "code", cell=2.0, out="code")
    assert sorted(map(tuple, found.select("id", "code").collect())) == [(1, 0), (2, None), (3, None), (4, None)]
    assert met == [40]


def test_a_merge_of_narrow_rows_is_spread_over_the_tasks_given(spark):
    table = cut_lineage(spark.range(60).selectExpr("id AS k", "id * 2 AS v"))
    joined = J.attach(spark.range(200).selectExpr("id % 50 AS k", "id"), table, "k", "inner", max_broadcast=10, tasks=7)
    assert joined.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, joined.collect())) == sorted((i % 50, i, i % 50 * 2) for i in range(200))
