"""The whole analysis of a small review file, with models, segments and a stream."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from stayscope.operators import cluster, features, models, recommend
from stayscope.operators.sampling import hash_split
from stayscope.operators.tokens import labelled_texts
from stayscope.plans import reviews as R
from stayscope.sources import (
    column_types,
    cut_lineage,
    head_rows,
    in_file_order,
    load_checkpoint,
    read_table,
    save_checkpoint,
    shape,
    shared_folder,
    spread_rows,
)
from stayscope.streaming import negative_alerts, score_stream

GOOD = ["Lovely rooms, helpful staff", "Great breakfast and views", "Very clean and quiet rooms", "Perfect location"]
BAD = ["Dirty bathrooms and rude staff", "The heater was broken", "Noisy street, no towels", "Cold breakfast"]
EMPTY_BAD = ["No Negative", "Nothing", "not at all", "I have no negative comments", "N/A", "  "]
COLUMNS = [f.split()[0] for f in R.RAW_SCHEMA.replace("\n", " ").split(",")]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """A compressed review file, its columns in another order than the schema, and a country file."""
    folder, rng = tmp_path_factory.mktemp("files"), random.Random(5)
    order = COLUMNS[::-1]
    lines = [",".join(order)]
    for i in range(900):
        h = i % 12
        row = {
            "Hotel_Address": f"{h} Street {['London United Kingdom', 'Vienna Austria', 'Nowhere'][h % 3]}",
            "Additional_Number_of_Scoring": h * 10, "Review_Date": f"{1 + i % 12}/{1 + i % 28}/2017",
            "Average_Score": 5 + h * 0.4, "Hotel_Name": f"Hotel {h if h != 11 else 10}",
            "Reviewer_Nationality": [" Austria ", " ", " France "][i % 3],
            "Negative_Review": rng.choice(BAD + EMPTY_BAD), "Review_Total_Negative_Word_Counts": 3,
            "Total_Number_of_Reviews": 100 + h, "Positive_Review": rng.choice([*GOOD, "No Positive", "Nothing"]),
            "Review_Total_Positive_Word_Counts": 4, "Total_Number_of_Reviews_Reviewer_Has_Given": 1 + i % 7,
            "Reviewer_Score": rng.randrange(25, 100) / 10, "Tags": f"[' Trip {i % 4} ', ' Couple ']",
            "days_since_review": f"{i} days" if i != 1 else "1 day", "lat": "NA" if h == 5 else 48.5 + h, "lng": "NA" if h == 5 else 16.25,
        }
        lines.append(",".join('"' + str(row[c]) + '"' if isinstance(row[c], str) else str(row[c]) for c in order))
    lines += lines[1:21]
    with gzip.open(folder / "reviews.csv.gz", "wt") as f:
        f.write("\n".join(lines))
    (folder / "lookup.tsv").write_text("ISO\tlat\tlng\tname\nAT\t47.5\t14.5\tAustria\nNA\t-22.9\t18.4\tNamibia\nUM\t\t\tIslands\nGB\t55.3\t-3.4\tUnited Kingdom\n")
    return folder


@pytest.fixture(scope="module")
def raw(spark, files):
    """The scanned review file."""
    return read_table(spark, str(files / "reviews.csv.gz"), R.RAW_SCHEMA, compressed_parts=4).cache()


@pytest.fixture(scope="module")
def cleaned(spark, files, raw):
    """Repaired, typed, enriched and tokenised reviews."""
    countries = read_table(spark, str(files / "lookup.tsv"), R.COUNTRY_SCHEMA, sep="\t")
    countries = in_file_order(countries)
    assert [r.ISO for r in countries.orderBy("ord").collect()] == ["AT", "NA", "UM", "GB"]
    assert countries.where("ISO = 'NA'").count() == 1 and countries.where("lat is null").count() == 1
    return cut_lineage(R.tokenised(R.enriched(R.typed(R.repair(raw)), countries, "ord")))


def test_scan(raw, rows):
    assert raw.columns == COLUMNS
    assert rows(shape(raw)) == [(920, 17)]
    assert dict(rows(column_types(raw)))["Average_Score"] == "double"
    assert raw.rdd.getNumPartitions() == 4
    first = head_rows(raw, 2, [F.desc("Average_Score"), "Review_Date"]).collect()
    assert [r.Average_Score for r in first] == [9.4, 9.4]


def test_scan_keeps_corrupt_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\noops,y\n")
    got = read_table(spark, str(tmp_path / "t.csv"), "a int, b string", keep_corrupt=True).cache()
    assert [r._corrupt_record for r in got.orderBy("b").collect()] == [None, "oops,y"]
    with pytest.raises(ValueError, match="differ"):
        read_table(spark, str(tmp_path / "t.csv"), "a int, c string")


def test_checkpoints(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    save_checkpoint(df.withColumn("s", F.lit("old")), str(tmp_path), "x")
    assert rows(save_checkpoint(df, str(tmp_path), "x")) == rows(load_checkpoint(spark, str(tmp_path), "x")) == [(1, "a")]
    assert shared_folder(spark) == shared_folder(spark)
    assert spread_rows(df.repartition(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_cleaning(raw, cleaned, rows):
    assert cleaned.count() == R.repair(raw).count() == 900
    again = R.repair(R.repair(raw))
    assert again.exceptAll(R.repair(raw)).count() == 0
    assert cleaned.where("Negative_Review in ('Nothing', 'not at all', 'No Negative', 'N/A')").count() == 0
    assert cleaned.where("Positive_Review = 'Nothing' or Negative_Review like '%no negative%'").count() == 0
    bad = cleaned.where("Negative_Review is null and (Negative_Lemma_Count is not null or size(Negative_Filtered_Tokens) > 0)")
    assert bad.count() == 0
    assert cleaned.where("lat is null").select("Hotel_Address").distinct().count() == 1
    assert rows(cleaned.groupBy("Country").count()) == sorted([("AT", 300), ("GB", 300), (None, 300)], key=repr)
    assert rows(cleaned.select("Country", "Country_Encoded").distinct()) == sorted([("AT", 0.0), ("GB", 1.0), (None, 2.0)], key=repr)
    assert cleaned.where("Num_Tags = 2 and days_since_review is not null and Review_Date is not null").count() == 900


def test_lemmas_keep_the_counts(cleaned):
    keyed = cleaned.withColumn("id", F.md5(F.to_json(F.struct(*cleaned.columns))))
    out = R.lemmatised(keyed, "id")
    assert out.count() == 900
    assert out.where("size(Negative_Lemmatized) <> size(Negative_Filtered_Tokens)").count() == 0
    words = {r.w for r in out.select(F.explode("Positive_Lemmatized").alias("w")).distinct().collect()}
    assert "rooms" in words or "room" in words


@pytest.fixture(scope="module")
def stars(cleaned):
    """Hotel features with stars."""
    return cut_lineage(R.with_stars(R.hotel_features(cleaned, R.hotels_of(cleaned))))


def test_hotel_features(cleaned, stars):
    by_name = {}
    for r in stars.collect():
        by_name.setdefault(r.Hotel_Name, []).append(r)
    assert len(by_name) == 11 and len(by_name["Hotel 10"]) == 2
    one = by_name["Hotel 3"][0]
    mine = [r for r in cleaned.where("Hotel_Name = 'Hotel 3'").collect()]
    counts = [r.Negative_Lemma_Count for r in mine if r.Negative_Lemma_Count is not None]
    assert one.review_count == 75 and one.avg_Negative_Lemma_Count == pytest.approx(sum(counts) / len(counts))
    assert all(r.star_rating_adj == r.star_rating - 1 and 2 <= r.star_rating <= 5 for r in stars.collect())


def test_models(stars, rows):
    vectors = features.assemble(stars, R.REGRESSION_FEATURES).withColumn("label", F.col("avg_Average_Score"))
    got = models.compare_regressors(vectors, vectors, models.regressors(trees=5, rounds=3))
    assert [r.name for r in got.collect()] == ["Linear Regression", "Random Forest", "Gradient Boosted Trees"]
    assert all(r.rmse >= 0 and r.r2 <= 1 for r in got.collect())
    vectors = features.assemble(stars, R.STAR_FEATURES).withColumn("label", F.col("star_rating_adj"))
    kinds = models.classifiers(len(R.STAR_FEATURES), trees=5)
    got = models.compare_classifiers(vectors, vectors, kinds)
    assert {r.name for r in got.collect()} == set(kinds) and all(0 <= r.accuracy <= 1 and 0 <= r.f1 <= 1 for r in got.collect())
    forest = models.fit_all(vectors, {"f": kinds["Random Forest"]})["f"]
    weights = {r.feature: r.importance for r in models.importances(forest, R.STAR_FEATURES, stars).collect()}
    assert set(weights) == set(R.STAR_FEATURES) and sum(weights.values()) == pytest.approx(1)
    assert models.actual_vs_predicted(forest.transform(vectors)).columns == ["prediction", "label"]


def test_segments(cleaned, stars):
    costs = [r.wss for r in cluster.elbow(stars, R.SEGMENT_FEATURES, [2, 3, 4, 5]).orderBy("k").collect()]
    assert costs[0] >= costs[-1]
    for method in ("kmeans", "bisecting"):
        rows = cluster.segment(stars, R.SEGMENT_FEATURES, 3, method)
        assert rows.count() == stars.count() and -1 <= cluster.silhouette(rows) <= 1
    placed = features.project_2d(rows)
    assert placed.where("pc1 is null or pc2 is null").count() == 0
    with pytest.raises(Exception, match="(?i)null"):
        cluster.segment(cleaned, R.REVIEW_SEGMENT_FEATURES, 2).collect()
    assert cluster.segment(cleaned, R.REVIEW_SEGMENT_FEATURES, 2, nulls="zero").count() == 900
    kept = cleaned.dropna(subset=R.REVIEW_SEGMENT_FEATURES).count()
    assert cluster.segment(cleaned, R.REVIEW_SEGMENT_FEATURES, 2, nulls="skip", scale=True).count() == kept


def test_recommendations(spark):
    rng = random.Random(2)
    data = [(u, i, float(1 + (u + i) % 5)) for u in range(30) for i in range(12) if rng.random() < 0.6] + [(0, 0, 3.0)] * 3
    df = spark.createDataFrame(data, "u int, i int, r double")
    model = recommend.fit_als(df, "u", "i", "r", maxIter=3)
    best = recommend.recommend(model, 4)
    assert best.columns == ["u", "i", "rating"] and best.count() == 30 * 4
    some = recommend.recommend(model, 4, df.where("u < 3").select("u").distinct())
    assert some.count() == 12


def test_sentiment_and_stream(spark, raw, tmp_path):
    texts = labelled_texts(R.repair(raw), "Positive_Review", "Negative_Review")
    train, test = hash_split(texts, ["text", "label"], [0.8, 0.2])
    assert train.count() + test.count() == texts.count()
    for sizes in ((1,), (2,), (1, 2)):
        model = models.sentiment_model(sizes, features=200).fit(texts)
        scored = models.score_texts(model, texts)
        assert scored.columns == ["text", "label", "prediction", "p_negative", "p_positive"]
        assert scored.where("prediction = label").count() / scored.count() > 0.9
    model.write().overwrite().save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    new = spark.createDataFrame([("rude staff and dirty bathrooms",), ("great clean rooms",), (None,)], "remark string")
    scored = {r.remark: r.prediction for r in models.score_texts(model, new, "remark").collect()}
    assert len(scored) == 3 and scored[None] is None and scored["great clean rooms"] is not None
    source = save_checkpoint(texts, str(tmp_path), "texts")
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "checkpoint-texts"))
    for _ in range(2):  # the second run finds nothing new
        query = score_stream(model, stream, 0.5, str(tmp_path / "alerts"), str(tmp_path / "progress"))
        query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "alerts"))
    want = negative_alerts(model, source, 0.5)
    assert got.count() == want.count() > 0
    assert got.select("text", "label").exceptAll(want.select("text", "label")).count() == 0
