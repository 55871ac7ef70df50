"""Metrics on given predictions; fitted models reported as tables."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from catalogue.base import REPAIRED, Entries, raw_reviews, table
from catalogue.enrichment import nation_lookup
from stayscope.operators import cluster as C
from stayscope.operators import metrics as M
from stayscope.operators import models as L
from stayscope.operators.counting import group_counts
from stayscope.operators.features import assemble, project_2d
from stayscope.operators.sampling import hash_split
from stayscope.operators.tokens import labelled_texts
from stayscope.plans import reviews as R
from stayscope.sources import cut_lineage, even_rows, save_checkpoint, shared_folder
from stayscope.streaming import negative_alerts, score_stream

entries = Entries()


def _predictions(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_discount") > 0.05).cast("int").alias("prediction"),
        (F.col("l_linenumber") % 4).alias("stars"),
        (F.col("l_partkey") % 5).cast("int").alias("guess"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * 1500).alias("estimate"),
    )


_PRED = """p AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS prediction, l_linenumber % 4 AS stars,
  CAST(l_partkey % 5 AS INTEGER) AS guess, l_extendedprice AS price, l_quantity * 1500 AS estimate FROM lineitem)"""


@entries.add(f"WITH {_PRED} SELECT stars, guess, count(*) AS n FROM p GROUP BY 1, 2 ORDER BY 1, 2")
def confusion_cells(spark, sf_dir):
    """Rows per label and prediction."""
    return M.confusion(_predictions(spark, sf_dir), "stars", "guess").orderBy("stars", "guess")


@entries.add(
    f"WITH {_PRED} SELECT stars, "
    + ", ".join(f'count(*) FILTER (guess = {g}) AS "{g}"' for g in range(6))
    + " FROM p GROUP BY 1"
)
def confusion_matrix(spark, sf_dir):
    """Rows per label with one column per prediction, one of them never made."""
    return M.confusion(_predictions(spark, sf_dir), "stars", "guess", pivot=list(range(6)))


@entries.add(
    f"""WITH {_PRED} SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM p"""
)
def hits_and_misses(spark, sf_dir):
    """True and false positives and negatives."""
    return M.binary_counts(_predictions(spark, sf_dir), "label", "prediction")


@entries.add(
    f"""WITH {_PRED}, l AS (SELECT DISTINCT stars AS v FROM p UNION SELECT DISTINCT guess FROM p),
    m AS (SELECT v, (SELECT count(*) FROM p WHERE stars = v AND guess = v)::DOUBLE AS hit,
      (SELECT count(*) FROM p WHERE stars = v)::DOUBLE AS rows, (SELECT count(*) FROM p WHERE guess = v)::DOUBLE AS guessed FROM l),
    r AS (SELECT *, coalesce(hit / nullif(guessed, 0), 0) AS prec, coalesce(hit / nullif(rows, 0), 0) AS rec FROM m)
    SELECT round(sum(hit) / sum(rows), 6) AS accuracy,
      round(sum(rows * coalesce(2 * prec * rec / nullif(prec + rec, 0), 0)) / sum(rows), 6) AS f1,
      round(sum(rows * prec) / sum(rows), 6) AS weighted_precision, round(sum(rows * rec) / sum(rows), 6) AS weighted_recall,
      round(max(prec) FILTER (v = 2), 6) AS precision_of_label, round(max(rec) FILTER (v = 2), 6) AS recall_of_label FROM r"""
)
def class_quality(spark, sf_dir):
    """Accuracy and weighted f1, precision and recall."""
    out = M.class_metrics(_predictions(spark, sf_dir), "stars", "guess", positive=2)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@entries.add(
    f"""WITH {_PRED} SELECT round(sqrt(avg((price - estimate)^2)), 4) AS rmse,
    round(1 - sum((price - estimate)^2) / (var_pop(price) * count(*)), 6) AS r2, count(*) AS n, 0::BIGINT AS left_out FROM p"""
)
def regression_quality(spark, sf_dir):
    """Root mean squared error and explained variance."""
    out = M.regression_metrics(_predictions(spark, sf_dir), "price", "estimate")
    return out.select(F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"), "n", "left_out")


@entries.add(
    f"""WITH {_PRED}, s AS (SELECT price, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM p GROUP BY 1),
    r AS (SELECT *, sum(neg) OVER (ORDER BY price) - neg / 2.0::DOUBLE AS below FROM s)
    SELECT round(sum(pos * below) / (sum(pos) * sum(neg)), 6) AS auc FROM r"""
)
def area_under_curve(spark, sf_dir):
    """Area under the ROC curve with the price as the score."""
    return M.auc(_predictions(spark, sf_dir), "label", "price").withColumn("auc", F.round("auc", 6))


@entries.add(f"WITH {_PRED} SELECT price, stars, guess FROM p WHERE stars <> guess")
def wrong_guesses(spark, sf_dir):
    """Rows whose prediction differs from the label."""
    return M.misclassified(_predictions(spark, sf_dir), "stars", "guess", ["price"])


@entries.add(f"WITH {_PRED} SELECT label, count(*) AS n FROM p GROUP BY 1 ORDER BY 1")
def label_balance(spark, sf_dir):
    """Rows per label."""
    return group_counts(_predictions(spark, sf_dir), ["label"]).orderBy("label")


@entries.add(
    """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
    SELECT l_quantity, round(any_value(a * l_quantity + b), 2) AS prediction, count(*) AS n FROM lineitem, m GROUP BY 1"""
)
def price_line(spark, sf_dir):
    """Predictions of a fitted line with one feature."""
    rows = assemble(table(spark, sf_dir, "lineitem"), ["l_quantity"])
    model = LinearRegression(featuresCol="features", labelCol="l_extendedprice").fit(rows)
    scored = model.transform(rows).groupBy("l_quantity")
    return scored.agg(F.round(F.first("prediction"), 2).alias("prediction"), F.count(F.lit(1)).alias("n"))


@entries.add(
    """WITH s AS (SELECT covar_pop(l_extendedprice, l_quantity) AS y1, covar_pop(l_extendedprice, l_discount) AS y2,
      var_pop(l_quantity) AS v1, var_pop(l_discount) AS v2, covar_pop(l_quantity, l_discount) AS c,
      avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2 FROM lineitem),
    w AS (SELECT *, (y1 * v2 - y2 * c) / (v1 * v2 - c * c) AS a, (y2 * v1 - y1 * c) / (v1 * v2 - c * c) AS b FROM s)
    SELECT l_quantity, l_discount, round(any_value(my + a * (l_quantity - m1) + b * (l_discount - m2)), 1) AS prediction, count(*) AS n
    FROM lineitem, w GROUP BY 1, 2"""
)
def price_plane(spark, sf_dir):
    """Predictions of a linear regression on two features."""
    rows = assemble(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"])
    model = LinearRegression(featuresCol="features", labelCol="l_extendedprice").fit(rows)
    scored = model.transform(rows).groupBy("l_quantity", "l_discount")
    return scored.agg(F.round(F.first("prediction"), 1).alias("prediction"), F.count(F.lit(1)).alias("n"))


def _placed_customers(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        (F.col("c_acctbal") / 1000).alias("x"), (F.col("c_custkey") % 7).cast("double").alias("y"),
        (F.col("c_nationkey") % 3).cast("int").alias("cluster"),
    )
    return assemble(customers, ["x", "y"])


@entries.add(
    """WITH p AS (SELECT c_acctbal / 1000 AS x, (c_custkey % 7)::DOUBLE AS y, c_nationkey % 3 AS c FROM customer),
    s AS (SELECT c, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS sq FROM p GROUP BY 1),
    d AS (SELECT x, y, p.c, s.c AS other, n, x * x + y * y + sq / n - 2 * (x * sx + y * sy) / n AS d FROM p, s),
    e AS (SELECT x, y, c, min(d) FILTER (other <> c) AS b, any_value(d * n / (n - 1)) FILTER (other = c) AS a
      FROM d GROUP BY x, y, c)
    SELECT round(sum(k * CASE WHEN a < b THEN 1 - a / b ELSE b / a - 1 END) / sum(k), 6) AS silhouette
    FROM e JOIN (SELECT x, y, c, count(*) AS k FROM p GROUP BY 1, 2, 3) USING (x, y, c)"""
)
def silhouette_of_groups(spark, sf_dir):
    """Mean silhouette of a clustering that is given."""
    value = C.silhouette(_placed_customers(spark, sf_dir))
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


@entries.add(
    """WITH p AS (SELECT c_custkey, c_acctbal / 1000 AS x, (c_custkey % 7)::DOUBLE AS y FROM customer),
    t AS (SELECT 0.5::DOUBLE * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) AS t FROM p)
    SELECT round(sum(abs(x * cos(t) + y * sin(t))), 3) AS pc1, round(sum(abs(y * cos(t) - x * sin(t))), 3) AS pc2, count(*) AS n FROM p, t"""
)
def sizes_on_two_components(spark, sf_dir):
    """Total size of all points on the principal components of two columns, whose signs are free."""
    placed = project_2d(_placed_customers(spark, sf_dir))
    sizes = [F.round(F.sum(F.abs(F.col(c))), 3).alias(c) for c in ("pc1", "pc2")]
    return placed.agg(*sizes, F.count(F.lit(1)).alias("n"))


WHOLE_LINES = 2_000_000


def _cleaned(spark, sf_dir, cols):
    """Columns of the cleaned reviews. Many reviews are told apart by digests; few are moved whole, which keeps their order."""
    raw = raw_reviews(spark, sf_dir)
    if sf_dir and table(spark, sf_dir, "lineitem").count() > WHOLE_LINES:
        return R.repair_to(raw, lambda df: R.tokenised(R.typed(df)), cols)
    return R.tokenised(R.typed(R.repair(raw))).select(*cols)


def _hotels(spark, sf_dir):
    """Hotel features joined to hotel rows, with stars.

    The cleaned reviews and the features are written once each, as several passes read them.
    """
    used = list(dict.fromkeys([*R.HOTEL_COLUMNS, "Reviewer_Nationality", *R.AVERAGED]))
    df = R.enriched(cut_lineage(_cleaned(spark, sf_dir, used)), nation_lookup(spark, sf_dir), "ord")
    return cut_lineage(R.with_stars(R.hotel_features(df, R.hotels_of(df))))


def _hotel_rows(spark, sf_dir):
    """Hotel features as models take them, with 0 words where no remark of a hotel says anything."""
    return R.without_words_zero(_hotels(spark, sf_dir))


def _star_rows(spark, sf_dir):
    rows = assemble(_hotel_rows(spark, sf_dir), R.STAR_FEATURES)
    return rows.withColumn("label", F.col("star_rating_adj").cast("double"))


@entries.add()
def hotel_score_regressors(spark, sf_dir):
    """Three regressors of the mean score, compared on held-out hotels."""
    rows = assemble(_hotel_rows(spark, sf_dir), R.REGRESSION_FEATURES)
    rows = rows.withColumn("label", F.col("avg_Average_Score"))
    train, test = hash_split(rows, ["Hotel_Name", "Hotel_Address"], [0.8, 0.2])
    return L.compare_regressors(train, test, L.regressors())


@entries.add()
def star_classifiers(spark, sf_dir):
    """Four classifiers of the stars, compared on held-out hotels."""
    train, test = hash_split(_star_rows(spark, sf_dir), ["Hotel_Name", "Hotel_Address"], [0.8, 0.2])
    return L.compare_classifiers(train, test, L.classifiers(len(R.STAR_FEATURES)))


@entries.add()
def star_importances(spark, sf_dir):
    """Feature importances of the forest that predicts stars."""
    rows = _star_rows(spark, sf_dir)
    forest = {"forest": L.classifiers(len(R.STAR_FEATURES))["Random Forest"]}
    return L.importances(L.fit_all(rows, forest)["forest"], R.STAR_FEATURES, rows)


@entries.add()
def misjudged_hotels(spark, sf_dir):
    """Held-out hotels whose stars the decision tree gets wrong."""
    train, test = hash_split(_star_rows(spark, sf_dir), ["Hotel_Name", "Hotel_Address"], [0.8, 0.2])
    model = L.classifiers(len(R.STAR_FEATURES))["Decision Tree"].fit(train)
    return M.misclassified(model.transform(test), "label", "prediction", ["Hotel_Name", "avg_Average_Score"])


@entries.add()
def actual_and_predicted_scores(spark, sf_dir):
    """Mean score and its prediction for held-out hotels."""
    rows = assemble(_hotel_rows(spark, sf_dir), R.REGRESSION_FEATURES)
    rows = rows.withColumn("label", F.col("avg_Average_Score"))
    train, test = hash_split(rows, ["Hotel_Name", "Hotel_Address"], [0.8, 0.2])
    return L.actual_vs_predicted(L.regressors()["Linear Regression"].fit(train).transform(test))


def _remarks(spark, sf_dir):
    reviews = R.repair(raw_reviews(spark, sf_dir))
    return labelled_texts(reviews, "Positive_Review", "Negative_Review")


def _sentiment(spark, sf_dir, ngrams):
    rows = cut_lineage(_remarks(spark, sf_dir))
    train, test = hash_split(rows, ["text", "label"], [0.8, 0.2])
    model = L.fit_texts(train, ngrams)
    scored = cut_lineage(L.score_texts(model, test))
    quality = M.class_metrics(scored, "label", "prediction", positive=0)
    return quality.withColumn("auc", M.auc(scored, "label", "p_positive").scalar())


@entries.add()
def sentiment_by_words(spark, sf_dir):
    """Quality of the text classifier on single words."""
    return _sentiment(spark, sf_dir, (1,))


@entries.add()
def sentiment_by_pairs(spark, sf_dir):
    """Quality of the text classifier on pairs of words."""
    return _sentiment(spark, sf_dir, (2,))


@entries.add()
def sentiment_by_words_and_pairs(spark, sf_dir):
    """Quality of the text classifier on words and pairs."""
    return _sentiment(spark, sf_dir, (1, 2))


@entries.add()
def streamed_alerts(spark, sf_dir):
    """Alerts on a stream of remarks next to those on the same remarks as a table."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = save_checkpoint(_remarks(spark, sf_dir), folder, "remarks")
    model = L.fit_texts(rows, (1, 2))
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/checkpoint-remarks")
    query = score_stream(model, stream, 0.9, f"{folder}/alerts", f"{folder}/progress")
    query.awaitTermination()
    streamed = spark.read.parquet(f"{folder}/alerts").groupBy("label").agg(F.count(F.lit(1)).alias("streamed"))
    batch = negative_alerts(model, rows, 0.9).groupBy("label").agg(F.count(F.lit(1)).alias("batch"))
    return streamed.join(batch, "label", "full")


@entries.add(
    f"""WITH {REPAIRED}, t AS (SELECT 1 AS label FROM repaired WHERE lower(Positive_Review) <> 'no positive'
      UNION ALL SELECT 0 FROM repaired WHERE lower(Negative_Review) <> 'no negative')
    SELECT label, count(*) AS streamed, count(*) AS with_score, 0::BIGINT AS unlike_batch FROM t GROUP BY 1"""
)
def streamed_scores(spark, sf_dir):
    """Texts a stream scored with a saved and loaded model, per label; rows unlike those scored as a table."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = save_checkpoint(_remarks(spark, sf_dir), folder, "remarks")
    L.fit_texts(rows, (1,), features=1000).write().save(f"{folder}/model")
    model = PipelineModel.load(f"{folder}/model")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/checkpoint-remarks")
    score_stream(model, stream, -1.0, f"{folder}/scores", f"{folder}/progress").awaitTermination()
    side = F.lit(1).alias("s"), F.lit(0).alias("b")
    cols = ["label", "text", "prediction", F.round("p_negative", 9).alias("p")]
    streamed = spark.read.parquet(f"{folder}/scores").select(*cols, *side)
    batch = L.score_texts(model, rows).select(*cols, F.lit(0).alias("s"), F.lit(1).alias("b"))
    same = streamed.unionByName(batch).groupBy("label", "text", "prediction", "p").agg(F.sum("s").alias("s"), F.sum("b").alias("b"))
    return same.groupBy("label").agg(
        F.sum("s").alias("streamed"), F.sum(F.when(F.col("prediction").isNotNull(), F.col("s"))).alias("with_score"),
        F.sum(F.abs(F.col("s") - F.col("b"))).alias("unlike_batch"),
    )


@entries.add()
def hotel_segments(spark, sf_dir):
    """Hotels per segment and star rating, by both clusterings."""
    hotels = _hotel_rows(spark, sf_dir)
    parts = []
    for method in ("kmeans", "bisecting"):
        rows = C.segment(hotels, R.SEGMENT_FEATURES, 4, method)
        counts = group_counts(rows, ["cluster", "star_rating"])
        parts.append(counts.select(F.lit(method).alias("method"), "cluster", "star_rating", "n"))
    return parts[0].unionByName(parts[1])


@entries.add()
def hotel_segment_means(spark, sf_dir):
    """Scaled feature means of the segments."""
    rows = C.segment(_hotel_rows(spark, sf_dir), R.SEGMENT_FEATURES, 4, "bisecting")
    return C.cluster_profile(rows, "cluster", R.SEGMENT_FEATURES, normalise=True)


@entries.add()
def segment_elbow(spark, sf_dir):
    """Within-segment distances for two to eight segments."""
    return C.elbow(_hotel_rows(spark, sf_dir), R.SEGMENT_FEATURES)


@entries.add()
def segment_silhouettes(spark, sf_dir):
    """Mean silhouette of both clusterings."""
    hotels = _hotel_rows(spark, sf_dir)
    scores = [
        (m, C.silhouette(C.segment(hotels, R.SEGMENT_FEATURES, 4, m)))
        for m in ("kmeans", "bisecting")
    ]
    return spark.createDataFrame(scores, "method string, silhouette double")


@entries.add()
def hotels_in_two_dimensions(spark, sf_dir):
    """Hotels on their first two principal components, with their segment."""
    rows = C.segment(_hotel_rows(spark, sf_dir), R.SEGMENT_FEATURES, 4)
    return project_2d(rows).select("Hotel_Name", "cluster", "pc1", "pc2")


@entries.add()
def review_segments(spark, sf_dir):
    """Size of four segments of single reviews, missing counts as 0."""
    df = _cleaned(spark, sf_dir, R.REVIEW_SEGMENT_FEATURES)
    rows = C.segment(even_rows(cut_lineage(df)), R.REVIEW_SEGMENT_FEATURES, 4, nulls="zero")
    return group_counts(rows, ["cluster"])


@entries.add(f"WITH {REPAIRED} SELECT count(*) AS n, 4::BIGINT AS clusters, count(*) FILTER (Reviewer_Score IS NULL) AS without_score FROM repaired")
def reviews_in_segments(spark, sf_dir):
    """Segmented reviews in all, and the number of segments."""
    df = R.tokenised(R.typed(R.repair(raw_reviews(spark, sf_dir))))
    used = list(dict.fromkeys([*R.REVIEW_SEGMENT_FEATURES, "Reviewer_Score"]))
    rows = C.segment(even_rows(cut_lineage(df.select(*used))), R.REVIEW_SEGMENT_FEATURES, 4, nulls="zero")
    return rows.agg(
        F.count("cluster").alias("n"), F.countDistinct("cluster").alias("clusters"),
        F.count_if(F.col("Reviewer_Score").isNull()).alias("without_score"),
    )
