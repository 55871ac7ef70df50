"""Projections, conditions, sorts, counts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import RAW, REPAIRED, TYPED, Entries, raw_reviews, table
from stayscope.functions import bucket, star_rating
from stayscope.operators.counting import condition_counts, group_counts, n_groups
from stayscope.operators.ordering import select_groups_within, top_k, top_k_per
from stayscope.operators.quality import invalid_counts
from stayscope.plans import reviews as R

entries = Entries()


@entries.add(
    """SELECT l_orderkey, l_linenumber, l_partkey AS part,
         round(l_extendedprice * (1 - l_discount), 4) AS net,
         CASE WHEN l_discount > 0.05 THEN 'cut' ELSE 'full' END AS price_kind,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
         CAST(l_quantity AS INTEGER) - 1 AS items_after_first,
         CAST(NULL AS VARCHAR) AS remark FROM lineitem"""
)
def projected_lines(spark, sf_dir):
    """Columns renamed, computed, cast and filled with typed literals."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey AS part",
        "round(l_extendedprice * (1 - l_discount), 4) AS net", "l_discount", "l_returnflag", "l_quantity",
    ).select(
        "l_orderkey", "l_linenumber", "part", "net",
        F.when(F.col("l_discount") > 0.05, "cut").otherwise("full").alias("price_kind"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        (F.col("l_quantity").cast("int") - 1).alias("items_after_first"),
        F.lit(None).cast("string").alias("remark"),
    )


@entries.add(
    f"""WITH {REPAIRED} SELECT Hotel_Name, Reviewer_Nationality, Negative_Review, Reviewer_Score FROM repaired
    WHERE Negative_Review <> 'no negative' AND Reviewer_Nationality IS NOT NULL
      AND regexp_matches(Hotel_Address, '[0-9]') AND NOT (trim(Reviewer_Nationality) IN ('FRANCE', 'N/A'))
      AND (Reviewer_Score >= 3 OR Num > 9 OR lower(Hotel_Name) LIKE '%hotel%')"""
    .replace("Num > 9", "Review_Total_Negative_Word_Counts > 9")
)
def filtered_reviews(spark, sf_dir):
    """Reviews by set membership, pattern, NULL tests and a condition given as text."""
    df = R.repair(raw_reviews(spark, sf_dir))
    keep = (
        (F.col("Negative_Review") != "no negative")
        & F.col("Reviewer_Nationality").isNotNull()
        & F.col("Hotel_Address").rlike("[0-9]")
        & ~F.trim("Reviewer_Nationality").isin("FRANCE", "N/A")
    )
    df = df.where(keep).where(
        "Reviewer_Score >= 3 or Review_Total_Negative_Word_Counts > 9 or lower(Hotel_Name) like '%hotel%'"
    )
    return df.select("Hotel_Name", "Reviewer_Nationality", "Negative_Review", "Reviewer_Score")


@entries.add(
    """WITH v AS (SELECT CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS quantity,
         CASE WHEN l_partkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_partkey % 13 = 0 THEN NULL
           ELSE l_tax END AS tax, l_linenumber AS line FROM lineitem)
       SELECT 'quantity' AS "column", count(*) FILTER (quantity IS NULL) AS nulls,
         count(*) FILTER (isnan(quantity)) AS nans FROM v
       UNION ALL SELECT 'tax', count(*) FILTER (tax IS NULL), count(*) FILTER (isnan(tax)) FROM v
       UNION ALL SELECT 'line', count(*) FILTER (line IS NULL), 0 FROM v"""
)
def invalid_values(spark, sf_dir):
    """NULL and NaN values per column."""
    key = F.col("l_partkey")
    tax = F.when(key % 11 == 0, F.lit(float("nan"))).when(key % 13 != 0, F.col("l_tax"))
    df = table(spark, sf_dir, "lineitem").select(
        F.when(key % 7 != 0, F.col("l_quantity")).alias("quantity"), tax.alias("tax"),
        F.col("l_linenumber").alias("line"),
    )
    return invalid_counts(df, ["quantity", "tax", "line"])


@entries.add(
    """SELECT l_orderkey, l_linenumber, unnest([
         {'kind': 'tax', 'amount': l_tax}, {'kind': 'discount', 'amount': l_discount}], recursive := true)
       FROM lineitem"""
)
def exploded_rates(spark, sf_dir):
    """An array of structs per line, exploded and read by field."""
    pair = F.array(
        F.struct(F.lit("tax").alias("kind"), F.col("l_tax").alias("amount")),
        F.struct(F.lit("discount").alias("kind"), F.col("l_discount").alias("amount")),
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.explode(pair).alias("r"))
    return rows.selectExpr("l_orderkey", "l_linenumber", "r.kind AS kind", "r.amount AS amount")


@entries.add(
    """SELECT c_custkey, CASE WHEN s >= 9 THEN 5 WHEN s >= 8 THEN 4 WHEN s >= 6 THEN 3 WHEN s >= 5 THEN 2
         ELSE 1 END AS stars, CASE WHEN s >= 7 THEN 'high' WHEN s >= 4 THEN 'medium' ELSE 'low' END AS level
       FROM (SELECT c_custkey, (c_acctbal + 1000) / 1100 AS s FROM customer)"""
)
def score_buckets(spark, sf_dir):
    """Scores as stars and as levels of satisfaction."""
    score = (F.col("c_acctbal") + 1000) / 1100
    df = table(spark, sf_dir, "customer").select("c_custkey", score.alias("s"))
    level = bucket("s", [(7, "high"), (4, "medium")], "low")
    return df.select("c_custkey", star_rating("s").alias("stars"), level.alias("level"))


@entries.add(
    f"""WITH {TYPED} SELECT 'no_coordinates' AS condition, count(*) FILTER (lat IS NULL OR lng IS NULL) AS n FROM typed
    UNION ALL SELECT 'no_address', count(*) FILTER (Hotel_Address IS NULL) FROM typed
    UNION ALL SELECT 'short_address', count(*) FILTER (length(Hotel_Address) < 10) FROM typed
    UNION ALL SELECT 'no_days', count(*) FILTER (days_since_review IS NULL) FROM typed"""
)
def filtered_counts(spark, sf_dir):
    """Several filtered counts in one pass."""
    df = R.typed(R.repair(raw_reviews(spark, sf_dir)))
    return condition_counts(
        df,
        {
            "no_coordinates": F.col("lat").isNull() | F.col("lng").isNull(),
            "no_address": F.col("Hotel_Address").isNull(),
            "short_address": F.length("Hotel_Address") < 10,
            "no_days": F.col("days_since_review").isNull(),
        },
    )


@entries.add(
    f"""WITH {REPAIRED} SELECT Reviewer_Nationality, count(*) AS n FROM repaired
    GROUP BY ALL ORDER BY n DESC, Reviewer_Nationality"""
)
def nationality_counts(spark, sf_dir):
    """Reviews per nationality by falling number; a missing one counts as a group."""
    df = group_counts(R.repair(raw_reviews(spark, sf_dir)), ["Reviewer_Nationality"])
    return df.orderBy(F.desc("n"), F.asc_nulls_last("Reviewer_Nationality"))


@entries.add(
    f"""WITH {REPAIRED} SELECT count(*) AS n_groups FROM (SELECT DISTINCT Reviewer_Nationality FROM repaired)"""
)
def nationality_groups(spark, sf_dir):
    """Number of nationalities, a missing one included."""
    return n_groups(R.repair(raw_reviews(spark, sf_dir)), ["Reviewer_Nationality"])


@entries.add(
    """SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10"""
)
def busiest_parts(spark, sf_dir):
    """The ten groups with most rows."""
    return top_k(group_counts(table(spark, sf_dir, "lineitem"), ["l_partkey"]), "n", 10, ["l_partkey"])


@entries.add(
    """SELECT l_suppkey, l_partkey, n, CAST(rank AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rank
         FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)) WHERE rank <= 3"""
)
def busiest_parts_per_supplier(spark, sf_dir):
    """The three parts with most lines of every supplier."""
    counts = group_counts(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"])
    return top_k_per(counts, "l_suppkey", "n", 3, ["l_partkey"])


@entries.add(
    """WITH g AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1),
       t AS (SELECT l_partkey, sum(n) OVER (ORDER BY n DESC, l_partkey ROWS UNBOUNDED PRECEDING) AS total FROM g)
       SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_partkey IN (SELECT l_partkey FROM t WHERE total <= 20000)"""
)
def parts_within_budget(spark, sf_dir):
    """Lines of the largest parts that together stay within a number of rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return select_groups_within(lines, "l_partkey", 20_000)


@entries.add(
    f"""WITH {RAW} SELECT strftime(date_trunc('month', try_strptime(Review_Date, '%m/%d/%Y')), '%Y-%m') AS month,
    count(*) AS n, round(avg(Reviewer_Score), 6) AS mean_score FROM raw GROUP BY 1"""
)
def reviews_per_month(spark, sf_dir):
    """Number and mean score of reviews by month."""
    month = F.date_format(F.date_trunc("month", F.try_to_date("Review_Date", "M/d/yyyy")), "yyyy-MM")
    df = raw_reviews(spark, sf_dir).groupBy(month.alias("month"))
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("Reviewer_Score"), 6).alias("mean_score"))
