"""Missing, disguised and repeated values; typed columns; remarks that say nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import (
    _FAKES,
    RAW,
    REPAIRED,
    TOKENISED,
    TYPED,
    Entries,
    raw_reviews,
    sql_says_no,
    sql_short_not_at_all,
    sql_short_nothing,
    table,
)
from stayscope.functions import parse_days, tag_list
from stayscope.operators import quality as Q
from stayscope.operators import tokens as K
from stayscope.plans import reviews as R

entries = Entries()

_TEXTS = ["Reviewer_Nationality", "Negative_Review", "Positive_Review", "Tags", "lat", "lng"]


def _long(cols, value, name, source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {value.replace('@', c)} AS {name} FROM {source}" for c in cols
    )


@entries.add(
    f"""WITH {RAW}, blanked AS (SELECT {', '.join(f"nullif(CASE WHEN trim({c}) = '' THEN '' ELSE {c} END, '') AS {c}" for c in _TEXTS)} FROM raw)
    """ + _long(_TEXTS, "count(*) FILTER (@ IS NULL)", "nulls", "blanked")
)
def nulls_after_blanks(spark, sf_dir):
    """NULLs per column once blank text is NULL."""
    df = raw_reviews(spark, sf_dir).select(*_TEXTS)
    return Q.null_counts(Q.blank_to_null(df))


@entries.add(
    f"WITH {RAW} SELECT * FROM ("
    + _long(_TEXTS, f"count(*) FILTER (@ IN {_FAKES})", "not_null_nulls", "raw")
    + ") WHERE not_null_nulls > 0"
)
def disguised_nulls(spark, sf_dir):
    """Columns that hold texts standing for a missing value."""
    return Q.disguised_null_counts(raw_reviews(spark, sf_dir).select(*_TEXTS))


@entries.add(
    f"""WITH {REPAIRED} SELECT Hotel_Name, Reviewer_Nationality, Negative_Review, Positive_Review, Tags,
    Reviewer_Score, Review_Date, days_since_review FROM repaired"""
)
def repaired_reviews(spark, sf_dir):
    """Blanks, disguised NULLs, placeholders and repeated rows repaired."""
    return R.repair(raw_reviews(spark, sf_dir)).select(
        "Hotel_Name", "Reviewer_Nationality", "Negative_Review", "Positive_Review", "Tags",
        "Reviewer_Score", "Review_Date", "days_since_review",
    )


@entries.add(
    """SELECT count(DISTINCT text) AS kept, count(*) AS total,
       round(count(DISTINCT text) / count(*), 6) AS ratio FROM documents"""
)
def repeated_documents(spark, sf_dir):
    """Distinct texts among all documents."""
    report = Q.dedupe_report(table(spark, sf_dir, "documents").select("text"))
    return report.withColumn("ratio", F.round("ratio", 6))


@entries.add(
    """SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text"""
)
def documents_once(spark, sf_dir):
    """One document per distinct text."""
    return Q.dedupe(table(spark, sf_dir, "documents").select("text", "doc_id"), ["text"])


@entries.add(
    f"WITH {REPAIRED} SELECT DISTINCT Hotel_Address, lng, lat FROM repaired "
    "WHERE NOT regexp_matches(lng, '[0-9]') OR NOT regexp_matches(lat, '[0-9]')"
)
def places_without_digits(spark, sf_dir):
    """Distinct addresses whose coordinates hold no digit."""
    df = R.repair(raw_reviews(spark, sf_dir))
    return Q.non_matching(df, ["lng", "lat"], "[0-9]", ["Hotel_Address", "lng", "lat"])


@entries.add(
    f"WITH {TYPED} SELECT Hotel_Name, Hotel_Address, round(CAST(lat AS DOUBLE), 4) AS lat, "
    "round(CAST(lng AS DOUBLE), 4) AS lng, strftime(Review_Date, '%Y-%m-%d') AS day, "
    "days_since_review, Tags, Num_Tags, Reviewer_Score FROM typed"
)
def typed_reviews(spark, sf_dir):
    """Coordinates, dates, days and tag counts out of text."""
    df = R.typed(R.repair(raw_reviews(spark, sf_dir)))
    return df.select(
        "Hotel_Name", "Hotel_Address",
        F.round(F.col("lat").cast("double"), 4).alias("lat"),
        F.round(F.col("lng").cast("double"), 4).alias("lng"),
        F.col("Review_Date").cast("string").alias("day"),
        "days_since_review", "Tags", "Num_Tags", "Reviewer_Score",
    )


@entries.add(
    f"WITH {TYPED} SELECT DISTINCT Hotel_Address FROM typed WHERE length(Hotel_Address) < 10 "
    "OR lat IS NULL OR lng IS NULL"
)
def doubtful_places(spark, sf_dir):
    """Distinct addresses that are short or have no coordinates after typing."""
    df = R.typed(R.repair(raw_reviews(spark, sf_dir)))
    missing = Q.lacks_match(["lng", "lat"], "[0-9]", missing=True)
    return df.where(missing | Q.is_short("Hotel_Address", 10)).select("Hotel_Address").distinct()


@entries.add(
    f"""WITH {RAW} SELECT tag, count(*) AS n, CAST(sum(days) AS BIGINT) AS days FROM (
      SELECT unnest(list_transform(string_split(replace(regexp_replace(Tags, '^\\[|\\]$', '', 'g'), '''', ''), ', '),
        lambda t: trim(t))) AS tag,
      CAST(nullif(regexp_extract(days_since_review, '^(\\d+) day', 1), '') AS INTEGER) AS days
      FROM raw WHERE length(Tags) > 2) GROUP BY tag"""
)
def tag_totals(spark, sf_dir):
    """Reviews and days per tag; ages that are not in days count as missing."""
    df = raw_reviews(spark, sf_dir)
    tags = df.select(F.explode(tag_list("Tags")).alias("tag"), parse_days("days_since_review").alias("days"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("days").alias("days"))


_RULES = {
    "not_at_all": sql_short_not_at_all("nt"),
    "nothing": sql_short_nothing("nt"),
    "no_negative": sql_says_no("nt", "negative"),
    "nothing_positive": sql_short_nothing("pt"),
}


@entries.add(
    f"WITH {TOKENISED} "
    + " UNION ALL ".join(
        f"SELECT '{k}' AS rule, count(*) FILTER ({v}) AS before, CAST(0 AS BIGINT) AS after FROM cut"
        for k, v in _RULES.items()
    )
)
def empty_remark_audit(spark, sf_dir):
    """Remarks that say nothing, before and after they are emptied."""
    df = R.typed(R.repair(raw_reviews(spark, sf_dir)))
    neg, pos = "Negative_Tokens_Array", "Positive_Tokens_Array"
    before = K.tokenize(df, "Negative_Review", neg)
    before = K.tokenize(before, "Positive_Review", pos)
    rules = {
        "not_at_all": K.short_not_at_all(neg),
        "nothing": K.short_nothing(neg),
        "no_negative": K.says_no(neg, "negative"),
        "nothing_positive": K.short_nothing(pos),
    }
    return Q.rule_audit(before, R.tokenised(df), rules)


@entries.add(
    f"""WITH {TOKENISED} SELECT Hotel_Name, Positive_Review, array_to_string(pt, ' ') AS tokens FROM cut
    WHERE {sql_says_no('pt', 'positive')}"""
)
def no_positive_examples(spark, sf_dir):
    """Reviews whose positive side says "no positive", for inspection."""
    df = K.tokenize(R.typed(R.repair(raw_reviews(spark, sf_dir))), "Positive_Review", "t")
    shown = Q.rows_matching(df, K.says_no("t", "positive"), ["Hotel_Name", "Positive_Review", "t"])
    return shown.select("Hotel_Name", "Positive_Review", F.array_join("t", " ").alias("tokens"))


@entries.add(
    f"""WITH {TOKENISED} SELECT Hotel_Name, Negative_Review, Positive_Review,
    array_to_string(nt, ' ') AS negative, array_to_string(pt, ' ') AS positive,
    Negative_Lemma_Count, Positive_Lemma_Count FROM tokenised"""
)
def tokenised_reviews(spark, sf_dir):
    """Reviews with empty remarks emptied and stop words removed."""
    df = R.tokenised(R.typed(R.repair(raw_reviews(spark, sf_dir))))
    return df.select(
        "Hotel_Name", "Negative_Review", "Positive_Review",
        F.array_join("Negative_Filtered_Tokens", " ").alias("negative"),
        F.array_join("Positive_Filtered_Tokens", " ").alias("positive"),
        "Negative_Lemma_Count", "Positive_Lemma_Count",
    )


@entries.add(
    f"WITH {TOKENISED} "
    + _long(["Negative_Lemma_Count", "Positive_Lemma_Count"], "count(*) FILTER (@ IS NULL)", "nulls", "tokenised")
)
def missing_counts(spark, sf_dir):
    """Reviews without any token left, per side."""
    df = R.tokenised(R.typed(R.repair(raw_reviews(spark, sf_dir))))
    return Q.null_counts(df, ["Negative_Lemma_Count", "Positive_Lemma_Count"])
