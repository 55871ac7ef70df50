"""From a raw review table to cleaned reviews, hotel features, stars and segments.

Column names are those of the review table the analyses are made for; every step takes and
returns a DataFrame and can be used on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.functions import (
    parse_date,
    parse_days,
    star_rating,
    tag_count,
    text_or_empty,
    token_count,
    word_count,
    word_tokens,
)
from stayscope.operators.encode import index_categories
from stayscope.operators.features import entity_features
from stayscope.operators.geo import suffix_lookup
from stayscope.operators.lemma import lemmatize
from stayscope.operators.quality import DISGUISED_NULLS, blank_to_null, map_columns, neutralise, nullify, to_float
from stayscope.operators.tokens import (
    remove_stop_words,
    says_no,
    short_not_at_all,
    short_nothing,
)

# The columns of a raw review table and of a country lookup.
RAW_SCHEMA = """
    Hotel_Address string, Additional_Number_of_Scoring int, Review_Date string,
    Average_Score double, Hotel_Name string, Reviewer_Nationality string,
    Negative_Review string, Review_Total_Negative_Word_Counts int,
    Total_Number_of_Reviews int, Positive_Review string,
    Review_Total_Positive_Word_Counts int,
    Total_Number_of_Reviews_Reviewer_Has_Given int, Reviewer_Score double, Tags string,
    days_since_review string, lat string, lng string
"""
COUNTRY_SCHEMA = "ISO string, lat double, lng double, name string"

# The numeric columns that are profiled, the ones averaged per hotel, and the
# features of each model.
NUMERIC = [
    "Additional_Number_of_Scoring",
    "Average_Score",
    "Review_Total_Negative_Word_Counts",
    "Review_Total_Positive_Word_Counts",
    "Reviewer_Score",
    "Total_Number_of_Reviews",
    "Num_Tags",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
]
AVERAGED = [
    "Additional_Number_of_Scoring",
    "Average_Score",
    "Total_Number_of_Reviews",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
    "days_since_review",
    "Num_Tags",
    "Positive_Lemma_Count",
    "Negative_Lemma_Count",
]
REGRESSION_FEATURES = [f"avg_{c}" for c in AVERAGED if c != "Average_Score"] + ["Country_Encoded"]
STAR_FEATURES = [f"avg_{c}" for c in AVERAGED if c != "Average_Score"] + ["review_count"]
SEGMENT_FEATURES = [
    "avg_Average_Score",
    "avg_Positive_Lemma_Count",
    "avg_Negative_Lemma_Count",
    "avg_Num_Tags",
    "avg_Total_Number_of_Reviews",
    "avg_days_since_review",
]
REVIEW_SEGMENT_FEATURES = [
    "Reviewer_Score",
    "Positive_Lemma_Count",
    "Negative_Lemma_Count",
    "Num_Tags",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
    "days_since_review",
]
WORD_COUNTS = ["avg_Positive_Lemma_Count", "avg_Negative_Lemma_Count"]
HOTEL_COLUMNS = ["Hotel_Name", "Hotel_Address", "Average_Score", "Total_Number_of_Reviews", "lng", "lat"]


def repaired(raw: DataFrame) -> DataFrame:
    """Blanks, disguised NULLs and placeholders to NULL."""
    placeholders = {"Negative_Review": ["No Negative"], "Positive_Review": ["No Positive"]}
    texts = {c: found for c, found in placeholders.items() if c in raw.columns}
    df = nullify(blank_to_null(raw), list(texts), DISGUISED_NULLS)
    for c, found in texts.items():
        df = nullify(df, [c], found, trim=False)
    return df


def repair(raw: DataFrame) -> DataFrame:
    """Blanks, disguised NULLs and placeholders to NULL, then one row per distinct row.

    A caller whose result depends on some columns only, however often their values occur, selects
    them first: what is moved for the distinct is then as wide as those columns. One that needs some
    columns of the distinct whole rows takes `repair_to`.
    """
    return repaired(raw).distinct()


def repair_to(raw: DataFrame, step: Callable[[DataFrame], DataFrame], cols: Sequence[str]) -> DataFrame:
    """`cols` of `step` after `repair`, for a `step` that makes each row from one row and keeps its other columns.

    The step comes first, and whole rows are told apart by the SHA-256 of all their columns: that and
    `cols` are moved for the distinct instead of the texts.
    """
    df = repaired(raw)
    zeros = [F.col(c) + F.lit(0.0) if kind == "double" else F.col(c) for c, kind in df.dtypes]  # -0.0 is 0.0
    whole = F.to_json(F.struct(*[v.alias(c) for c, v in zip(df.columns, zeros, strict=True)]))
    marked = df.withColumn("_whole", F.unhex(F.sha2(whole, 256)))
    return step(marked).select("_whole", *cols).distinct().drop("_whole")


def typed(df: DataFrame) -> DataFrame:
    """Coordinates, dates, days and the number of tags out of text."""
    return to_float(df, ["lat", "lng"]).withColumns(
        {
            "Review_Date": parse_date("Review_Date"),
            "days_since_review": parse_days("days_since_review"),
            "Num_Tags": tag_count("Tags"),
        }
    )


def enriched(df: DataFrame, countries: DataFrame, order_col: str) -> DataFrame:
    """Country by the end of the address, and indices of country, nationality and hotel."""
    df = suffix_lookup(df, "Hotel_Address", countries, "name", "ISO", order_col)
    indexed = ("Country", "Reviewer_Nationality", "Hotel_Name")
    return index_categories(df, {col: f"{col}_Encoded" for col in indexed})


def tokenised(df: DataFrame) -> DataFrame:
    """Word counts, tokens, and the remarks that say nothing emptied before stop words go.

    Both sides share each projection, which keeps the plan short. The rules for negative remarks
    are met by the tokens as they come, so one of them hitting is enough. Lemmas replace tokens
    one for one, so the lemma counts are known without the lemmas.
    """
    sides = ("Negative", "Positive")
    safe = {f"{s}_Review_safe": text_or_empty(f"{s}_Review") for s in sides}
    df = df.withColumns({f"{s}_Word_Count": word_count(f"{s}_Review") for s in sides} | safe)
    df = df.withColumns({f"{s}_Tokens_Array": word_tokens(f"{s}_Review_safe") for s in sides})
    empty = {
        "Negative": short_not_at_all("Negative_Tokens_Array")
        | short_nothing("Negative_Tokens_Array")
        | says_no("Negative_Tokens_Array", "negative"),
        "Positive": short_nothing("Positive_Tokens_Array"),
    }
    for s in sides:
        df = df.withColumn(f"{s}_Tokens_Count", token_count(f"{s}_Tokens_Array"))
        df = neutralise(df, empty[s], f"{s}_Review", f"{s}_Tokens_Array", f"{s}_Tokens_Count")
    for s in sides:
        df = remove_stop_words(df, f"{s}_Tokens_Array", f"{s}_Filtered_Tokens")
    kept = {s: token_count(f"{s}_Filtered_Tokens") for s in sides}
    return df.withColumns(
        {f"{s}_Tokens_Count": F.when(F.col(f"{s}_Review").isNotNull(), kept[s]) for s in sides}
        | {f"{s}_Lemma_Count": kept[s] for s in sides}
    )


def lemmatised(df: DataFrame, id_col: str, lexicon: DataFrame | None = None) -> DataFrame:
    """Noun lemmas of both remarks; `id_col` identifies rows."""
    for side in ("Negative", "Positive"):
        df = lemmatize(df, id_col, f"{side}_Filtered_Tokens", f"{side}_Lemmatized", lexicon)
    return df


def hotels_of(df: DataFrame, extra: tuple[str, ...] = ("Country", "Country_Encoded")) -> DataFrame:
    """The distinct hotels; a name may stand for several."""
    return df.select(*HOTEL_COLUMNS, *extra).distinct()


def hotel_features(df: DataFrame, hotels: DataFrame | None = None, min_rows: int = 30) -> DataFrame:
    """Eight means and the number of reviews of hotels with more than `min_rows` reviews."""
    return entity_features(df, "Hotel_Name", AVERAGED, min_rows, hotels)


def without_words_zero(features: DataFrame) -> DataFrame:
    """Features in which a hotel has 0 words on a side on which none of its remarks says anything.

    A remark that says nothing has no count, so such a hotel has no mean. Any other missing value stays.
    """
    return map_columns(features, WORD_COUNTS, lambda c: F.coalesce(c, F.lit(0.0)))


def with_stars(features: DataFrame) -> DataFrame:
    """Stars 1 to 5 by mean score, and the same counted from 0."""
    stars = features.withColumn("star_rating", star_rating("avg_Average_Score"))
    return stars.withColumn("star_rating_adj", F.col("star_rating") - 1)
