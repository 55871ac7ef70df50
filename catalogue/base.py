"""The review table derived from the test tables, once in Spark and once in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.sources import spread_rows


class Entries:
    """Queries of one module and the SQL that must give the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable:
        """Register a function under its name, with its SQL."""

        def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Expressions that read the same in Spark SQL and DuckDB.
RAW_COLUMNS = {
    "Hotel_Address": "CASE WHEN p_partkey % 23 = 0 THEN 'Nowhere' ELSE "
    "concat(p_brand, ' Street ', CAST(p_size AS STRING), ' ', hotel_nation) END",
    "Additional_Number_of_Scoring": "p_size * 9",
    "Average_Score": "CAST((p_partkey * 7) % 61 AS DOUBLE) / CAST(10 AS DOUBLE) + 4",
    "Hotel_Name": "concat(p_name, CASE WHEN p_size % 2 = 0 THEN ' Hotel ' ELSE ' Inn ' END, "
    "CAST((p_partkey - p_partkey % 2) AS STRING))",
    "Reviewer_Nationality": "CASE WHEN c_custkey % 13 = 0 THEN '  ' WHEN c_custkey % 29 = 0 "
    "THEN 'N/A' ELSE concat(' ', guest_nation, ' ') END",
    "Negative_Review": "CASE (l_orderkey + l_partkey + l_linenumber) % 13 "
    "WHEN 0 THEN 'No Negative' WHEN 1 THEN 'Nothing' WHEN 2 THEN 'not at all' "
    "WHEN 3 THEN ' Not at all really' WHEN 4 THEN 'I have no negative comments' "
    "WHEN 5 THEN 'N/A' WHEN 6 THEN '   ' WHEN 7 THEN 'nothing, just ' || p_name || 's' "
    "WHEN 8 THEN 'no negative' WHEN 9 THEN 'None' "
    "ELSE concat('The ', lower(p_type), ' rooms near the ', p_name, ' were not clean, ', "
    "lower(o_orderpriority), ' stays!') END",
    "Review_Total_Negative_Word_Counts": "l_linenumber * 3",
    "Total_Number_of_Reviews": "CAST(p_size * 40 + p_partkey % 100 AS INT)",
    "Positive_Review": "CASE (l_orderkey + l_suppkey + l_linenumber) % 11 "
    "WHEN 0 THEN 'No Positive' WHEN 1 THEN 'nothing' WHEN 2 THEN 'Nothing really' "
    "WHEN 3 THEN 'na' WHEN 4 THEN '' WHEN 5 THEN 'no positive' "
    "WHEN 6 THEN 'not at all bad' WHEN 7 THEN 'There is no positive side' "
    "ELSE concat(' Lovely ', p_name, ' views, helpful ', lower(c_mktsegment), "
    "' staff & clean floors ') END",
    "Review_Total_Positive_Word_Counts": "p_size",
    "Total_Number_of_Reviews_Reviewer_Has_Given": "CAST(c_custkey % 23 + 1 AS INT)",
    "Reviewer_Score": "l_quantity / CAST(5 AS DOUBLE)",
    "Tags": "CASE WHEN l_linenumber = 7 THEN '[]' ELSE concat('['' ', p_type, ' trip '', '' ', "
    "c_mktsegment, ' '', '' Stayed ', CAST(l_linenumber AS STRING), ' nights '']') END",
    "days_since_review": "CASE WHEN l_orderkey % 97 = 0 THEN '3 weeks' ELSE "
    "concat(CAST(l_linenumber * 10 + p_size AS STRING), "
    "CASE WHEN l_linenumber = 1 THEN ' day' ELSE ' days' END) END",
    "lat": "CASE WHEN p_partkey % 17 = 0 THEN 'NA' ELSE concat(CAST(p_size - 20 AS STRING), '.25') END",
    "lng": "CASE WHEN p_partkey % 17 = 0 THEN 'NA' ELSE concat(CAST(p_partkey % 300 - 150 AS STRING), '.5') END",
}


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as hotel reviews: the part is the hotel, the customer the guest."""
    nation = table(spark, sf_dir, "nation")
    guest = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("guest_nation"))
    place = nation.select(F.col("n_nationkey").alias("_place"), F.col("n_name").alias("hotel_nation"))
    part = table(spark, sf_dir, "part").withColumn("_place", (F.col("p_partkey") % 25).cast("int"))
    customer = table(spark, sf_dir, "customer").join(guest, "c_nationkey")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    lines = spread_rows(table(spark, sf_dir, "lineitem")).withColumnRenamed("l_partkey", "p_partkey")
    rows = (
        lines.join(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
        .join(customer, "c_custkey")
        .join(part.join(place, "_place"), "p_partkey")
    )
    rows = rows.withColumn("l_partkey", F.col("p_partkey"))
    date = F.date_format("o_orderdate", "M/d/yyyy").alias("Review_Date")
    return rows.select(*[F.expr(e).alias(c) for c, e in RAW_COLUMNS.items()], date)


_RAW_SELECT = ",\n  ".join(f"{e} AS {c}" for c, e in RAW_COLUMNS.items())

RAW = f"""raw AS (
SELECT {_RAW_SELECT},
  strftime(o_orderdate, '%-m/%-d/%Y') AS Review_Date
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN (SELECT n_nationkey AS gk, n_name AS guest_nation FROM nation) ON c_nationkey = gk
JOIN part ON l_partkey = p_partkey
JOIN (SELECT n_nationkey AS hk, n_name AS hotel_nation FROM nation) ON p_partkey % 25 = hk
)"""

_FAKES = "('NA', 'N/A', 'na', 'n/a', 'null', 'None', ' N A', ' n a', ' N a')"


def _repaired_text(c: str, placeholder: str) -> str:
    return (
        f"CASE WHEN trim({c}) = '' OR trim({c}) IN {_FAKES} OR trim({c}) = '{placeholder}' "
        f"THEN NULL ELSE trim({c}) END AS {c}"
    )


_BLANKABLE = ["Hotel_Address", "Hotel_Name", "Reviewer_Nationality", "Tags", "days_since_review",
              "Review_Date", "lat", "lng"]
_PLAIN = ["Additional_Number_of_Scoring", "Average_Score", "Review_Total_Negative_Word_Counts",
          "Total_Number_of_Reviews", "Review_Total_Positive_Word_Counts",
          "Total_Number_of_Reviews_Reviewer_Has_Given", "Reviewer_Score"]

REPAIRED = RAW + f""", repaired AS (
SELECT DISTINCT {', '.join(_PLAIN)},
  {', '.join(f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS {c}" for c in _BLANKABLE)},
  {_repaired_text('Negative_Review', 'No Negative')},
  {_repaired_text('Positive_Review', 'No Positive')}
FROM raw)"""

TYPED = REPAIRED + r""", typed AS (
SELECT * REPLACE (
  TRY_CAST(lat AS FLOAT) AS lat, TRY_CAST(lng AS FLOAT) AS lng,
  CAST(try_strptime(Review_Date, '%m/%d/%Y') AS DATE) AS Review_Date,
  TRY_CAST(nullif(regexp_extract(days_since_review, '^\s*(\d+)\s+day\S*\s*$', 1), '') AS INTEGER)
    AS days_since_review),
  CAST(CASE WHEN length(Tags) <= 2 THEN 0 ELSE
    len(string_split(replace(regexp_replace(Tags, '^\[|\]$', '', 'g'), '''', ''), ', ')) END AS INTEGER)
    AS Num_Tags
FROM repaired)"""

STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's would
""".split()  # fixed values: Spark's English stop words

_STOP_LIST = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"


def sql_tokens(c: str) -> str:
    """SQL for the word tokens of a text."""
    return rf"list_filter(regexp_split_to_array(lower({c}), '\W+'), lambda x: x <> '')"


def sql_no_stop_words(tokens: str) -> str:
    """SQL for a token list without stop words."""
    return f"list_filter({tokens}, lambda x: NOT list_contains({_STOP_LIST}, x))"


def sql_short_not_at_all(t: str) -> str:
    """SQL for the rule of short remarks that start with "not at all"."""
    return f"(len({t}) IN (3, 4) AND {t}[1] = 'not' AND {t}[2] = 'at' AND {t}[3] = 'all')"


def sql_short_nothing(t: str) -> str:
    """SQL for the rule of short remarks with "nothing"."""
    return f"(len({t}) IN (1, 2) AND list_contains({t}, 'nothing'))"


def sql_says_no(t: str, what: str) -> str:
    """SQL for the rule of remarks with "no" followed by a word."""
    return f"contains(' ' || array_to_string({t}, ' ') || ' ', ' no {what} ')"


_NEG_EMPTY = " OR ".join([sql_short_not_at_all("nt"), sql_short_nothing("nt"), sql_says_no("nt", "negative")])
_POS_EMPTY = sql_short_nothing("pt")

TOKENISED = TYPED + f""", cut AS (
SELECT *, {sql_tokens("coalesce(Negative_Review, '')")} AS nt,
  {sql_tokens("coalesce(Positive_Review, '')")} AS pt FROM typed),
emptied AS (
SELECT * REPLACE (
  CASE WHEN {_NEG_EMPTY} THEN NULL ELSE Negative_Review END AS Negative_Review,
  CASE WHEN {_POS_EMPTY} THEN NULL ELSE Positive_Review END AS Positive_Review,
  CASE WHEN {_NEG_EMPTY} THEN [] ELSE {sql_no_stop_words('nt')} END AS nt,
  CASE WHEN {_POS_EMPTY} THEN [] ELSE {sql_no_stop_words('pt')} END AS pt)
FROM cut),
tokenised AS (
SELECT *, CAST(nullif(len(nt), 0) AS INTEGER) AS Negative_Lemma_Count,
  CAST(nullif(len(pt), 0) AS INTEGER) AS Positive_Lemma_Count FROM emptied)"""

_AVERAGED = ["Additional_Number_of_Scoring", "Average_Score", "Total_Number_of_Reviews",
             "Total_Number_of_Reviews_Reviewer_Has_Given", "days_since_review", "Num_Tags",
             "Positive_Lemma_Count", "Negative_Lemma_Count"]

HOTELS = TOKENISED + f""", hotel_stats AS (
SELECT Hotel_Name, {', '.join(f'avg({c}) AS avg_{c}' for c in _AVERAGED)}, count(*) AS review_count
FROM tokenised GROUP BY Hotel_Name HAVING count(*) > 30),
stars AS (
SELECT *, CASE WHEN avg_Average_Score >= 9 THEN 5 WHEN avg_Average_Score >= 8 THEN 4
  WHEN avg_Average_Score >= 6 THEN 3 WHEN avg_Average_Score >= 5 THEN 2 ELSE 1 END AS star_rating
FROM hotel_stats)"""
