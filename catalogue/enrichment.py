"""Lookups, category indices, per-hotel features, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import HOTELS, TYPED, Entries, raw_reviews, table
from stayscope.operators.cluster import cluster_profile
from stayscope.operators.encode import apply_index, index_category, index_labels
from stayscope.operators.features import attach_dimension, entity_features
from stayscope.operators.geo import map_markers, point_lookup, suffix_lookup
from stayscope.operators.sampling import bernoulli_sample, hash_sample, hash_split
from stayscope.plans import reviews as R
from stayscope.sources import cut_lineage

entries = Entries()


def typed_reviews(spark, sf_dir):
    """Repaired reviews with typed columns."""
    return R.typed(R.repair(raw_reviews(spark, sf_dir)))


def nation_lookup(spark, sf_dir):
    """Nations as a country lookup."""
    code = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    return table(spark, sf_dir, "nation").select(
        code.alias("ISO"), F.initcap("n_name").alias("name"), F.col("n_nationkey").alias("ord")
    )


_SUFFIX = """(SELECT arg_min('N' || CAST(n_nationkey AS VARCHAR), n_nationkey) FROM nation
  WHERE suffix(upper({0}), upper(n_name)))"""


@entries.add(
    f"""WITH {TYPED}, places AS (SELECT DISTINCT Hotel_Address FROM typed), coded AS (
      SELECT Hotel_Address, {_SUFFIX.format('Hotel_Address')} AS Country FROM places)
    SELECT Country, count(*) AS n_reviews, count(DISTINCT Hotel_Name) AS n_hotels
    FROM typed LEFT JOIN coded USING (Hotel_Address) GROUP BY Country"""
)
def reviews_per_country(spark, sf_dir):
    """Reviews and hotels per country, found by the end of the address."""
    lookup = nation_lookup(spark, sf_dir)
    hotels = cut_lineage(typed_reviews(spark, sf_dir).select("Hotel_Address", "Hotel_Name"))  # read twice
    df = suffix_lookup(hotels, "Hotel_Address", lookup, "name", "ISO", "ord")
    per_hotel = df.groupBy("Country", "Hotel_Name").agg(F.count(F.lit(1)).alias("n"))
    return per_hotel.groupBy("Country").agg(
        F.sum("n").alias("n_reviews"), F.count("Hotel_Name").alias("n_hotels")
    )


@entries.add(
    """WITH names AS (SELECT p_partkey AS code, split_part(p_name, ' ', 2) AS name FROM part
         UNION ALL SELECT p_partkey + 1000000000, p_name FROM part),
       ranked AS (SELECT upper(name) AS name, min(code) AS code FROM names GROUP BY 1)
       SELECT p_partkey, (SELECT arg_max(r.code, length(r.name)) FROM ranked r
         WHERE suffix(upper(concat('Best ', p_name)), r.name)) AS code FROM part"""
)
def longest_name_at_end(spark, sf_dir):
    """The longest listed name that a text ends with, from a lookup that grows with the data."""
    part = table(spark, sf_dir, "part")
    kinds = part.select(F.col("p_partkey").alias("code"), F.element_at(F.split("p_name", " "), 2).alias("name"))
    full = part.select((F.col("p_partkey") + 1_000_000_000).alias("code"), F.col("p_name").alias("name"))
    lookup = kinds.unionByName(full).groupBy("name").agg(F.min("code").alias("code"))
    texts = part.select("p_partkey", F.concat(F.lit("Best "), "p_name").alias("text"))
    found = suffix_lookup(
        texts, "text", lookup, "name", "code", "code", prefer="longest", out="code"
    )
    return found.select("p_partkey", "code")


@entries.add(
    """WITH boxes AS (SELECT s_suppkey AS code, s_suppkey % 40 AS x0, (s_suppkey * 7) % 40 AS y0 FROM supplier),
       pts AS (SELECT c_custkey, (c_custkey * 3 % 397) / 10.0::DOUBLE + 0.05::DOUBLE AS x, (c_custkey * 11 % 389) / 10.0::DOUBLE + 0.03::DOUBLE AS y
         FROM customer)
       SELECT c_custkey, min(code) AS code FROM pts LEFT JOIN boxes
         ON x > x0 AND y > y0 AND (x - x0) + (y - y0) < 3.1 GROUP BY c_custkey"""
)
def region_of_point(spark, sf_dir):
    """Smallest code of the triangles, one per supplier, that hold a customer's position."""
    x0, y0 = (F.col("s_suppkey") % 40).cast("double"), (F.col("s_suppkey") * 7 % 40).cast("double")

    def corner(dx, dy):
        return F.struct((x0 + dx).alias("x"), (y0 + dy).alias("y"))

    regions = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("code"),
        F.array(corner(0.0, 0.0), corner(3.1, 0.0), corner(0.0, 3.1)).alias("vertices"),
    )
    key = F.col("c_custkey")
    points = table(spark, sf_dir, "customer").select(
        "c_custkey",
        ((key * 3 % 397).cast("double") / 10 + 0.05).alias("x"),
        ((key * 11 % 389).cast("double") / 10 + 0.03).alias("y"),
    )
    return point_lookup(points, "x", "y", regions, "code", cell=2.0, out="code").select("c_custkey", "code")


@entries.add(
    f"""WITH {TYPED} SELECT DISTINCT Hotel_Name, round(CAST(lng AS DOUBLE), 4) AS lng,
      round(CAST(lat AS DOUBLE), 4) AS lat, Average_Score,
      CASE WHEN Average_Score >= 8 THEN 'green' WHEN Average_Score >= 6 THEN 'orange' ELSE 'red' END AS colour
    FROM typed WHERE lng IS NOT NULL AND lat IS NOT NULL"""
)
def hotel_markers(spark, sf_dir):
    """Distinct hotels with both coordinates and a colour by score."""
    df = map_markers(typed_reviews(spark, sf_dir), "lng", "lat", "Average_Score", "Hotel_Name")
    for c in ("lng", "lat"):
        df = df.withColumn(c, F.round(F.col(c).cast("double"), 4))
    return df


@entries.add(
    f"""WITH {TYPED}, c AS (SELECT Reviewer_Nationality AS v, count(*) AS n FROM typed WHERE Reviewer_Nationality IS NOT NULL GROUP BY 1),
    i AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx FROM c)
    SELECT Reviewer_Nationality, coalesce(idx, (SELECT CAST(count(*) AS DOUBLE) FROM c)) AS code, count(*) AS n
    FROM typed LEFT JOIN i ON v = Reviewer_Nationality GROUP BY 1, 2"""
)
def nationality_index(spark, sf_dir):
    """Frequency index of nationalities, a missing one last."""
    reviews = typed_reviews(spark, sf_dir).select("Reviewer_Nationality")
    df = index_category(cut_lineage(reviews), "Reviewer_Nationality", "code")
    return df.groupBy("Reviewer_Nationality", "code").agg(F.count(F.lit(1)).alias("n"))


@entries.add(
    """WITH c AS (SELECT p_brand AS v, count(*) AS n FROM part WHERE p_size <= 25 GROUP BY 1),
    i AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx FROM c)
    SELECT p_partkey, p_brand || p_type AS v2, coalesce(idx, (SELECT CAST(count(*) AS DOUBLE) FROM c)) AS code
    FROM part LEFT JOIN i ON v = CASE WHEN p_size % 9 = 0 THEN 'new' ELSE p_brand END"""
)
def unseen_category_index(spark, sf_dir):
    """Index learned on some rows and applied to all; unknown values come last."""
    part = table(spark, sf_dir, "part")
    labels = index_labels(part.where("p_size <= 25"), ["p_brand"])
    seen = part.select(
        "p_partkey", F.concat("p_brand", "p_type").alias("v2"),
        F.when(F.col("p_size") % 9 == 0, "new").otherwise(F.col("p_brand")).alias("p_brand"),
    )
    return apply_index(seen, labels, {"p_brand": "code"}).drop("p_brand")


_AVG = [f"avg_{c}" for c in R.AVERAGED]


@entries.add(
    f"WITH {HOTELS} SELECT Hotel_Name, review_count, star_rating, star_rating - 1 AS star_rating_adj, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _AVG)
    + " FROM stars"
)
def hotel_stars(spark, sf_dir):
    """Means, review count and stars of hotels with more than 30 reviews."""
    stars = R.with_stars(R.hotel_features(R.tokenised(typed_reviews(spark, sf_dir))))
    return stars.select(
        "Hotel_Name", "review_count", "star_rating", "star_rating_adj", *[F.round(c, 6).alias(c) for c in _AVG]
    )


@entries.add(f"WITH {HOTELS} SELECT star_rating, count(*) AS n FROM stars GROUP BY 1 ORDER BY 1")
def star_balance(spark, sf_dir):
    """Hotels per star rating."""
    stars = R.with_stars(R.hotel_features(R.tokenised(typed_reviews(spark, sf_dir))))
    return stars.groupBy("star_rating").agg(F.count(F.lit(1)).alias("n")).orderBy("star_rating")


@entries.add(
    f"""WITH {TYPED}, s AS (SELECT Hotel_Name, count(*) AS review_count,
      round(avg(Reviewer_Score), 6) AS mean_score FROM typed GROUP BY 1 HAVING count(*) > 30),
    d AS (SELECT DISTINCT Hotel_Name, Hotel_Address, Average_Score, Total_Number_of_Reviews FROM typed)
    SELECT Hotel_Name, review_count, mean_score, Hotel_Address, Average_Score, Total_Number_of_Reviews
    FROM s JOIN d USING (Hotel_Name)"""
)
def hotels_with_places(spark, sf_dir):
    """Per-hotel means joined to the hotel rows; a shared name multiplies."""
    df = typed_reviews(spark, sf_dir)
    stats = entity_features(df, "Hotel_Name", ["Reviewer_Score"])
    dim = df.select("Hotel_Name", "Hotel_Address", "Average_Score", "Total_Number_of_Reviews").distinct()
    joined = attach_dimension(stats, dim, "Hotel_Name")
    return joined.withColumn("mean_score", F.round("avg_Reviewer_Score", 6)).drop("avg_Reviewer_Score")


@entries.add(
    """SELECT l_partkey, review_count, round(q, 6) AS avg_l_quantity, p_brand, p_type FROM (
         SELECT l_partkey, count(*) AS review_count, avg(l_quantity) AS q FROM lineitem GROUP BY 1 HAVING count(*) > 30)
       JOIN part ON l_partkey = p_partkey"""
)
def parts_with_unique_dimension(spark, sf_dir):
    """Per-part means joined to a dimension that must hold each key once."""
    dim = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    stats = entity_features(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_quantity"])
    df = attach_dimension(stats, dim, "l_partkey", unique=True)
    return df.withColumn("avg_l_quantity", F.round("avg_l_quantity", 6))


_PROFILED = ["l_quantity", "l_discount", "l_extendedprice"]


@entries.add(
    f"""WITH m AS (SELECT l_suppkey, {', '.join(f'avg({c}) AS {c}' for c in _PROFILED)} FROM lineitem GROUP BY 1),
    s AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in _PROFILED)} FROM m)
    SELECT l_suppkey, {', '.join(f'round(({c} - lo_{c}) / nullif(hi_{c} - lo_{c}, 0), 6) AS {c}' for c in _PROFILED)}
    FROM m, s"""
)
def normalised_profile(spark, sf_dir):
    """Feature means per group, scaled to 0..1 over the groups."""
    profile = cluster_profile(table(spark, sf_dir, "lineitem"), "l_suppkey", _PROFILED, normalise=True)
    return profile.select("l_suppkey", *[F.round(c, 6).alias(c) for c in _PROFILED])


@entries.add(
    """SELECT l_returnflag, round(avg(l_quantity), 6) AS "avg(l_quantity)", round(avg(l_tax), 6) AS "avg(l_tax)"
       FROM lineitem GROUP BY 1"""
)
def means_by_flag(spark, sf_dir):
    """Means named after their column."""
    means = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg({"l_quantity": "mean", "l_tax": "mean"})
    return means.select(
        "l_returnflag", *[F.round(f"`{c}`", 6).alias(c) for c in ("avg(l_quantity)", "avg(l_tax)")]
    )


_HASH = "CAST(concat('0x', substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT)"


@entries.add(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_HASH} < CAST(floor(0.1 * 4294967296) AS BIGINT)")
def tenth_of_orders(spark, sf_dir):
    """A tenth of the orders by a hash of the key."""
    return hash_sample(table(spark, sf_dir, "orders"), "o_orderkey", 0.1).select("o_orderkey", "o_totalprice")


@entries.add(
    f"""SELECT o_orderkey, CASE WHEN {_HASH} < CAST(floor(0.8 * 4294967296) AS BIGINT) THEN 'train' ELSE 'test' END AS part
    FROM orders"""
)
def train_and_test(spark, sf_dir):
    """Orders in two parts, four to one, by a hash of the key."""
    train, test = hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", [0.8, 0.2])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@entries.add()
def seeded_sample(spark, sf_dir):
    """A hundredth of the lines drawn with a seed."""
    return bernoulli_sample(table(spark, sf_dir, "lineitem"), 0.01)
