"""Exact deduplication of an incoming batch against an immutable snapshot.

A snapshot keeps its digests in exact buckets and, per shard of digests, a static binary-fuse
filter. Digests of a batch are screened by the filters; only positives meet the exact buckets.
Digests that repeat within the batch or the snapshot are found by grouping, apart from that. The
texts behind repeated digests are then compared byte by byte, by grouping on the text itself.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stayscope.llm import fuse
from stayscope.llm.common import join_groups, lower_az, small_batches, table, under_safe_names
from stayscope.sources.checkpoints import cut_lineage

SHARD_KEYS = 200_000


@F.pandas_udf(T.StringType())
def text_sha256(texts: pd.Series) -> pd.Series:
    """SHA-256 in hex of each text in UTF-8, A-Z lower-cased; NULL counts as empty."""
    return pd.Series([hashlib.sha256((t or "").encode().lower()).hexdigest() for t in texts], dtype=str)


def digest_of(sha: Column, bits: int = 64) -> Column:
    """The screening digest: `bits` of a hash of the SHA-256."""
    return F.shiftrightunsigned(F.xxhash64(sha), 64 - bits) if bits < 64 else F.xxhash64(sha)


def shards_for(*tables: DataFrame, keys: int = SHARD_KEYS) -> int:
    """Number of shards at which the largest of the tables has about `keys` rows in each."""
    return 1 + max(t.count() for t in tables) // keys


def _shard(n: int) -> Column:
    return F.pmod(F.hash("digest"), F.lit(n)).alias("shard")


def snapshot_filters(buckets: DataFrame, shards: int) -> DataFrame:
    """One filter per shard of the snapshot's distinct digests: shard, filter."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "filter": [fuse.build(group["digest"].to_numpy())]})

    return buckets.select(_shard(shards), "digest").groupBy("shard").applyInPandas(build, "shard int, filter binary")


def screen(batch: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Distinct digests of a batch that its shard's filter lets through."""

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"digest": pd.Series([], dtype="int64")})
        return left.loc[fuse.ask(right["filter"].iloc[0], left["digest"].to_numpy()), ["digest"]]

    dealt = batch.select(_shard(shards), "digest").groupBy("shard")
    return dealt.cogroup(filters.groupBy("shard")).applyInPandas(probe, "digest long")


def repeated_digests(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """Digests with more than one row over both: each table has digest and n, digests distinct."""
    shards = shards_for(snapshot, batch)
    positives = screen(batch, snapshot_filters(snapshot, shards), shards)
    across = positives.join(snapshot.select("digest"), "digest", "left_semi")
    inside = [t.where(F.col("n") > 1).select("digest") for t in (snapshot, batch)]
    return across.unionByName(inside[0]).unionByName(inside[1]).distinct()


def equal_texts(docs: DataFrame, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Rows and classes of equal texts, both stored.

    Rows: doc_id, sha, n (identical rows). Classes: sha, keep_id (largest doc_id), group_size; only
    of texts that more than one row has. Half of the rows, by a hash, stand for the snapshot
    and the other half for the batch; the result doesn't depend on it.
    """
    small_batches(docs.sparkSession)
    named = docs.select("doc_id", text_sha256("text").alias("sha"))
    rows = named.groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(rows.withColumn("digest", digest_of(F.col("sha"), bits)))
    incoming = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    snapshot, batch = (
        cut_lineage(rows.where(side).groupBy("digest").agg(F.sum("n").alias("n"))) for side in (~incoming, incoming)
    )
    repeated = cut_lineage(repeated_digests(snapshot, batch))
    members = rows.join(repeated, "digest", "left_semi").select(F.col("doc_id").alias("_id")).distinct()
    texts = docs.select("doc_id", "text").join(members, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    checked = texts.groupBy(lower_az("text").alias("text")).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    checked = checked.where(F.col("group_size") > 1).select(F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
    alone = F.assert_true(F.count(F.lit(1)) == 1, F.lit("two texts have the same SHA-256"))
    classes = checked.groupBy("sha").agg(
        F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), alone.alias("_alone")
    )
    return rows, cut_lineage(classes.where(F.col("_alone").isNull()).drop("_alone"))


def exact_copies(docs: DataFrame, bits: int = 64) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with the largest doc_id (NULL is the smallest) one is kept, even if they are
    identical. NULL texts are empty ones. No task gets all rows of a large class.
    """
    rows, classes = equal_texts(docs, bits)
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    found = join_groups(rows, classes, "sha", "group_size", total, "left")
    each = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("_copy"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return each.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("_copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows that share a doc_id are told apart by their text; all others go or stay by doc_id. Other
    columns may have any name; an empty table gives an empty one.
    """
    return under_safe_names(docs, _without_copies)


def _without_copies(docs: DataFrame) -> DataFrame:
    rows, classes = equal_texts(docs)
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    joined = join_groups(rows, classes, "sha", "group_size", total)
    lost = joined.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "sha")
    lost = cut_lineage(lost)
    shared = rows.groupBy("doc_id").agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("doc_id")
    shared = cut_lineage(shared)
    key = F.col("doc_id").eqNullSafe(F.col("_id"))
    renamed = shared.withColumnRenamed("doc_id", "_id")
    plain = lost.join(renamed, key, "left_anti").select(F.col("doc_id").alias("_lost"))
    stay = docs.join(plain, F.col("doc_id").eqNullSafe(F.col("_lost")), "left_anti")
    if shared.isEmpty():
        return stay
    stay = stay.join(renamed, key, "left_anti")
    told = docs.join(renamed, key, "left_semi").select(F.struct(*docs.columns).alias("_row"), "doc_id", text_sha256("text").alias("_sha"))
    gone = lost.select(F.col("doc_id").alias("_id"), F.col("sha").alias("_gone"))
    told = told.join(gone, key & (F.col("_sha") == F.col("_gone")), "left_anti")
    first = Window.partitionBy("doc_id", "_sha").orderBy(F.to_json("_row"))
    told = told.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1)
    return stay.unionByName(told.select("_row.*"))


def op2_exact_dedup(spark, sf_dir) -> DataFrame:
    """All documents with the copy of their text that stays."""
    return exact_copies(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
