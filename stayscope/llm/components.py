"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.sources.checkpoints import cut_lineage


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected(links: DataFrame, rounds: int = 100) -> DataFrame:
    """node and label (smallest node of its component), for every node that has a link.

    `links` has u and v (long). Every round hangs neighbours on their smallest one, seen from both
    ends; groups are only ever reduced to a minimum, so a star of any size is fine. It ends when a
    round changes nothing; a chain takes a number of rounds that grows with its length's logarithm.
    """
    edges = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, before = cut_lineage(edges.distinct()), None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where(F.col("v") > F.col("u")).join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = cut_lineage(small.where(F.col("u") != F.col("v")).distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components need more rounds")
    tops = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        tops.join(edges.select(F.col("u").alias("node")), "node", "left_anti").select("node", F.col("node").alias("label"))
    )
