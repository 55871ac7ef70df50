"""Exact numbers of rows per class or stratum, chosen by hash, and weights that balance classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayscope.operators.joins import attach
from stayscope.operators.ordering import row_numbers
from stayscope.sources.checkpoints import cut_lineage

CELL_BITS = 12
HASH_BITS = 60


def row_hash(key: Sequence[str], salt: str = "42") -> Column:
    """A whole number of 60 bits that depends on the key (NULL skipped) and the salt only."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), *[F.col(k).cast("string") for k in key]))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def stratum_sizes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per stratum: `by`, n. NULL is a stratum of its own."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def proportional_quotas(sizes: DataFrame, by: Sequence[str], total: int) -> DataFrame:
    """Shares of `total` (all rows, if fewer) by size, in whole rows: `by`, n, quota.

    Each stratum gets the whole part of its share; what is left goes to the largest remainders, of
    equal ones to the first in the order of `by` (NULL first). Strata are ordered over the whole cluster.
    """
    sizes = cut_lineage(sizes.select(*by, "n"))
    rows = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    if not rows:
        return sizes.withColumn("quota", F.lit(0).cast("long"))
    total = min(total, rows)
    share = F.col("n").cast("decimal(38,0)") * F.lit(total)
    parts = sizes.withColumns({"quota": F.floor(share / rows).cast("long"), "_rest": (share % rows).cast("long")})
    parts = cut_lineage(parts)
    left = total - parts.agg(F.sum("quota").alias("q")).first()["q"]
    ranked = row_numbers(parts, [F.desc("_rest"), *[F.asc_nulls_first(c) for c in by]], "_rank")
    return ranked.select(*by, "n", (F.col("quota") + F.when(F.col("_rank") <= left, 1).otherwise(0)).alias("quota"))


def resample(df: DataFrame, by: Sequence[str], key: Sequence[str], quotas: DataFrame, salt: str = "42") -> DataFrame:
    """Exactly `quota` rows of every stratum, with all columns and `copy` (from 1): the first by hash of the `key`.

    `quotas` has `by` and quota; strata that it lacks go, empty ones can't be filled. A quota beyond the
    stratum's size takes whole copies of it and the first rows once more. A stratum is never sorted:
    counts per cell of the hash show in which cell its quota ends, and only the rows of that cell
    are numbered, over the whole cluster, so a class with any share of the rows stays split. Rows with
    equal keys are told apart by number alone.
    """
    names = dict(zip(by, (f"_by_{i}" for i in range(len(by))), strict=True))
    stratum = F.to_json(F.struct(*[F.col(c).alias(names[c]) for c in by]))
    near = F.shiftright("_hash", HASH_BITS - CELL_BITS)
    rows = df.select(F.struct(*df.columns).alias("_row"), stratum.alias("_stratum"), row_hash(key, salt).alias("_hash"))
    cells = rows.groupBy("_stratum", near.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    cells = cut_lineage(cells)
    sizes = cells.groupBy("_stratum").agg(F.sum("_n").alias("_size"))
    wanted = quotas.select(stratum.alias("_stratum"), F.col("quota").cast("long").alias("_quota")).join(sizes, "_stratum")
    wanted = wanted.withColumn("_copies", F.expr("_quota div _size")).withColumn("_rest", F.col("_quota") % F.col("_size"))
    before = Window.partitionBy("_stratum").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(wanted, "_stratum")
    ends = placed.where((F.col("_start") <= F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_n")))
    ends = cut_lineage(ends.select("_stratum", "_copies", F.col("_cell").alias("_end"), (F.col("_rest") - F.col("_start")).alias("_left")))
    rows = attach(rows, ends, "_stratum", "inner").withColumn("_cell", near)
    plain = rows.where("_cell <> _end").withColumn("_more", (F.col("_cell") < F.col("_end")).cast("int"))
    edge = cut_lineage(rows.where("_cell = _end").withColumn("_id", F.monotonically_increasing_id()))
    edge = cut_lineage(row_numbers(edge, ["_stratum", "_hash", "_id"], "_place"))
    first = edge.groupBy("_stratum").agg(F.min("_place").alias("_first"))
    edge = attach(edge, first, "_stratum", "inner")
    edge = edge.withColumn("_more", (F.col("_place") - F.col("_first") < F.col("_left")).cast("int"))
    chosen = plain.select("_row", "_copies", "_more").unionByName(edge.select("_row", "_copies", "_more"))
    times = F.sequence(F.lit(1), (F.col("_copies") + F.col("_more")).cast("int"))
    chosen = chosen.where("_copies + _more > 0").select("_row", F.explode(times).alias("_copy"))
    return chosen.select(*[F.col("_row")[c].alias(c) for c in df.columns], F.col("_copy").alias("copy"))


def equal_classes(df: DataFrame, by: Sequence[str], key: Sequence[str], n: int, salt: str = "42") -> DataFrame:
    """Exactly `n` rows of every class; small classes are repeated."""
    return resample(df, by, key, df.select(*by).distinct().withColumn("quota", F.lit(n)), salt)


def proportional_sample(df: DataFrame, by: Sequence[str], key: Sequence[str], total: int, salt: str = "42") -> DataFrame:
    """`total` rows in all, shared out to the strata by their size; see `proportional_quotas`."""
    return resample(df, by, key, proportional_quotas(stratum_sizes(df, by), by, total), salt).drop("copy")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: label, n, weight, such that all classes weigh the same and all rows as much as without weights."""
    sizes = cut_lineage(df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    whole = sizes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return sizes.withColumn("weight", F.lit(float(whole["n"] or 0)) / (F.col("n") * F.lit(max(whole["k"], 1))))


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add each row's class weight, for the `weightCol` of an estimator; NULL for a NULL label."""
    return attach(df, class_weights(df, label).select(label, F.col("weight").alias(out)), label)
