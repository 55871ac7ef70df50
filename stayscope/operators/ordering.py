"""Whole-table order without a single-task sort: running totals, row numbers, quantiles, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stayscope.operators.joins import has_at_most
from stayscope.sources.checkpoints import cut_lineage

SLOT = "_slot"
PUSHED_RANK = 1000
ONE_TASK_ROWS = 100_000


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    totals: Mapping[str, Column | str],
    one_task_rows: int = ONE_TASK_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Add, per name in `totals`, the sum of its expression over all rows up to this one.

    `order` should identify rows. A table counted to be small is summed in one task. A larger
    one is range-partitioned by `order`; each partition sums its own rows and adds what the
    partitions before it hold, so the only window without a key runs over one row per partition.
    Input and placement are written, as a second run of the shuffle could cut the ranges
    elsewhere; an input that is `stored` already is not written again.
    """
    steps = {name: F.col(c) if isinstance(c, str) else c for name, c in totals.items()}
    base = df.withColumns(steps)
    base = base if stored else cut_lineage(base)
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    if has_at_most(base, one_task_rows):
        whole = Window.orderBy(*order).rowsBetween(*up_to_here)
        return base.withColumns({name: F.sum(name).over(whole) for name in totals})
    placed = cut_lineage(base.repartitionByRange(*order).withColumn(SLOT, F.spark_partition_id()))
    before = Window.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(SLOT)
        .agg(*[F.sum(name).alias(name) for name in totals])
        .select(
            SLOT,
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_to_{n}") for n in totals],
        )
    )
    within = Window.partitionBy(SLOT).orderBy(*order).rowsBetween(*up_to_here)
    return (
        placed.join(F.broadcast(offsets), SLOT)
        .withColumns({n: F.sum(n).over(within) + F.col(f"_to_{n}") for n in totals})
        .drop(SLOT, *[f"_to_{n}" for n in totals])
    )


def row_numbers(
    df: DataFrame,
    order: Sequence[Column | str],
    out: str = "row",
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Number all rows from 1 in `order`, over as many tasks as the sort has partitions."""
    return running_totals(df, order, {out: F.lit(1).cast("long")}, one_task_rows)


def as_number(df: DataFrame, c: str) -> Column:
    """A column as double; NULL for text that is no number, most of which is told by its start."""
    if not isinstance(df.schema[c].dataType, T.StringType):
        return F.col(c).cast("double")
    return F.when(F.col(c).rlike(r"^\s*[+-]?[\d.iInN]"), F.col(c).try_cast("double"))


def tally(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value: `by`, column, value (double), n. NULLs are left out."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), as_number(df, c).alias("value"))
            for c in cols
        ]
    )
    return (
        df.select(*by, F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles_of(
    tallied: DataFrame,
    probs: Sequence[float],
    by: Sequence[str] = (),
    one_task_rows: int = ONE_TASK_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Exact quantiles of a `tally`: `by`, column, n, and q0, q1, … in the order of `probs`.

    Values are ordered over the whole cluster, so a group may hold any share of the rows.
    """
    keys = [*by, "column"]
    placed = running_totals(tallied, [*keys, "value"], {"upto": "n"}, one_task_rows, stored)
    placed = cut_lineage(placed)
    sizes = placed.groupBy(*keys).agg(
        F.max("upto").alias("_last"), F.sum("n").alias("_size")
    )
    sizes = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_last", "_size")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    first = F.col("upto") - F.col("n") - F.col("_last") + F.col("_size")
    ranked = placed.join(sizes, same).withColumns(
        {"_from": first, "_to": first + F.col("n")}
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("value")))

    found = []
    for i, p in enumerate(probs):
        spot = F.lit(float(p)) * (F.col("_size") - 1)
        found += [at(F.floor(spot)).alias(f"_lo{i}"), at(F.ceil(spot)).alias(f"_hi{i}")]
    wanted = F.lit(False)
    for p in probs:
        spot = F.lit(float(p)) * (F.col("_size") - 1)
        wanted = wanted | ((F.col("_from") <= F.ceil(spot)) & (F.floor(spot) < F.col("_to")))
    result = ranked.where(wanted).groupBy(*keys).agg(F.first("_size").alias("_size"), *found)
    values = []
    for i, p in enumerate(probs):
        spot = F.lit(float(p)) * (F.col("_size") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        values.append((lo + (hi - lo) * (spot - F.floor(spot))).alias(f"q{i}"))
    return result.select(*keys, F.col("_size").alias("n"), *values)


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles, interpolated between neighbouring ranks: `by`, column, n, q0, q1, …"""
    return quantiles_of(tally(df, cols, by), probs, by)


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The `k` rows with the largest `by`; equal values are ordered by the `tie` columns."""
    return df.orderBy(F.desc(by), *tie).limit(k)


def top_k_per(
    df: DataFrame, key: str, by: str, k: int, tie: Sequence[str], out: str = "rank"
) -> DataFrame:
    """The `k` rows with the largest `by` of every key.

    Up to a thousand, Spark keeps `k` rows per key and task ahead of the shuffle, so a key with
    very many rows stays small. Above that, a first round ranks inside shares of each key: a
    row beaten by `k` rows of its share cannot be among the `k` of its key.
    """
    order = [F.desc(by), *[F.col(c) for c in tie]]
    if k > PUSHED_RANK:
        share = F.pmod(F.xxhash64(*df.columns), F.lit(64))
        inner = Window.partitionBy(key, "_share").orderBy(*order)
        df = df.withColumn("_share", share).withColumn(out, F.row_number().over(inner))
        df = df.where(F.col(out) <= k).drop("_share", out)
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col(out) <= k)


def select_groups_within(
    df: DataFrame, key: str, budget: int, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Rows of the largest groups whose sizes add up to at most `budget`.

    Groups are taken by falling size, then key, up to the first that does not fit. Every group
    has a row, so no more than `budget` groups can be taken: a modest budget orders only that
    many, a larger one goes by distributed running totals.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.desc("_n"), F.asc_nulls_first(key)]
    if budget <= one_task_rows:
        upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = sizes.orderBy(*order).limit(budget).withColumn("_total", F.sum("_n").over(upto))
    else:
        ranked = running_totals(sizes, order, {"_total": "_n"}, one_task_rows)
    taken = ranked.where((F.col("_total") <= budget) & F.col(key).isNotNull()).select(key)
    return df.join(taken, key, "left_semi")
