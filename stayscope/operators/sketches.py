"""Quantiles from stored sketches: a new day adds its own, and no earlier row is read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.operators.ordering import as_number

SIZE = 2000


def rank_error(size: int) -> float:
    """How far a quantile's rank may be off, as a share of all rows, 99 times in 100, after any merges."""
    return 2.296 / size**0.9723


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """Per part and column: the part, column, n and a sketch of a few times `size` numbers, in one pass.

    NULL, NaN and what is no number are left out, so `n` may be 0. A part may be NULL.
    """
    clean = [F.nullif(as_number(df, c), F.lit(float("nan"))) for c in cols]
    facts = [
        F.struct(F.lit(c).alias("column"), F.count(v).alias("n"), F.kll_sketch_agg_double(v, F.lit(size)).alias("sketch"))
        for c, v in zip(cols, clean, strict=True)
    ]
    wide = df.groupBy(*by).agg(*[f.alias(f"_facts{i}") for i, f in enumerate(facts)])
    return wide.select(*by, F.inline(F.array(*[F.col(f"_facts{i}") for i in range(len(cols))])))


def add_sketches(sketches: DataFrame, root: str, batch: str) -> None:
    """Store a batch's sketches under its name; storing it again replaces them, so a retry counts once."""
    sketches.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{root}/{batch}")


def stored_sketches(spark: SparkSession, root: str) -> DataFrame:
    """The sketches of all batches, each with the name of its batch."""
    return spark.read.option("recursiveFileLookup", "true").parquet(root)


def merged_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Per group and column: n and, for each prob, an element of the data whose rank is that far on.

    Rows: the group, column, prob, n, value. Sketches merge in the tasks before the shuffle; each is of
    bounded size, whatever it stands for. Columns without numbers have n = 0 and NULL values.
    """
    merged = sketches.where("n > 0").groupBy(*by, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    asked = F.array(*[F.lit(float(p)) for p in probs])
    values = F.kll_sketch_get_quantile_double("sketch", asked)
    full = merged.select(*by, "column", "n", F.inline(F.arrays_zip(asked.alias("prob"), values.alias("value"))))
    empty = sketches.groupBy(*by, "column").agg(F.sum("n").alias("n")).where("n = 0")
    nothing = empty.select(*by, "column", "n", F.explode(asked).alias("prob"), F.lit(None).cast("double").alias("value"))
    return full.unionByName(nothing)
