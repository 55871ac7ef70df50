"""Finding and repairing missing, disguised and repeated values."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayscope.operators.counting import rows_of

# Texts that stand for a missing value.
DISGUISED_NULLS = ["NA", "N/A", "na", "n/a", "null", "None", " N A", " n a", " N a"]


def _strings(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    names = df.columns if cols is None else cols
    return [c for c in names if isinstance(df.schema[c].dataType, (T.StringType, T.VarcharType))]


def map_columns(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Replace each column by `fn` of it, in one projection."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL for text that is empty or all spaces; other columns pass unchanged."""
    return map_columns(df, _strings(df, cols), lambda c: F.when(F.trim(c) != "", c))


def nullify(
    df: DataFrame, cols: Sequence[str], tokens: Sequence[str], trim: bool = True
) -> DataFrame:
    """NULL where a column equals one of `tokens`, after trimming it if asked."""

    def repaired(c: Column) -> Column:
        c = F.trim(c) if trim else c
        return F.when(c.isin(*tokens), F.lit(None)).otherwise(c)

    return map_columns(df, cols, repaired)


def to_float(df: DataFrame, cols: Sequence[str], na_tokens: Sequence[str] = ("NA",)) -> DataFrame:
    """Text columns as float, NULL for `na_tokens` and for anything else that is no number."""
    return map_columns(
        df, cols, lambda c: F.when(~c.isin(*na_tokens), c).try_cast("float")
    )


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, counted in one pass: (column, nulls)."""
    cols = df.columns if cols is None else list(cols)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)])
    return counted.select(rows_of({c: F.col(f"_c{i}") for i, c in enumerate(cols)}, "column", "nulls"))


def invalid_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs and NaNs per column, counted in one pass: (column, nulls, nans)."""

    def nan(c: str) -> Column:
        real = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
        return F.count_if(F.isnan(c)) if real else F.lit(0).cast("long")

    counted = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"), nan(c).alias("nans")).alias(f"_c{i}")
            for i, c in enumerate(cols)
        ]
    )
    return counted.select(F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(cols))])))


def disguised_null_counts(
    df: DataFrame, tokens: Sequence[str] = tuple(DISGUISED_NULLS), cols: Sequence[str] | None = None
) -> DataFrame:
    """Disguised NULLs per column that has any: (column, not_null_nulls)."""
    cols = df.columns if cols is None else list(cols)
    texts = {c: F.col(c).cast("string") for c in cols}
    counted = df.agg(
        *[F.count_if(t.isin(*tokens)).alias(f"_c{i}") for i, t in enumerate(texts.values())]
    )
    long = counted.select(
        rows_of({c: F.col(f"_c{i}") for i, c in enumerate(cols)}, "column", "not_null_nulls")
    )
    return long.where("not_null_nulls > 0")


def is_short(col: str, min_len: int) -> Column:
    """Whether a text is shorter than `min_len` characters; false for NULL."""
    return F.coalesce(F.length(col) < min_len, F.lit(False))


def short_values(df: DataFrame, col: str, min_len: int) -> DataFrame:
    """Rows whose text is shorter than `min_len` characters."""
    return df.where(is_short(col, min_len))


def lacks_match(cols: Sequence[str], pattern: str, missing: bool = False) -> Column:
    """Whether one of the columns lacks `pattern`, or with `missing` is NULL."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(~F.col(c).cast("string").rlike(pattern), F.lit(missing))
    return hit


def non_matching(
    df: DataFrame, cols: Sequence[str], pattern: str, show: Sequence[str], missing: bool = False
) -> DataFrame:
    """Distinct `show` columns of rows in which a column lacks `pattern`, or with `missing` is NULL."""
    return df.where(lacks_match(cols, pattern, missing)).select(*show).distinct()


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row, or per distinct `cols` (the smallest row of each).

    Copies collapse before the shuffle, so a row repeated very often does not weigh on a task.
    """
    if cols is None:
        return df.distinct()
    rest = [c for c in df.columns if c not in cols]
    if not rest:
        return df.select(*cols).distinct()
    kept = df.groupBy(*cols).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*cols, "_row.*").select(*df.columns)


def dedupe_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: distinct rows, all rows and their ratio, from one shuffle of distinct rows."""
    groups = df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.count(F.lit(1)).alias("kept"), F.coalesce(F.sum("_n"), F.lit(0)).alias("total")
    ).withColumn("ratio", F.try_divide(F.col("kept").cast("double"), F.col("total").cast("double")))


def rows_matching(df: DataFrame, condition: Column, cols: Sequence[str]) -> DataFrame:
    """`cols` of the rows that meet a condition, for inspection."""
    return df.where(condition).select(*cols)


def neutralise(df: DataFrame, rule: Column, text: str, tokens: str, count: str) -> DataFrame:
    """Where `rule` holds: text to NULL, tokens to an empty array, count to 0.

    The rule is evaluated once, on the row as it was.
    """
    hit = F.col("_hit")
    return (
        df.withColumn("_hit", F.coalesce(rule, F.lit(False)))
        .withColumns(
            {
                text: F.when(~hit, F.col(text)),
                tokens: F.when(hit, F.array().cast("array<string>")).otherwise(F.col(tokens)),
                count: F.when(hit, F.lit(0)).otherwise(F.col(count)),
            }
        )
        .drop("_hit")
    )


def rule_audit(before: DataFrame, after: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Hits of every rule before and after a repair, one pass over each: (rule, before, after)."""

    def hits(df: DataFrame, out: str) -> DataFrame:
        counted = df.agg(*[F.count_if(c).alias(f"_c{i}") for i, c in enumerate(rules.values())])
        return counted.select(rows_of({k: F.col(f"_c{i}") for i, k in enumerate(rules)}, "rule", out))

    return hits(before, "before").join(hits(after, "after"), "rule")
