"""Attaching a table with one row per key, whatever its size and however uneven the keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 * 2**20
SALTS = 16


def has_at_most(table: DataFrame, rows: int) -> bool:
    """Whether `table` has no more than `rows` rows; looks at no more than one beyond."""
    return table.select(F.lit(1)).limit(rows + 1).count() <= rows


def fits_broadcast(
    table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> bool:
    """Whether `table` stays within a number of rows and, written as text, of bytes."""
    if not has_at_most(table, rows):
        return False
    width = F.length(F.to_json(F.struct(*table.columns)))
    return (table.agg(F.sum(width).alias("size")).first()["size"] or 0) <= size


def attach(
    df: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_broadcast: int = BROADCAST_ROWS,
    tasks: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Join `table` to `df` on equal column names.

    A table counted to be small is broadcast, so `df` does not move. A larger one is repeated
    once per salt and `df` is spread over the salts by its content: a key that holds a large
    part of the rows is then shared by several tasks, which adaptive execution can split
    further because no later step relies on the salted partitioning. The two are merged whatever
    size Spark expects: it goes by the compressed file, of which the salted rows are a large
    multiple, and would collect them on the driver. `table` should be cheap to count, as it is
    after `cut_lineage`. Narrow rows with very many matches are too much work for the few tasks
    that their bytes make: `tasks` then says over how many the two are merged. A table that is known
    to hold a key once is `unique`: Spark then drops the left join if nothing of the table is used later.
    """
    on = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(table, max_broadcast):
        return df.join(F.broadcast(table), on, how)
    salt = "_salt"
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    repeated = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    if unique:
        repeated = repeated.groupBy(*on, salt).agg(*[F.first(c).alias(c) for c in table.columns if c not in on])
    if tasks:
        salted, repeated = (side.repartition(tasks, *on, salt) for side in (salted, repeated))
    return salted.join(repeated.hint("merge"), [*on, salt], how).drop(salt)
