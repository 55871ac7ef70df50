"""What several corpus operators share: texts, row keys, and shedding rows without moving more than needed."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from stayscope.operators.joins import fits_broadcast
from stayscope.sources.packages import ship_package

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def or_empty(text: str | Column) -> Column:
    """A text, empty for NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_az(text: str | Column) -> Column:
    """A text, empty for NULL, with A-Z and no other letter in lower case."""
    return F.translate(or_empty(text), string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: str | Column) -> Column:
    """Number of runs of characters other than blank and the controls 9 to 13; 0 for NULL."""
    text = or_empty(text)
    pieces = F.size(F.split(text, f"{BLANK}+"))
    outer = [F.substring(text, at, 1).rlike(BLANK).cast("int") for at in (1, -1)]
    return F.when(text == "", 0).otherwise(pieces - outer[0] - outer[1]).cast("long")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Ready a session for tasks in Python: the package is there, and whole texts come few at a time."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def first_by_hash(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """At most `rows` rows, the first by a hash of `keys`, which should tell rows apart.

    A cut of the hash that lets few more rows through comes first, so that tasks don't each send as many.
    """
    total, h = df.count(), F.xxhash64(*keys)
    share = (1.2 * rows + 1000) / max(total, 1)
    near = df if share >= 1 else df.where(h < -(2**63) + int(share * 2**64))
    return near.orderBy(h, *keys).limit(rows)


def under_safe_names(docs: DataFrame, work: Callable[[DataFrame], DataFrame], known: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """Rows that `work` keeps of `docs`, whose other columns it meets under names that clash with nothing."""
    safe = {c: c if c in known else f"carried_column_{i}" for i, c in enumerate(docs.columns)}
    found = work(docs.select(*[F.col(f"`{c}`").alias(name) for c, name in safe.items()]))
    return found.select(*[F.col(name).alias(c) for c, name in safe.items()])


def without(df: DataFrame, losers: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows of `df` whose keys (computed per row, NULL equal to NULL) are not among `losers`.

    `losers` has the columns named in `keys`, each combination once. It is broadcast only when
    counted to be small; else both sides are dealt out by their keys, which hardly repeat.
    """
    found = losers.select(*[F.col(k).alias(f"_lost_{k}") for k in keys])
    found = F.broadcast(found) if fits_broadcast(found) else found
    same = F.lit(True)
    for k, value in keys.items():
        same = same & value.eqNullSafe(F.col(f"_lost_{k}"))
    return df.join(found, same, "left_anti")


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    make: Callable[[list[str]], list[Sequence]],
    fields: list[tuple[str, pa.DataType]],
) -> DataFrame:
    """Columns `keep` of every row, and those that `make` derives from a batch of texts (NULL: empty).

    Rows stay in their partitions; kept columns pass through unchanged.
    """
    small_batches(df.sparkSession)
    named = list(dict.fromkeys([*keep, text]))
    kinds = df.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make([t or "" for t in batch.column(text).to_pylist()])
            columns = [pa.array(c, type=kind) for c, (_, kind) in zip(made, fields, strict=True)]
            names = [*keep, *[name for name, _ in fields]]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *columns], names)

    schema = T.StructType([*kinds.fields, *[T.StructField(n, from_arrow_type(k)) for n, k in fields]])
    return df.select(*named).mapInArrow(run, schema)


HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """Join groups (one row per `key`, with their number of rows in `size`) to their rows.

    Groups with more than a thousandth of all `total` rows, of which there are fewer than a thousand,
    are broadcast; the others are joined by a shuffle in which no key is large.
    """
    large = F.col(size) * HOT_SHARE > total
    hot, cold = F.broadcast(groups.where(large)), groups.where(~large)
    rest = rows.join(hot, key, "left_anti").join(cold, key, how)
    return rows.join(hot, key).unionByName(rest, allowMissingColumns=True)
