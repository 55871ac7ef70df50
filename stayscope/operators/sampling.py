"""Samples and splits that depend on keys, not on how rows are laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 2**32


def hash_position(key: str | Sequence[str], salt: str = "42") -> Column:
    """A whole number from 0 to 2^32 - 1 that depends on the key and the salt only."""
    keys = [key] if isinstance(key, str) else list(key)
    digest = F.md5(F.concat_ws("|", F.lit(salt), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Keep each row with the given chance; depends on the row order inside partitions."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(
    df: DataFrame, key: str | Sequence[str], fraction: float, salt: str = "42"
) -> DataFrame:
    """Keep the rows whose key falls into the first `fraction` of the hash range."""
    return df.where(hash_position(key, salt) < int(fraction * SPREAD))


def hash_split(
    df: DataFrame, key: str | Sequence[str], weights: Sequence[float], salt: str = "42"
) -> list[DataFrame]:
    """Cut rows into parts by key; every row falls into exactly one, on every run."""
    position, total, low, parts = hash_position(key, salt), sum(weights), 0, []
    for i in range(len(weights)):
        high = SPREAD if i == len(weights) - 1 else int(sum(weights[: i + 1]) / total * SPREAD)
        parts.append(df.where((position >= low) & (position < high)))
        low = high
    return parts
