"""Text and token-array expressions, all evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    """Trimmed text, with NULL as the empty string."""
    return F.coalesce(F.trim(_col(c)), F.lit(""))


def word_count(c: Column | str) -> Column:
    """Blank-separated words; 0 for NULL, 1 for the empty string."""
    gaps = F.regexp_count(F.trim(_col(c)), F.lit(r"\s+"))
    return F.coalesce(gaps + 1, F.lit(0))


def normalise_text(c: Column | str) -> Column:
    """Lower case, commas to blanks, everything but ASCII letters, digits and blanks removed."""
    spaced = F.translate(F.lower(_col(c)), ",", " ")
    return F.regexp_replace(spaced, r"[^a-zA-Z0-9\s]", "")


def word_tokens(c: Column | str) -> Column:
    """Lower-cased runs of word characters."""
    return F.array_remove(F.split(F.lower(_col(c)), r"\W+"), "")


def space_tokens(c: Column | str) -> Column:
    """Lower-cased text cut at each single blank; empty tokens at the end are dropped."""
    c = _col(c)
    kept = F.regexp_replace(F.lower(c), r"\s+$", "")
    tokens = F.split(kept, r"\s")
    only_blanks = (F.length(kept) == 0) & (F.length(c) > 0)
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(tokens)


def token_count(c: Column | str) -> Column:
    """Size of an array, NULL rather than 0 when it is empty or missing."""
    return F.nullif(F.size(_col(c)), F.lit(0))


def contains_sequence(c: Column | str, words: Sequence[str]) -> Column:
    """Whether `words` stand next to each other in a token array; false for NULL.

    The array is joined once and searched as text, which is linear in its length. Tokens must
    be free of blanks, as those of `word_tokens` are.
    """
    padded = F.concat(F.lit(" "), F.array_join(_col(c), " "), F.lit(" "))
    return F.coalesce(F.contains(padded, F.lit(f" {' '.join(words)} ")), F.lit(False))


def starts_with_tokens(c: Column | str, words: Sequence[str], sizes: Sequence[int]) -> Column:
    """Whether an array starts with `words` and has one of `sizes` tokens; false for NULL."""
    c = _col(c)
    leading = [F.get(c, F.lit(i)) == word for i, word in enumerate(words)]
    hit = F.size(c).isin(*sizes)
    for match in leading:
        hit = hit & match
    return F.coalesce(hit, F.lit(False))
