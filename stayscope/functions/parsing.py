"""Typed values out of text columns; dirty input gives NULL unless asked otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS = r"^\s*(\d+)\s+day\S*\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str = "M/d/yyyy") -> Column:
    """Date from text in `fmt`, NULL where it does not parse."""
    return F.try_to_date(_col(c), fmt)


def parse_days(c: Column | str, strict: bool = False) -> Column:
    """Whole number out of ``"<n> day(s)"``; with `strict`, other text fails the query."""
    c = _col(c)
    days = F.regexp_extract(c, DAYS, 1).try_cast("int")
    if not strict:
        return days
    problem = F.raise_error(F.concat(F.lit("not a number of days: "), c))
    return F.when(c.isNull() | days.isNotNull(), days).otherwise(problem.cast("int"))


def tag_list(c: Column | str) -> Column:
    """Entries of a printed list such as ``"[' a ', \"b\", c]"``, without quotes, trimmed.

    A text of at most two characters has none; NULL for NULL.
    """
    c = _col(c)
    inside = F.translate(F.regexp_replace(c, r"^\[|\]$", ""), "'\"", "")
    entries = F.transform(F.split(inside, ", "), lambda tag: F.trim(tag))
    return F.when(F.length(c) <= 2, F.array().cast("array<string>")).otherwise(entries)


def tag_count(c: Column | str) -> Column:
    """Number of entries of a printed list; NULL for NULL."""
    tags = tag_list(c)
    return F.when(tags.isNotNull(), F.size(tags))
