"""Bucketing of scores."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest score of each star rating and of each map marker colour.
STAR_FLOORS = [(9, 5), (8, 4), (6, 3), (5, 2)]
MARKER_FLOORS = [(8.0, "green"), (6.0, "orange")]


def bucket(c: Column | str, floors: list[tuple[float, Any]], default: Any) -> Column:
    """Value of the first floor that `c` reaches, else `default`; NULL takes the default."""
    c = F.col(c) if isinstance(c, str) else c
    picked = F
    for floor, value in floors:
        picked = picked.when(c >= floor, F.lit(value))
    return picked.otherwise(F.lit(default))


def star_rating(c: Column | str) -> Column:
    """Stars 1 to 5 for a score out of ten."""
    return bucket(c, STAR_FLOORS, 1)


def marker_colour(c: Column | str) -> Column:
    """Colour of a map marker for a score out of ten."""
    return bucket(c, MARKER_FLOORS, "red")
