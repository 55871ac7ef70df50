"""Column expressions: every function takes columns and returns a Column."""

from stayscope.functions.parsing import parse_date, parse_days, tag_count, tag_list
from stayscope.functions.scores import bucket, marker_colour, star_rating
from stayscope.functions.text import (
    contains_sequence,
    normalise_text,
    space_tokens,
    starts_with_tokens,
    text_or_empty,
    token_count,
    word_count,
    word_tokens,
)

__all__ = [
    "bucket",
    "contains_sequence",
    "marker_colour",
    "normalise_text",
    "parse_date",
    "parse_days",
    "space_tokens",
    "star_rating",
    "starts_with_tokens",
    "tag_count",
    "tag_list",
    "text_or_empty",
    "token_count",
    "word_count",
    "word_tokens",
]
