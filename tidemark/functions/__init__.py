"""Column functions. Each takes and returns ``Column`` and stays inside code generation."""

from .keys import dense_key, hash_key, sparse_key
from .numbers import expected_count
from .payload import base64_text, emit_json, first_of, leading_part, parse_json, text_of
from .text import category_colour, line_of_flags, none_if_blank, slug, spaced, typed
from .times import calendar_parts, millis_to_second, millis_to_timestamp, to_second, weekday

__all__ = [
    "base64_text", "calendar_parts", "category_colour", "dense_key", "emit_json",
    "expected_count", "first_of", "hash_key", "leading_part", "line_of_flags",
    "millis_to_second", "millis_to_timestamp", "none_if_blank", "parse_json", "slug",
    "spaced", "sparse_key", "text_of", "to_second", "typed", "weekday",
]
