"""Message payloads: bytes, JSON, base64 and nested fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def text_of(value: Column) -> Column:
    return value.cast("string")


def parse_json(text: Column, schema: StructType | str) -> Column:
    """JSON text to a struct; text that does not parse gives a struct of nulls."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    return F.from_json(text, ddl)


def emit_json(*fields: Column | str) -> Column:
    """The given columns as one JSON object; nulls are left out."""
    return F.to_json(F.struct(*(fields or ("*",))))


def base64_text(encoded: Column) -> Column:
    """Base64 to text; text that is not base64 gives null and does not stop the query."""
    return F.try_to_binary(encoded, F.lit("base64")).cast("string")


def first_of(items: Column, field: str) -> Column:
    """A field of the first array element; null when there is none."""
    return F.get(items, F.lit(0)).getField(field)


def leading_part(text: Column, separator: str = "-") -> Column:
    """The text before the first separator, such as the year of ``2001-01-03``."""
    return F.substring_index(text, separator, 1)
