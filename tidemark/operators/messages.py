"""Fields of parsed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import parse_json


def fields_of(df: DataFrame, structs: list[Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns and the fields of the given structs, one row per row.

    The structs pass through a generator. Without it a later filter on a field
    would be pushed below the projection together with a copy of the expression
    behind it, and every message would be parsed once more per filter.
    """
    names = [f"_s{i}" for i in range(len(structs))]
    one = F.array(F.struct(*[s.alias(n) for s, n in zip(structs, names)]))
    return df.select(*keep, F.inline(one)).select(*keep, *[f"{n}.*" for n in names])


def json_fields(df: DataFrame, text: Column, schema: StructType | str,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of JSON text; malformed text gives a row of nulls."""
    return fields_of(df, [parse_json(text, schema)], keep)
