"""Normalise raw records to a declared table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import typed
from ..schemas import Table


def _kind(df: DataFrame, path: str) -> str:
    return df.select(F.col(path)).schema[0].dataType.simpleString()


def normalise(df: DataFrame, table: Table) -> DataFrame:
    """Project ``df`` to the fields of ``table``.

    Blank and empty text becomes null, text is cut to its declared width, and
    other fields are cast to their declared types; unreadable ones become null.
    """
    columns = []
    for f in table.fields:
        path = f.source or f.name
        columns.append(
            typed(F.col(path), _kind(df, path), f.dtype, f.width, f.epoch_millis).alias(f.name)
        )
    return df.select(*columns)


def rejected(df: DataFrame, table: Table) -> DataFrame:
    """Per field, how many non-blank raw values could not be read as the declared type."""
    checks = []
    for f in table.fields:
        path = f.source or f.name
        kind = _kind(df, path)
        raw = typed(F.col(path), kind, "string")
        cast = typed(F.col(path), kind, f.dtype, f.width, f.epoch_millis)
        checks.append(F.count_if(raw.isNotNull() & cast.isNull()).alias(f.name))
    counts = df.agg(*checks)
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("field"), F.col(f.name).alias("rejected"))
        for f in table.fields
    ])).alias("r")).select("r.*")
