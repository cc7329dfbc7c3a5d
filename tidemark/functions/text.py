"""Text clean-up, typed casts and small category mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_SPACE = " \t\n\x0b\f\r"

# Display colour of each line, and of any other.
LINE_COLOURS = {"blue": "#1E90FF", "red": "#DC143C", "green": "#32CD32"}
OTHER_COLOUR = "0xFFFFFF"

# Lines in the order in which they are displayed.
LINES = ("blue", "green", "red")


def none_if_blank(text: Column) -> Column:
    """Null for empty and white-space-only text; other text is unchanged."""
    # Trimming the left end suffices, and stops at the first other character.
    return F.when(F.ltrim(text, F.lit(WHITE_SPACE)) != "", text)


def typed(value: Column, source: str, target: str, width: int | None = None,
          epoch_millis: bool = False) -> Column:
    """Cast a staged field to its declared type; what cannot be read becomes null.

    ``source`` and ``target`` are Spark type names. Text is cut to ``width``
    characters. Whole numbers may be written with a fraction of zeros (``"83.0"``); any other
    fraction can't be read as one.
    """
    if source == "string":
        value = none_if_blank(value)
    if target == "string":
        value = value.cast("string")
        return F.left(value, F.lit(width)) if width else value
    if target == "timestamp" and epoch_millis and source != "timestamp":
        return F.timestamp_millis(typed(value, source, "bigint"))
    if source == "string" and target in ("int", "bigint"):
        exact = value.try_cast("decimal(38,18)")
        return F.coalesce(value.try_cast(target), F.when(exact == F.floor(exact), exact.try_cast(target)))
    return value.try_cast(target)


def line_of_flags(red: Column, blue: Column, green: Column) -> Column:
    """The first line whose flag is set, in the order red, blue, green."""
    return (
        F.when(red, "red").when(blue, "blue").when(green, "green").otherwise("N/A")
    )


def category_colour(line: Column) -> Column:
    colour = F.lit(OTHER_COLOUR)
    for name, code in LINE_COLOURS.items():
        colour = F.when(line == name, code).otherwise(colour)
    return colour


def slug(name: Column) -> Column:
    """Lower-case topic name: ``/`` is spelled out, blanks and ``-`` become ``_``."""
    plain = F.replace(F.replace(F.lower(name), F.lit("/"), F.lit("_and_")), F.lit("'"), F.lit(""))
    return F.translate(plain, " -", "__")


def spaced(status: Column) -> Column:
    return F.translate(status, "_", " ")
