"""One row per key, and counts over keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_by(order: list[str], payload: list[str]) -> Column:
    """Aggregate: the ``payload`` of the row that is last by ``order``, as a struct.

    The greatest (order, payload) struct, so equal orders are decided by the
    payload and the result does not depend on how rows meet. One struct is
    cheaper to carry than ``max_by``'s two.
    """
    return F.max(F.struct(*dict.fromkeys([*order, *payload])))


def last_per_key(df: DataFrame, keys: list[str], order: list[str],
                 payload: list[str] | None = None) -> DataFrame:
    """The row of each key that comes last by ``order``.

    An aggregation, not a window: each task first reduces its own rows to one
    per key, so a key that holds most of the rows costs no more than another.
    Works on streams.
    """
    payload = payload or [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(last_by(order, payload).alias("_last"))
    fields = {c: F.col(c) if c in keys else F.col(f"_last.`{c}`").alias(c)
              for c in [*keys, *payload]}
    return out.select(*[fields[c] for c in df.columns if c in fields])


def latest(df: DataFrame, order: list[str], defaults: dict[str, object]) -> DataFrame:
    """The last row of all, as one row; ``defaults`` apply where there is none."""
    last = df.agg(last_by(order, list(defaults)).alias("_last"))
    return last.select(*[
        F.coalesce(F.col(f"_last.{name}"), F.lit(value)).alias(name)
        for name, value in defaults.items()
    ])


def count_per_key(df: DataFrame, key: str, name: str = "count", mode: str = "rows",
                  message_key: list[str] | None = None,
                  order: list[str] | None = None) -> DataFrame:
    """Count the rows of each ``key``; rows with a null key are not counted.

    ``mode="rows"`` counts every message. ``mode="latest_per_key"`` reads the
    messages as a table keyed by ``message_key``: a later message replaces an
    earlier one, which is then no longer counted.
    """
    if mode == "latest_per_key":
        if not message_key or not order:
            raise ValueError("latest_per_key needs message_key and order")
        df = df.groupBy(*message_key).agg(last_by(order, [key]).alias("_last")) \
            .select(f"_last.{key}")
    elif mode != "rows":
        raise ValueError(f"unknown mode {mode!r}")
    return df.groupBy(key).agg(F.count(key).alias(name)).filter(F.col(key).isNotNull())


def distinct_in_order(df: DataFrame, value: str, order: str) -> DataFrame:
    """The distinct values of a column in order of first appearance by ``order``."""
    first = df.groupBy(value).agg(F.min(order).alias(order))
    return first.orderBy(order, value)
