"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

# monotonically_increasing_id() keeps the row number of a partition in its low 33 bits.
_ROW_BITS = 33


def hash_key(*fields: Column) -> Column:
    """md5 of the fields run together; null when any of them is null."""
    return F.md5(F.concat(*[f.cast("string") for f in fields]))


def sparse_key() -> Column:
    """A unique number per row with gaps; it may differ from one run to the next."""
    return F.monotonically_increasing_id()


def dense_key(df: DataFrame, order: list[str] | None, name: str, start: int = 0) -> DataFrame:
    """Number the rows ``start, start + 1, …`` without a one-task sort.

    With ``order`` the rows are first range-partitioned and sorted in parallel.
    Rows equal in it are numbered in any order, and the task they came from is
    the last part of the range key, so that many of them still spread over
    several ranges. Without ``order`` rows are numbered as they lie, which
    saves that shuffle.

    The rows are written once, so that neither sampled bounds nor row positions
    can shift if a task is repeated. A partition's first number is the running
    total of the row counts before it: a table of one row per partition, which
    is therefore always small enough to broadcast.
    """
    rows = df
    if order:
        rows = df.withColumn("_task", F.spark_partition_id()) \
            .repartitionByRange(*order, "_task").sortWithinPartitions(*order).drop("_task")
    numbered = (
        rows.withColumn("_mark", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mark", _ROW_BITS))
        .withColumn("_row", F.col("_mark") - F.shiftleft("_part", _ROW_BITS))
        .drop("_mark")
    )
    staged = stage(numbered, "dense-key")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_part").count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    key = F.col("_offset") + F.col("_row") + F.lit(start)
    return staged.join(F.broadcast(offsets), "_part").select(
        key.cast("bigint").alias(name), *df.columns
    )
