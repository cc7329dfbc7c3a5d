"""Equi-joins that hold up when a key, or null, has a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Limits under which a side may be sent whole to every executor.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def within_bound(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table has few enough rows and bytes to be broadcast.

    Looks at no more than ``rows + 1`` rows, whatever the size of the table.
    """
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    seen = df.limit(rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")
    ).first()
    return seen["n"] <= rows and seen["b"] <= size


def lookup_join(df: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner",
                rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join to a lookup table by columns of the same name.

    The lookup is broadcast only after its size has been checked; beyond the
    bound the join is an ordinary shuffle join.
    """
    return df.join(F.broadcast(lookup) if within_bound(lookup, rows) else lookup, keys, how)


def join_on(left: DataFrame, right: DataFrame, keys: list[tuple[Column, Column]],
            how: str = "inner", spread_nulls: bool = False) -> DataFrame:
    """Equi-join on pairs of (left, right) key columns.

    Spark broadcasts the right side if its known size allows, and otherwise
    splits the partitions of hot keys at run time. ``spread_nulls`` is for left
    joins in which many left keys are null: such rows match nothing, yet would
    all be hashed to one partition, so they get an extra key part that differs
    by row. For all other rows of both sides that part is 0.
    """
    pairs = list(keys)
    if how == "left" and spread_nulls:
        any_null = reduce(Column.__or__, [l.isNull() for l, _ in pairs])
        own = F.xxhash64(*left.columns, F.spark_partition_id())
        spread = F.when(any_null, own).otherwise(F.lit(0))
        # Computed, as a literal would be folded and leave the partitioning.
        zero = F.pmod(F.xxhash64(*[r for _, r in pairs]), F.lit(1).cast("bigint"))
        left, right = left.withColumn("_spread", spread), right.withColumn("_zero", zero)
        pairs.append((F.col("_spread"), F.col("_zero")))
    on = reduce(Column.__and__, [l == r for l, r in pairs])
    return left.join(right, on, how).drop("_spread", "_zero")


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                salts: int, right_salts: int = 1) -> DataFrame:
    """Inner join with every key split over ``salts`` parts of the left side's rows and
    ``right_salts`` parts of the right side's.

    A row's salt comes from the row and the task that read it, so a repeated task gives the same
    one, and copies of a row still spread; each side is repeated once per part of the other.
    Meant for stream-stream joins, where nothing re-plans a hot key at run time. The result is
    the plain join's. A stream must keep its numbers of salts for the life of its checkpoint.
    """
    if salts * right_salts <= 1:
        return left.join(right, F.col(left_key) == F.col(right_key), "inner")

    def own(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(n))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    one = left.withColumn("_l1", own(left, salts)).withColumn("_r1", every(right_salts))
    two = right.withColumn("_r2", own(right, right_salts)).withColumn("_l2", every(salts))
    on = ((F.col(left_key) == F.col(right_key)) & (F.col("_l1") == F.col("_l2"))
          & (F.col("_r1") == F.col("_r2")))
    return one.join(two, on, "inner").drop("_l1", "_l2", "_r1", "_r2")
