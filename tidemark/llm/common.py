"""What the operators share: written intermediate tables, row hashes and running totals."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path

#: White space of every contract here.
BLANKS = b"\t\n\x0b\x0c\r "


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and go on from the written table.

    Lost executors then cost a read and no recomputation, and what a later step sees can't differ
    between its tasks. The caller's shared folder owns the files.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()``, once for each Python worker: the package's own globals come with every task."""
    kept = sys.__dict__.setdefault("_tidemark_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def parts(df: DataFrame, floor: int = 64) -> int:
    """Into how many parts a group's rows are dealt: four for every shuffle partition."""
    return max(floor, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def running_total(df: DataFrame, group: list[str], order: list[str], value: Column,
                  into: str) -> DataFrame:
    """Add ``into``: the sum of ``value`` over the rows before this one in its group.

    The order within a group is by hash part of the ``order`` columns and then by the columns, so a
    group with most of the rows is summed by many tasks: one total per part, a running sum
    over the parts, and a running sum inside each part. ``df`` is read twice and should be
    a written table. Rows equal in all ``order`` columns are interchangeable.
    """
    n = parts(df)
    names = [f"_g{i}" for i in range(len(group))]
    dealt = df.withColumns({k: F.col(g) for k, g in zip(names, group)}
                           | {"_part": F.pmod(F.xxhash64(*order), F.lit(n)), "_value": value})
    totals = dealt.groupBy(*names, "_part").agg(F.sum("_value").alias("_total"))
    over = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"{k}o") for k in names], F.col("_part").alias("_parto"),
        F.coalesce(F.sum("_total").over(over), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy(*names, "_part").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = dealt.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_parto")
    for k in names:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}o"))
    return (local.join(offsets, same).withColumn(into, F.col("_offset") + F.col("_local"))
            .select(*df.columns, into))
