"""Demand arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def expected_count(daily: Column, ratio: Column, steps_per_hour: int = 1) -> Column:
    """Whole entries in one step of an hour that holds ``ratio`` of a day's total.

    The daily total is first rounded half to even; the result is never negative.
    """
    per_step = F.bround(daily, 0) * ratio / F.lit(float(steps_per_hour))
    return F.greatest(F.floor(per_step), F.lit(0)).cast("bigint")
