"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = Query(lambda spark, sf_dir: run(tune(spark), sf_dir), sql)
        return run
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
