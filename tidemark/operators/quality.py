"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Table


class QualityError(ValueError):
    """A check did not give the expected value."""


def run_checks(spark: SparkSession, queries: list[str], expected: list[object]) -> DataFrame:
    """Run each query and compare its first cell; stop at the first mismatch."""
    if len(queries) != len(expected):
        raise ValueError(f"{len(queries)} queries but {len(expected)} expected results")
    passed = []
    for query, want in zip(queries, expected):
        row = spark.sql(query).first()
        got = row[0] if row else None
        if got != want:
            raise QualityError(f"expected {want!r} but got {got!r}: {query}")
        passed.append((query, str(want), str(got)))
    return spark.createDataFrame(passed, "query string, expected string, actual string")


def _tall(counts: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias(label), F.col(f"`{n}`").alias(value)) for n in names
    ])).alias("r")).select("r.*")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column, all in one pass."""
    names = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in names])
    return _tall(counts, names, "column", "nulls")


def outside_domain(df: DataFrame, domains: dict[str, tuple[str, ...]]) -> DataFrame:
    """Per column, the values that are not in its domain; null is not a violation."""
    counts = df.agg(*[
        F.count_if(~F.col(f"`{n}`").isin(*values)).alias(n) for n, values in domains.items()
    ])
    return _tall(counts, list(domains), "column", "violations")


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of a foreign key that the parent lacks, with their number of rows.

    The child is reduced to its distinct values before it meets the parent, so
    a value's share of the rows does not matter to the join.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_key).alias("value"))
    return values.join(known, "value", "left_anti")


def rules_of(table: Table) -> dict[str, Column]:
    """Declared NOT NULL and domain rules of a table, each as what breaks it."""
    rules = {f"not_null:{f.name}": F.col(f"`{f.name}`").isNull() for f in table.fields if f.required}
    return rules | {f"domain:{f.name}": ~F.col(f"`{f.name}`").isin(*f.allowed)
                    for f in table.fields if f.allowed}


def check_table(df: DataFrame, table: Table) -> DataFrame:
    """Declared NOT NULL and domain rules of a table: rule and violations."""
    rules = rules_of(table)
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, violations bigint")
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return _tall(counts, list(rules), "rule", "violations")


def check_star(tables: dict[str, DataFrame], specs: dict[str, Table]) -> DataFrame:
    """All declared rules of a set of tables: table, rule and violations."""
    parts = []
    for name, spec in specs.items():
        parts.append(check_table(tables[name], spec).withColumn("table", F.lit(name)))
        if spec.key:
            parts.append(
                repeated_keys(tables[name], list(spec.key))
                .agg(F.count(F.lit(1)).alias("violations"))
                .withColumn("rule", F.lit("unique:" + ",".join(spec.key)))
                .withColumn("table", F.lit(name))
            )
        for column, target in spec.references.items():
            parent, key = target.split(".")
            parts.append(
                orphans(tables[name], column, tables[parent], key)
                .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
                .withColumn("rule", F.lit(f"references:{column}"))
                .withColumn("table", F.lit(name))
            )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("table", "rule", "violations")
