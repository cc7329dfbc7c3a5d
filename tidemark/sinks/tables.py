"""Batch sinks: Parquet, CSV, catalog tables and keyed tables."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import last_per_key
from ..operators.quality import rules_of
from ..schemas import Table
from ..session import stage, staging

#: Directory counts above which a partitioned write is reported.
MANY_DIRECTORIES = 50_000


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", rebalance: bool = True,
                  sort: list[str] | None = None) -> None:
    """Write Parquet, by default replacing what is there.

    With partition columns the rows are first gathered by directory through a
    rebalance: at run time Spark merges small directories into one task and
    splits a large one over several, so neither tiny files nor one task per
    hot directory result. ``sort`` orders the rows within each file of a directory.
    """
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    if sort:
        df = df.sortWithinPartitions(*partition_by, *sort)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def warn_if_many_directories(df: DataFrame, partition_by: list[str],
                             limit: int = MANY_DIRECTORIES) -> int:
    """Estimate the directories a partitioned write would make, and warn above ``limit``."""
    estimate = df.agg(F.approx_count_distinct(F.struct(*partition_by)).alias("n")).first()["n"]
    if estimate > limit:
        warnings.warn(f"about {estimate} directories for {partition_by}", stacklevel=2)
    return estimate


def clustered(df: DataFrame, sort: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted by a sort key, so that file statistics prune on it.

    A hash of the row and the task it came from complete the range key: a sort
    value with many rows, even equal ones, is spread over several files. Both
    are the same when a task is repeated.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranged = df.withColumn("_row", row).withColumn("_task", F.spark_partition_id()) \
        .repartitionByRange(*sort, "_row", "_task")
    return ranged.sortWithinPartitions(*sort).drop("_row", "_task")


def write_sorted(df: DataFrame, path: str, sort: list[str], mode: str = "overwrite",
                 blooms: dict[str, int] | None = None) -> None:
    """Write Parquet clustered by a sort key.

    ``blooms`` names columns of other lookups, with how many different values a file of them may hold: each row group
    then says by a Bloom filter which values it has not got, and a lookup by equality skips it.
    """
    with_blooms(clustered(df, sort).write.mode(mode), blooms).parquet(path)


def with_blooms(writer: DataFrameWriter, blooms: dict[str, int] | None) -> DataFrameWriter:
    for column, values in (blooms or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", values)
    return writer


def write_bucketed(df: DataFrame, table: str, buckets: int, key: list[str],
                   sort: list[str] | None = None, mode: str = "overwrite") -> None:
    """Save a catalog table bucketed by its distribution key and sorted within buckets.

    The rows are first gathered by bucket through a rebalance, so a bucket has a
    few files rather than one from every task, and a large one has several. A
    join on the key then needs no shuffle. Choose a key without hot values: a
    bucket is read by one task. For others use ``write_sorted``.
    """
    df = df.hint("rebalance", buckets, *key)
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, *key)
    writer.sortBy(*(sort or key)).saveAsTable(table)


#: Records in a compressed file of lines at most, as one task reads such a file whole.
LINES_PER_FILE = 1_000_000
#: Folders that a task writes to at once; rows of further ones are sorted by folder first.
OPEN_FOLDERS = 16


def write_lines(df: DataFrame, path: str, partition_by: list[str] | None = None, file_format: str = "json") -> None:
    """Write JSON records, or a column of text, as lines in compressed files.

    With partition columns a task keeps a file open in each of a few folders, so its rows need not be sorted, and
    spilled, by folder.
    """
    spark = df.sparkSession
    writer = df.write.format(file_format).option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
    if not partition_by:
        writer.save(path)
        return
    at_once = "spark.sql.maxConcurrentOutputFileWriters"
    kept = spark.conf.get(at_once)
    spark.conf.set(at_once, str(OPEN_FOLDERS))
    try:
        writer.partitionBy(*partition_by).save(path)
    finally:
        spark.conf.set(at_once, kept)


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and every field in quotes, as part files."""
    df.write.mode(mode).option("header", True).option("quoteAll", True).option(
        "escape", '"').csv(path)


# ---- catalog tables ------------------------------------------------------------

def _qualified(table: Table, database: str) -> str:
    return f"`{database}`.`{table.name}`"


#: How declared tables are stored. Keys in hex and repeated texts take about a third less than with Spark's default.
STORED = "USING parquet OPTIONS ('compression' = 'zstd')"


def create_tables(spark: SparkSession, tables: Iterable[Table], database: str) -> None:
    """Create the tables that do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table in tables:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_qualified(table, database)} "
                  f"({table.ddl}) {STORED}")


def drop_tables(spark: SparkSession, tables: Iterable[Table], database: str) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {_qualified(table, database)}")


#: What a script consists of: texts and names in quotes, comments, the ends of statements, and the rest.
_PIECES = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^'"`;/-]+|.""", re.DOTALL)


def statements(script: str) -> list[str]:
    """The statements of a ``;``-separated script without blank ones; in quotes and comments ``;`` ends none."""
    found = [""]
    for piece in _PIECES.findall(script):
        if piece == ";":
            found.append("")
        elif not piece.startswith(("--", "/*")):
            found[-1] += piece
    return [s.strip() for s in found if s.strip()]


def run_script(spark: SparkSession, script: str) -> int:
    """Run the statements of a script; returns their number."""
    found = statements(script)
    for statement in found:
        spark.sql(statement)
    return len(found)


def read_table(spark: SparkSession, table: Table, database: str) -> DataFrame:
    return spark.table(_qualified(table, database))


def load_table(df: DataFrame, table: Table, database: str, truncate: bool = False,
               violations: dict[str, int] | None = None) -> DataFrame:
    """Insert into a declared table, by column name, after emptying it if asked.

    Missing or surplus columns are an error. Rows are clustered by the table's sort key, and where
    that is absent gathered by its distribution key, so that a file holds few of its values.
    A distribution key with a hot value is split over several files. Returns the loaded table.
    ``violations`` is filled with the numbers of rows that break the table's not-null and domain rules,
    counted as they are written.
    """
    missing, surplus = set(table.names) - set(df.columns), set(df.columns) - set(table.names)
    if missing or surplus:
        raise ValueError(f"{table.name}: missing {sorted(missing)}, surplus {sorted(surplus)}")
    name = _qualified(table, database)
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dtype).alias(f.name) for f in table.fields])
    if table.sort:
        rows = clustered(rows, list(table.sort))
    elif table.distribution:
        rows = rows.hint("rebalance", *table.distribution)
    rules = rules_of(table) if violations is not None else {}
    if rules:
        # Above the clustering, whose look at a sample of the rows would count these twice.
        seen = Observation()
        rows = rows.observe(seen, *[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    rows.write.insertInto(name, overwrite=truncate)
    if rules:
        violations.update(seen.get)
    return read_table(df.sparkSession, table, database)


# ---- keyed tables --------------------------------------------------------------

BUCKET = "_bucket"


def _bucketed(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def write_mergeable(df: DataFrame, path: str, key: list[str], order: list[str], buckets: int) -> None:
    """Write one row per key, the last by ``order``, in folders by a hash of the key.

    ``merge_into`` rewrites only the folders its changes fall into. Choose as many as
    make a folder a few files; the number is fixed for the life of the table.
    """
    last = _bucketed(last_per_key(df, key, order), key, buckets)
    write_parquet(last, path, [BUCKET], sort=key)


def merge_into(spark: SparkSession, path: str, changes: DataFrame, key: list[str], order: list[str],
               buckets: int) -> int:
    """Apply changes to a table of ``write_mergeable``; returns how many folders it rewrote.

    Only touched folders are read, through the folder names, and replaced. The merged rows are
    written aside first, so the table is never read while it is being replaced.
    """
    merged, touched = merged_folders(spark, path, changes, key, order, buckets)
    if touched:
        with staging(spark):
            replace_folders(stage(merged, "merge"), path, key)
    return touched


def merged_folders(spark: SparkSession, path: str, changes: DataFrame, key: list[str], order: list[str],
                   buckets: int) -> tuple[DataFrame, int]:
    """The rows of the folders that changes fall into, with the changes applied, and how many folders."""
    new = _bucketed(changes, key, buckets)
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]    # at most one per folder
    current = spark.read.parquet(path)
    return merge_keyed(current.filter(F.col(BUCKET).isin(touched)), new.select(current.columns), key,
                       order), len(touched)


def replace_folders(rows: DataFrame, path: str, key: list[str]) -> None:
    """Replace the folders that these rows, written aside, fall into."""
    rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *key).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def read_mergeable(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def write_keyed(df: DataFrame, path: str, partition_key: list[str], clustering_key: list[str],
                order: list[str]) -> DataFrame:
    """Write one row per primary key, the last by ``order``, clustered for lookups.

    Rows are range-partitioned by the whole primary key. Each file then covers
    a narrow key range, which a lookup by partition key prunes to; and since the
    primary key is unique, a partition key with very many rows spans many files.
    """
    spark = df.sparkSession
    key = [*partition_key, *clustering_key]
    last = last_per_key(df, key, order)
    last.repartitionByRange(*key).sortWithinPartitions(*key) \
        .write.mode("overwrite").parquet(path)
    return spark.read.schema(last.schema).parquet(path)


def merge_keyed(current: DataFrame, changes: DataFrame, key: list[str],
                order: list[str]) -> DataFrame:
    """``current`` with ``changes`` applied: the last row of each key by ``order``.

    On equal order the change wins, as a later write does.
    """
    both = current.withColumn("_change", F.lit(0)).unionByName(
        changes.withColumn("_change", F.lit(1)))
    return last_per_key(both, key, [*order, "_change"]).drop("_change")
