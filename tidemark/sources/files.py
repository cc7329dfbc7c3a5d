"""Batch file sources. Schemas are given, never inferred by an extra pass."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions import emit_json
from ..operators.staging import normalise
from ..schemas import Field, Table
from ..session import stage


def read_json_lines(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines from paths or globs such as ``log_data/*/*/*.json``."""
    return spark.read.schema(schema).json(paths)


def read_json_tree(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """JSON lines of all files below a folder, at any depth."""
    return (spark.read.schema(schema).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json").json(root))


def read_csv(spark: SparkSession, paths: str | list[str], schema: str,
             source_file: str | None = None, **options) -> DataFrame:
    """Comma-separated files with a header line; blanks around fields are dropped.

    Many files of one shape are read as one table. ``source_file`` adds the
    name of the file that each row came from.
    """
    defaults = {"header": True, "ignoreLeadingWhiteSpace": True,
                "ignoreTrailingWhiteSpace": True, "escape": '"'}
    df = spark.read.schema(schema).options(**{**defaults, **options}).csv(paths)
    return df.withColumn(source_file, F.col("_metadata.file_name")) if source_file else df


def read_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A lookup table kept as one multi-line JSON array."""
    return spark.read.schema(schema).json(path, multiLine=True)


def dated_path(root: str, key: str, run_date: dt.date | None = None) -> str:
    """``root/YYYY/MM/DD/key`` for a back-fill run, or ``root/key``."""
    parts = [root.rstrip("/")]
    if run_date:
        parts.append(run_date.strftime("%Y/%m/%d"))
    return "/".join([*parts, key.lstrip("/")])


def on_date(df: DataFrame, column: str, run_date: dt.date) -> DataFrame:
    """The rows of one run date; on a partition column only that day's folder is read."""
    return df.filter(F.col(column) == F.lit(run_date))


def _raw_struct(paths: list[str]) -> StructType:
    """A schema that holds each dotted path as text, nested as the paths say."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for part in parents:
            node = node.setdefault(part, {})
        node.setdefault(leaf, None)

    def struct(node: dict) -> StructType:
        return StructType([
            StructField(name, struct(sub) if sub else StringType()) for name, sub in node.items()
        ])

    return struct(tree)


def with_mapping(table: Table, mapping: dict[str, str]) -> Table:
    """The table with fields taken from the given JSON paths (``$.a.b`` or ``a.b``)."""
    unknown = set(mapping) - set(table.names)
    if unknown:
        raise ValueError(f"{table.name}: no fields {sorted(unknown)}")
    fields = []
    for f in table.fields:
        path = mapping.get(f.name, f.source or f.name).removeprefix("$").lstrip(".")
        fields.append(Field(f.name, f.dtype, f.width, f.required, f.allowed, f.epoch_millis, path))
    return Table(table.name, tuple(fields), table.key, table.references, table.sort,
                 table.distribution)


def read_mapping(spark: SparkSession, path: str, table: Table) -> dict[str, str]:
    """A mapping file ``{"jsonpaths": ["$.a", …]}``: the n-th path feeds the n-th field."""
    row = spark.read.schema("jsonpaths array<string>").json(path, multiLine=True).first()
    paths = [p.replace("['", ".").replace("']", "") for p in row["jsonpaths"]]
    if len(paths) != len(table.fields):
        raise ValueError(f"{len(paths)} paths for {len(table.fields)} fields")
    return dict(zip(table.names, paths))


#: The text of a record that is no JSON.
CORRUPT = "_corrupt_record"


def read_json_records(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """JSON lines, each with its file (``_file``) and, where it is malformed, its text (``CORRUPT``).

    Parsed once and staged, as Spark parses anew for each reader of a JSON file.
    """
    reader = spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
    lines = reader.option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True).json(paths)
    return stage(lines.withColumn("_file", F.col("_metadata.file_path")), "json-records")


def stage_json(spark: SparkSession, paths: str | list[str], table: Table,
               mapping: dict[str, str] | None = None, rejects: str | None = None) -> DataFrame:
    """Read JSON lines into a declared table, by field name or by a path mapping.

    Every field is read as text in one parse and then normalised: blank text to
    null, text cut to its width, times from epoch milliseconds, other types cast. Malformed
    records are rows of nulls; with ``rejects``, a folder, they are no rows but are written there with their
    text and file, replacing those of an earlier run.
    """
    mapped = with_mapping(table, mapping) if mapping else table
    raw = _raw_struct([f.source or f.name for f in mapped.fields])
    if rejects is None:
        return normalise(spark.read.schema(raw).option("recursiveFileLookup", True).json(paths), mapped)
    records = read_json_records(spark, paths, raw)
    bad = F.col(CORRUPT).isNotNull()
    records.filter(bad).select(F.col(CORRUPT).alias("record"), F.col("_file").alias("file")).write.mode(
        "overwrite").parquet(rejects)
    return normalise(records.filter(~bad).drop(CORRUPT, "_file"), mapped)


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """What ``stage_json`` could not read: the text of each record and its file."""
    return spark.read.schema("record string, file string").parquet(rejects)


def stage_csv(spark: SparkSession, paths: str | list[str], table: Table,
              delimiter: str = ",", skip_header: bool = True) -> DataFrame:
    """Read delimited files into a declared table; fields are taken in file order."""
    raw = ", ".join(f"`{n}` string" for n in table.names)
    df = read_csv(spark, paths, raw, sep=delimiter, header=skip_header, enforceSchema=True,
                  recursiveFileLookup=True)
    return normalise(df, table)


def explode_to_messages(spark: SparkSession, path: str, schema: str, topic: str) -> DataFrame:
    """Each element of a JSON-array file as one message of UTF-8 JSON bytes."""
    records = read_lookup(spark, path, schema)
    return as_messages(records, topic)


def as_messages(records: DataFrame, topic: str, key: list[str] | None = None) -> DataFrame:
    """Rows as keyed JSON messages: key and value bytes and the topic."""
    key_bytes = emit_json(*key).cast("binary") if key else F.lit(None).cast("binary")
    return records.select(
        key_bytes.alias("key"), emit_json().cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def read_activity_logs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_json_lines(spark, paths, schemas.LOG_JSON)


def read_songs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_json_lines(spark, paths, schemas.SONG_JSON)


def read_activity_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Daily activity files with the file name, whose date orders the days.

    Blanks around names are part of them here and stay.
    """
    return read_csv(spark, paths, schemas.LOG_CSV, source_file="source_file",
                    ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
