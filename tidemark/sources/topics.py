"""Stream sources with the Kafka record shape, and message decoding.

``kafka_topics`` needs the Kafka connector on the class path. ``file_topics``
reads the same record shape from a folder of Parquet files, which is how the
jobs run where there is no broker.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import parse_json, text_of
from ..operators.messages import fields_of
from ..schemas import ENVELOPE

_AVRO_HEADER = 5    # a magic byte and a four-byte schema number


def _starting(earliest: bool) -> str:
    return "earliest" if earliest else "latest"


def kafka_topics(spark: SparkSession, servers: str, topic: str | None = None,
                 pattern: str | None = None, earliest: bool = True,
                 max_per_trigger: int | None = None, **options) -> DataFrame:
    """Subscribe to one topic, or to all topics that match a pattern."""
    if (topic is None) == (pattern is None):
        raise ValueError("give a topic or a pattern")
    reader = spark.readStream.format("kafka").options(**options)
    reader = reader.option("kafka.bootstrap.servers", servers)
    reader = reader.option("startingOffsets", _starting(earliest))
    reader = reader.option(*(("subscribe", topic) if topic else ("subscribePattern", pattern)))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def file_topics(spark: SparkSession, path: str, topic: str | None = None,
                pattern: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages from a folder of Parquet files, filtered by topic or pattern."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return on_topic(reader.parquet(path), topic, pattern)


def on_topic(messages: DataFrame, topic: str | None = None, pattern: str | None = None) -> DataFrame:
    """Messages of one topic, or of the topics a pattern matches as a whole."""
    if topic is not None:
        messages = messages.filter(F.col("topic") == topic)
    if pattern is not None:
        messages = messages.filter(F.col("topic").rlike(f"^(?:{pattern})$"))
    return messages


def table_stream(spark: SparkSession, path: str, schema: StructType | str,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A stream over the Parquet files of a table, present and future."""
    reader = spark.readStream.schema(schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def avro_schema(schema: StructType | str, name: str = "value",
                enums: dict[str, tuple[str, ...]] | None = None,
                nullable: tuple[str, ...] = ()) -> str:
    """The Avro record schema of a flat struct.

    ``enums`` names the symbols of fields that are enumerations, ``nullable`` the fields that are
    unions with null; bytes of such fields can't be read as plain ones.
    """
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = {"integer": "int", "long": "long", "string": "string", "boolean": "boolean",
             "double": "double", "float": "float", "binary": "bytes"}
    fields = []
    for f in struct.fields:
        kind: object = names[f.dataType.typeName()]
        if enums and f.name in enums:
            kind = {"type": "enum", "name": f"{f.name}_enum", "symbols": list(enums[f.name])}
        fields.append({"name": f.name, "type": ["null", kind] if f.name in nullable else kind})
    return json.dumps({"type": "record", "name": name, "fields": fields})


def decode(value: Column, schema: StructType | str, encoding: str = "json",
           framed: bool = True, **avro) -> Column:
    """Message bytes to a struct. Avro bytes may carry a registry header (``framed``)."""
    if encoding == "json":
        return parse_json(text_of(value), schema)
    if encoding != "avro":
        raise ValueError(f"unknown encoding {encoding!r}")
    from pyspark.sql.avro.functions import from_avro    # needs the spark-avro package
    body = F.substring(value, _AVRO_HEADER + 1, 2**31 - 1) if framed else value
    return from_avro(body, avro_schema(schema, **avro), {"mode": "PERMISSIVE"})


def decoded(messages: DataFrame, schema: StructType | str, key_schema: str | None = None,
            encoding: str = "json", keep: tuple[str, ...] = (), **avro) -> DataFrame:
    """Messages with the value's fields, the key's fields and the ``keep`` columns."""
    structs = [decode(F.col("value"), schema, encoding, **avro)]
    if key_schema:
        structs.insert(0, decode(F.col("key"), key_schema, encoding))
    return fields_of(messages, structs, keep)
