"""Stream sinks, triggers and progress.

A result that changes (complete or update mode) is written as one folder per
micro-batch. A micro-batch that is run again after a failure replaces its own
folder, so replays leave no duplicates, and nothing is collected on the driver.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..functions import emit_json
from ..operators.keyed import last_per_key
from ..session import fresh_path, remove
from ..sinks.tables import merged_folders, replace_folders
from ..sinks.versions import KeyedTable

BATCH = "batch_id"


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run at a fixed interval (``"17 seconds"``), or once over all there is (None)."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _writer(df: DataFrame, mode: str, checkpoint: str, name: str | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.queryName(name) if name else writer


def to_console(df: DataFrame, checkpoint: str, mode: str = "append", every: str | None = None,
               truncate: bool = False) -> StreamingQuery:
    writer = _writer(df, mode, checkpoint, None).format("console").option("truncate", truncate)
    return triggered(writer, every).start()


def to_files(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append rows as Parquet, each exactly once."""
    writer = _writer(df, "append", checkpoint, None).format("parquet")
    return triggered(writer, every).start(path)


def to_batches(df: DataFrame, path: str, checkpoint: str, mode: str,
               every: str | None = None, name: str | None = None) -> StreamingQuery:
    """Write the output of each micro-batch to its own folder below ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return triggered(_writer(df, mode, checkpoint, name).foreachBatch(write), every).start()


def to_each(df: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None,
            name: str | None = None) -> StreamingQuery:
    """Give each micro-batch of new rows, with its number, to a function that is safe to repeat by that number."""
    return triggered(_writer(df, "append", checkpoint, name).foreachBatch(take), every).start()


def to_keyed(df: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = None,
             name: str | None = None) -> StreamingQuery:
    """Merge each micro-batch by key into a table of versions; a replay of one that is published changes nothing."""
    return to_each(df, table.merge, checkpoint, every, name)


def to_merged(df: DataFrame, path: str, checkpoint: str, key: list[str], order: list[str], buckets: int,
              mode: str = "append", every: str | None = None, name: str | None = None) -> StreamingQuery:
    """Merge each micro-batch by key into a table of ``write_mergeable``.

    The merged folders are written below the checkpoint, under the micro-batch's number, before they replace the
    table's. A replay finds them there and replaces again, also where the table was left half replaced.
    """
    write = _merger(path, checkpoint, key, order, buckets)
    return triggered(_writer(df, mode, checkpoint, name).foreachBatch(write), every).start()


def _merger(path: str, checkpoint: str, key: list[str], order: list[str], buckets: int):
    aside = f"{checkpoint}/merged"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        written = _numbers(spark, aside, BATCH)
        if batch_id not in written:
            merged, touched = merged_folders(spark, path, batch, key, order, buckets)
            if not touched:
                return
            merged.write.mode("overwrite").parquet(f"{aside}/{BATCH}={batch_id}")
        replace_folders(spark.read.parquet(f"{aside}/{BATCH}={batch_id}"), path, key)
        for older in written:
            if older < batch_id:
                remove(spark, f"{aside}/{BATCH}={older}")

    return write


#: Folder of folded changes below a result; Spark passes over names that begin so.
BASE = "_base"


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(at) if f.isDirectory()] \
        if files.exists(at) else []


def _numbers(spark: SparkSession, path: str, label: str) -> list[int]:
    """Numbers of the folders ``label=number`` below a path whose write has ended."""
    found = [n for n in _names(spark, path) if n.startswith(f"{label}=")]
    files = spark._jvm.org.apache.hadoop.fs
    done = [n for n in found if files.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
            .exists(files.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The result of a complete-mode stream: the output of its last micro-batch."""
    return spark.read.parquet(f"{path}/{BATCH}={_numbers(spark, path, BATCH)[-1]}")


def _base_and_tail(spark: SparkSession, path: str) -> tuple[DataFrame, list[int], int]:
    """The folded changes with all that came later, the later micro-batches, and the last folded one."""
    bases = _numbers(spark, f"{path}/{BASE}", BATCH)
    folded = bases[-1] if bases else -1
    tail = [n for n in _numbers(spark, path, BATCH) if n > folded]
    frames = [spark.read.parquet(f"{path}/{BASE}/{BATCH}={folded}")] if bases else []
    if tail:
        frames.append(spark.read.option("basePath", path).parquet(
            *[f"{path}/{BATCH}={n}" for n in tail]))
    if bases:
        frames[0] = frames[0].withColumn(BATCH, F.lit(folded))
    rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return rows, tail, folded


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The result of an update-mode stream: the last output of each key.

    Reads the folded changes, if there are any, and the micro-batches since.
    """
    rows, _, _ = _base_and_tail(spark, path)
    return last_per_key(rows, keys, [BATCH]).drop(BATCH)


def compact_updates(spark: SparkSession, path: str, keys: list[str], keep: int = 1) -> int:
    """Fold all but the last ``keep`` micro-batches into one table of current rows, and remove them.

    The folded table's name says up to which micro-batch it goes, and it counts once its write
    has ended; only then are the folders that went into it removed. So reading costs what has
    changed since, however long the stream has run, and a fold that breaks off changes
    nothing. The last micro-batch stays, as the stream may run it again. Returns the number of
    micro-batches folded. Frames read earlier must be read anew.
    """
    rows, tail, folded = _base_and_tail(spark, path)
    fold = tail[:-keep] if keep else tail
    if not fold:
        return 0
    last = last_per_key(rows.filter(F.col(BATCH) <= fold[-1]), keys, [BATCH]).drop(BATCH)
    last.write.mode("overwrite").parquet(f"{path}/{BASE}/{BATCH}={fold[-1]}")
    for n in fold:
        remove(spark, f"{path}/{BATCH}={n}")
    if folded >= 0:
        remove(spark, f"{path}/{BASE}/{BATCH}={folded}")
    return len(fold)


def envelope(df: DataFrame, key: str, topic: str | None = None) -> DataFrame:
    """Rows as messages: the key column as text and all columns as JSON."""
    columns = [F.col(key).cast("string").alias("key"), emit_json().alias("value")]
    return df.select(*columns, *([F.lit(topic).alias("topic")] if topic else []))


def to_kafka(df: DataFrame, key: str, servers: str, topic: str, checkpoint: str,
             mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Publish rows to a topic. In update mode the topic is the changelog of a keyed table."""
    writer = _writer(envelope(df, key), mode, checkpoint, None).format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return triggered(writer, every).start()


def to_topic_files(df: DataFrame, key: str, topic: str, path: str, checkpoint: str,
                   mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Publish the same messages to a folder."""
    messages = envelope(df, key, topic)
    if mode == "append":
        return to_files(messages, path, checkpoint, every)
    return to_batches(messages, path, checkpoint, mode, every)


def drain(df: DataFrame, mode: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over all it has into the scratch folder and return its result."""
    spark = df.sparkSession
    out = fresh_path(spark, label)
    if mode == "append":
        query = to_files(df, out, f"{out}-checkpoint")
    else:
        query = to_batches(df, out, f"{out}-checkpoint", mode)
    query.awaitTermination()
    if mode == "append":
        return spark.read.schema(df.schema).parquet(out)
    return read_complete(spark, out) if mode == "complete" else read_updates(spark, out, keys)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, **options) -> DataFrame:
    """What a stream keeps in the state of one of its operators after its last micro-batch: key, value, partition.

    Read from the checkpoint, so neither the stream nor a count kept by it is needed. ``options`` are those of Spark's
    reader, such as ``batchId`` or ``joinSide``.
    """
    return spark.read.format("statestore").options(operatorId=operator, **options).load(checkpoint).select(
        "key", "value", F.col("partition_id").alias("partition"))


def state_report(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per operator with state: its number, its name, partitions and rows. Joins keep four stores; one is counted of each side."""
    kept = spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName").distinct().collect()       # as many as the query has operators
    parts = []
    for number, name in kept:
        sides = [{"joinSide": s} for s in ("left", "right")] if "Join" in name else [{}]
        rows = [state_rows(spark, checkpoint, number, **side).select("partition") for side in sides]
        both = rows[0].union(rows[1]) if len(rows) == 2 else rows[0]
        parts.append(both.agg(F.lit(number).alias("operator"), F.lit(name).alias("name"),
                              F.count_distinct("partition").alias("partitions"), F.count(F.lit(1)).alias("rows")))
    if not parts:
        return spark.createDataFrame([], "operator bigint, name string, partitions bigint, rows bigint")
    return reduce(DataFrame.union, parts)


PROGRESS = (
    "batch_id bigint, started string, input_rows bigint, input_rate double, "
    "processed_rate double, state_rows bigint, state_bytes bigint, rows_dropped_late bigint, "
    "watermark string, duration_ms bigint"
)


def _report(progress: str, tracked: bool) -> tuple:
    """One report as a row. Where the state's rows are not tracked their number is null, not 0."""
    p = json.loads(progress)
    state = p.get("stateOperators") or []
    return (
        p["batchId"], p["timestamp"], p["numInputRows"],
        p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond"),
        sum(s["numRowsTotal"] for s in state) if tracked or not state else None,
        sum(s["memoryUsedBytes"] for s in state),
        sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
        (p.get("eventTime") or {}).get("watermark"),
        (p.get("durationMs") or {}).get("triggerExecution"),
    )


def _tracked(spark: SparkSession) -> bool:
    return spark.conf.get(TRACKED, "true").lower() == "true"


TRACKED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def progress_report(query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch: rows, rates, state and lateness.

    Spark keeps a bounded number of reports (``spark.sql.streaming.numRecentProgressUpdates``);
    a ``ProgressLog`` keeps all.
    """
    spark = SparkSession.active()
    reports = [p.json if hasattr(p, "json") else json.dumps(p) for p in query.recentProgress]
    return spark.createDataFrame([_report(p, _tracked(spark)) for p in reports], PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Appends every report of one query to a table, as it comes in.

    Start it before the query, by ``spark.streams.addListener``. It follows the query of the given name.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.ended, self._id = threading.Event(), None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._id = event.id

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            row = _report(event.progress.json, _tracked(self.spark))
            self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self._id:
            self.ended.set()

    def read(self, wait_seconds: float = 60) -> DataFrame:
        """All reports of a query that has ended; it waits until the last one has come in."""
        if not self.ended.wait(wait_seconds):
            raise TimeoutError(f"no end of query {self.name!r} was reported")
        return read_reports(self.spark, self.path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """The reports of a ``ProgressLog``, those that were folded and those since."""
    folded = _numbers(spark, f"{path}/{BASE}", BATCH)
    last = folded[-1] if folded else -1
    rows = spark.read.schema(PROGRESS).parquet(path).filter(F.col("batch_id") > last)
    return rows.union(spark.read.schema(PROGRESS).parquet(f"{path}/{BASE}/{BATCH}={last}")) if folded else rows


def fold_reports(spark: SparkSession, path: str) -> int:
    """Gather the reports so far, of which each has a file, in one; returns how many there are.

    They count from where the fold says it ends, so one that breaks off changes nothing. The files of folded reports
    go with the next fold, which readers of the log may outlast.
    """
    rows = read_reports(spark, path)
    found = rows.agg(F.max("batch_id"), F.count(F.lit(1))).first()
    folded = _numbers(spark, f"{path}/{BASE}", BATCH)
    if found[0] is None or folded and found[0] <= folded[-1]:
        return found[1]
    counted = spark.read.schema(PROGRESS).parquet(path).filter(F.col("batch_id") <= (folded[-1] if folded else -1))
    old = [r[0] for r in counted.select("_metadata.file_name").distinct().collect()]    # of one fold's reports
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{BASE}/{BATCH}={found[0]}")
    for name in old:
        remove(spark, f"{path}/{name}")
    for number in folded[:-1]:
        remove(spark, f"{path}/{BASE}/{BATCH}={number}")
    return found[1]
