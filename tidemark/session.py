"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: SQL settings every job relies on. All of them may be changed at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: small shuffles are merged, a small side turns the
    # join into a broadcast, and a hot join key is split over several tasks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming state lives off-heap and only its changes are uploaded.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Reports kept per query for ``streaming.sinks.progress_report``.
    "spark.sql.streaming.numRecentProgressUpdates": "1000",
    # Counting state rows costs a read before every write; set it to true to
    # see them in ``streaming.sinks.progress_report``.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

#: Input that a shuffle partition takes at most before run-time merging.
PARTITION_BYTES = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

#: Paths written by ``stage`` inside each open ``staging``, innermost last.
_open: list[list[str]] = []


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; ``conf`` takes further keys with ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply ``SETTINGS`` to a session someone else made.

    A chosen number of shuffle partitions is left alone. Where none is chosen, a local master
    gets one per core, and a cluster starts each shuffle with several per core and at least
    one for every ``PARTITION_BYTES`` of the input; at run time small ones are merged to the
    advised size, but evenly large ones are not split.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    shuffles = "spark.sql.shuffle.partitions"
    if spark.conf.get(shuffles) == "200" and not spark.sparkContext.getConf().contains(shuffles):
        cores = spark.sparkContext.defaultParallelism
        if is_local(spark):
            spark.conf.set("spark.sql.shuffle.partitions", str(cores))
        elif input_bytes or spark.conf.get(INITIAL_PARTITIONS, None) is None:
            spark.conf.set(INITIAL_PARTITIONS, str(max(200, 4 * cores, input_bytes // PARTITION_BYTES)))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or one below the warehouse.

    Never a machine's own temporary folder: other executors could not read it, nor could one
    that replaces a lost executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return shared.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that nothing has written to yet."""
    return f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and continue from the written table.

    Use where a value must not change if a task is run again (sampled range
    bounds, row numbers) or where several later steps read the same result.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    if _open:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def size_of(spark: SparkSession, paths: str) -> int:
    """Bytes below a path or glob."""
    at = spark._jvm.org.apache.hadoop.fs.Path(paths)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(files.getContentSummary(f.getPath()).getLength() for f in files.globStatus(at) or [])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what ``stage`` writes inside the block when it ends.

    For jobs that write their results. A frame built on a staged table must not leave the block;
    outside of any block staged tables stay, and the caller owns the scratch folder.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove(spark, path)
