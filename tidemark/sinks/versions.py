"""Keyed tables in versions: readers see all of a merge or nothing, and buckets split as the table grows.

Rows lie in buckets by a hash of their key, each bucket named by how many bits of the hash count (its depth) and
by what these are. A merge reads the buckets its changes fall into, writes them anew beside the old ones, and
publishes a small list of all buckets as the next version. Nothing that a version names is overwritten.
A bucket that could hold more rows than it should is written as two of one more bit, or four of two.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.keyed import last_per_key
from ..session import remove
from .tables import merge_keyed

_VERSIONS, _DATA, _HASH, _BUCKET = "_versions", "data", "_hash", "_in"
#: Rows of a bucket above which it splits, unless a table says otherwise.
BUCKET_ROWS = 2_000_000


class ConcurrentMerge(RuntimeError):
    """Another merge has published the version that this one was to be."""


class Bucket(NamedTuple):
    depth: int
    prefix: int
    folder: str | None      # below the table's path; None for no rows
    rows: int

    @property
    def name(self) -> str:
        return f"{self.depth}_{self.prefix}"


class Version(NamedTuple):
    number: int
    batch: int              # the last micro-batch that has been merged, or -1
    buckets: tuple[Bucket, ...]


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _children(spark: SparkSession, path: str) -> list[str]:
    files, at = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


class KeyedTable:
    """One row per ``key`` at ``path``, with all columns of ``schema``.

    ``order`` says which of several rows of a key is the last. Make a table with ``create``; any later ``KeyedTable``
    with the same arguments goes on from its versions. One writer at a time; a second one fails
    when it publishes and changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, key: list[str],
                 order: list[str] = (), bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), list(key), list(order)
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        self.bucket_rows = bucket_rows

    # ---- versions

    def versions(self) -> list[int]:
        names = _children(self.spark, f"{self.path}/{_VERSIONS}")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]

    def version(self, number: int | None = None) -> Version:
        """A version, the last one by default. A table that has none yet is one empty bucket."""
        if number is None:
            known = self.versions()
            if not known:
                return Version(0, -1, (Bucket(0, 0, None, 0),))
            number = known[-1]
        text = self.spark.read.text(f"{self.path}/{_VERSIONS}/{number:020d}.json", wholetext=True).first()[0]
        found = json.loads(text)
        return Version(number, found["batch"], tuple(Bucket(*b) for b in found["buckets"]))

    def _publish(self, version: Version) -> None:
        files, folder = _file_system(self.spark, f"{self.path}/{_VERSIONS}")
        files.mkdirs(folder)
        aside = _file_system(self.spark, f"{self.path}/{_VERSIONS}/.{uuid.uuid4().hex}")[1]
        out = files.create(aside, False)
        out.write(bytearray(json.dumps({"batch": version.batch, "buckets": version.buckets}), "utf-8"))
        out.close()
        name = _file_system(self.spark, f"{self.path}/{_VERSIONS}/{version.number:020d}.json")[1]
        if files.exists(name) or not files.rename(aside, name):
            files.delete(aside, False)
            raise ConcurrentMerge(f"{self.path}: version {version.number} exists")

    # ---- reading

    def _rows(self, buckets) -> DataFrame:
        folders = [f"{self.path}/{b.folder}" for b in buckets if b.folder]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, number: int | None = None) -> DataFrame:
        """All rows of a version. The frame stays valid until the version is vacuumed."""
        return self._rows(self.version(number).buckets)

    def _in_buckets(self, rows: DataFrame, buckets) -> DataFrame:
        """``rows`` with the name of the bucket of their key."""
        deepest = max(b.depth for b in buckets)
        slots = [(b.prefix + (i << b.depth), b.name) for b in buckets for i in range(1 << (deepest - b.depth))]
        known = self.spark.createDataFrame(slots, f"_slot bigint, {_BUCKET} string")
        slot = F.xxhash64(*self.key).bitwiseAND(F.lit((1 << deepest) - 1))
        return rows.withColumn("_slot", slot).join(known, "_slot").drop("_slot")

    def rows_near(self, keys: DataFrame, version: Version | None = None) -> DataFrame:
        """The rows of the buckets that these keys fall into; others are not read."""
        buckets = (version or self.version()).buckets
        named = {r[0] for r in self._in_buckets(keys, buckets).select(_BUCKET).distinct().collect()}
        return self._rows(b for b in buckets if b.name in named)

    # ---- writing

    def merge(self, changes: DataFrame, batch: int | None = None) -> bool:
        """Apply changes, the last row of each key by the table's order; on equal order a change wins."""
        return self.apply(changes, lambda current, new: merge_keyed(current, new, self.key, self.order), batch)

    def create(self, rows: DataFrame) -> KeyedTable:
        """Fill a new table with the last row of each key."""
        if self.versions():
            raise ValueError(f"{self.path} has versions")
        self.apply(rows, lambda _, new: last_per_key(new, self.key, self.order))
        return self

    def apply(self, changes: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame],
              batch: int | None = None) -> bool:
        """Publish ``combine(current rows, changes)`` of the touched buckets as the next version.

        ``combine`` gives one row per key at most, and sees whole buckets. A micro-batch that has been merged already
        (by its number) changes nothing, and the answer is False.
        """
        current = self.version()
        if batch is not None and batch <= current.batch:
            return False
        changes = changes.select(*self.schema.names)
        # Keys, not rows: a key with a third of all changes makes its bucket no larger.
        arrived = dict(self._in_buckets(changes, current.buckets).groupBy(_BUCKET).agg(
            F.count_distinct(F.xxhash64(*self.key))).collect())
        touched = [b for b in current.buckets if b.name in arrived]
        after: list[Bucket] = [b for b in current.buckets if b.name not in arrived]
        if touched:
            after += self._written(combine(self._rows(touched), changes), current.number + 1, [
                Bucket(b.depth + more, b.prefix + (i << b.depth), None, 0) for b in touched
                for more in [_halvings(b.rows + arrived[b.name], self.bucket_rows)] for i in range(1 << more)])
        self._publish(Version(current.number + 1, current.batch if batch is None else batch, tuple(sorted(after))))
        return True

    def _written(self, rows: DataFrame, number: int, buckets: list[Bucket]) -> list[Bucket]:
        folder = f"{_DATA}/{number}-{uuid.uuid4().hex}"
        self._in_buckets(rows.select(*self.schema.names), buckets).hint("rebalance", _BUCKET).sortWithinPartitions(
            _BUCKET, *self.key).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(f"{_BUCKET} string").parquet(f"{self.path}/{folder}") \
            if any(n.startswith(_BUCKET) for n in _children(self.spark, f"{self.path}/{folder}")) else None
        counts = dict(written.groupBy(_BUCKET).count().collect()) if written else {}
        return [b._replace(folder=f"{folder}/{_BUCKET}={b.name}", rows=counts[b.name]) if b.name in counts else b
                for b in buckets]

    def vacuum(self, keep: int = 2) -> int:
        """Remove what the last ``keep`` versions don't name; returns the number of versions removed.

        Frames of removed versions can't be read any more.
        """
        known = self.versions()
        gone, kept = known[:-keep], known[-keep:]
        named = {b.folder for n in kept for b in self.version(n).buckets if b.folder}
        runs = {f.split("/")[1] for f in named}
        for run in _children(self.spark, f"{self.path}/{_DATA}"):
            if int(run.split("-")[0]) > known[-1]:
                continue            # of a merge that has yet to publish
            if run not in runs:
                remove(self.spark, f"{self.path}/{_DATA}/{run}")
                continue
            for part in _children(self.spark, f"{self.path}/{_DATA}/{run}"):
                if part.startswith(_BUCKET) and f"{_DATA}/{run}/{part}" not in named:
                    remove(self.spark, f"{self.path}/{_DATA}/{run}/{part}")
        for n in gone:
            remove(self.spark, f"{self.path}/{_VERSIONS}/{n:020d}.json")
        return len(gone)


def _halvings(rows: int, most: int) -> int:
    more = 0
    while rows > most << more and more < 20:
        more += 1
    return more


def summed(current: DataFrame, changes: DataFrame, key: list[str], value: str) -> DataFrame:
    """For ``KeyedTable.apply``: values add up by key, and a key whose value is zero goes."""
    return current.unionByName(changes).groupBy(*key).agg(F.sum(value).alias(value)).filter(F.col(value) != 0)
