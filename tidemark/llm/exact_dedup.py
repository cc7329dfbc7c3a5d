"""Exact deduplication of texts by Grace hashing.

Each input task first folds the copies among its own rows in an open-addressing table that compares complete
content, so a text that fills a third of the table travels once per task. The remaining rows are shuffled by
digest, and every task deduplicates its share in a table of the same kind. What does
not fit the table's memory goes to spill files by a seeded hash, and each file is treated
the same way with the next seed until it fits.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, staged

#: Bytes of text that an input task folds at a time, and of a table.
FOLD_BYTES, TABLE_BYTES = 48 << 20, 64 << 20
#: What an entry costs besides its content, and a row besides its entry (measured on short contents).
ENTRY_BYTES, KEY_BYTES = 480, 40
FAN_OUT = 16


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(None, BLANKS)


@dataclass
class Group:
    """Rows of one content: the row that stays, by (points, -id) rank, and all row keys."""
    best: tuple
    size: int = 0
    keys: list[int] = field(default_factory=list)


class ContentTable:
    """Open addressing with linear probing; equal hashes are settled by complete content."""

    def __init__(self) -> None:
        self.slots, self.hashes, self.contents, self.groups, self.bytes = [-1] * 64, [], [], [], 0

    def find(self, h: int, content: bytes) -> int:
        """The entry's number, or ``~slot`` of the free slot where it belongs."""
        mask = len(self.slots) - 1
        i = h & mask
        while (entry := self.slots[i]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry
            i = (i + 1) & mask
        return ~i

    def insert(self, slot: int, h: int, content: bytes, group: Group) -> None:
        self.slots[slot] = len(self.groups)
        self.hashes.append(h)
        self.contents.append(content)
        self.groups.append(group)
        self.bytes += len(content) + ENTRY_BYTES
        if 2 * len(self.groups) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for entry, old in enumerate(self.hashes):
                i = old & mask
                while self.slots[i] >= 0:
                    i = (i + 1) & mask
                self.slots[i] = entry


def rank(points: int, doc_id: int | None, key: int) -> tuple:
    """Larger is better: more code points, then the smaller id (null last), then the earlier row."""
    return points, doc_id is not None, -(doc_id or 0), -key


def grace(records: Iterator[tuple], table_bytes: int, level: int = 0) -> Iterator[tuple[bytes, Group]]:
    """Content and group of all records (content, key, id, points, copies).

    Once a content was turned away for lack of room, the table no longer takes any new one of
    its length or more, so all its records meet in one spill file. Files are unnamed and
    belong to the task: they vanish with it, and a repeated task writes its own.
    """
    table, files = ContentTable(), []
    for record in records:
        content, key, doc_id, points, copies = record
        h = xxhash.xxh64_intdigest(content, seed=level)
        at = table.find(h, content)
        if at < 0:
            if table.groups and table.bytes + len(content) > table_bytes:
                files = files or [tempfile.TemporaryFile() for _ in range(FAN_OUT)]
                pickle.dump(record, files[xxhash.xxh64_intdigest(content, seed=~level & 0xFFFF) % FAN_OUT])
                continue
            table.insert(~at, h, content, Group((-1,)))
            at = len(table.groups) - 1
        group = table.groups[at]
        group.best = max(group.best, rank(points, doc_id, key))
        group.size += copies
        group.keys.append(key)
        table.bytes += KEY_BYTES
    yield from zip(table.contents, table.groups)
    del table

    def read(file):
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return

    for file in files:
        with file:
            yield from grace(read(file), table_bytes, level + 1)


def _folded(batches: list[pa.RecordBatch], first_key: int) -> Iterator[pa.RecordBatch]:
    """Rows of the batches with their keys; only the best row of each content keeps its columns."""
    table, shas = ContentTable(), []
    rows, key = [], first_key
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch["_text"]), 0).to_pylist()
        for text, doc_id, points in zip(batch["_text"].to_pylist(), batch["_id"].to_pylist(), lengths):
            content, mine = normalised(text), rank(points, doc_id, key)
            h = xxhash.xxh64_intdigest(content)
            at = table.find(h, content)
            if at < 0:
                table.insert(~at, h, content, Group(mine))
                shas.append(hashlib.sha256(content).digest())
                at = len(shas) - 1
            group = table.groups[at]
            group.best = max(group.best, mine)
            group.size += 1
            rows.append((at, points))
            key += 1
    key = first_key
    for batch in batches:
        mine = rows[key - first_key:key - first_key + len(batch)]
        keys = range(key, key + len(batch))
        reps = [-table.groups[at].best[3] for at, _ in mine]
        row = batch["_row"]
        other = pa.array([k != r for k, r in zip(keys, reps)])
        row = pa.StructArray.from_arrays(row.flatten(), fields=list(row.type), mask=other)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(reps, pa.int64()), batch["_id"],
             pa.array([p for _, p in mine], pa.int64()),
             pa.array([table.groups[at].size for at, _ in mine], pa.int64()),
             pa.array([shas[at] for at, _ in mine], pa.binary()), row],
            ["key", "rep", "id", "points", "copies", "sha", "row"])
        key += len(batch)


def _fold(batches):
    key, waiting, size = TaskContext.get().partitionId() << 38, [], 0
    for batch in batches:
        for at in range(0, len(batch), 1024):
            piece = batch.slice(at, 1024)
            waiting.append(piece)
            size += piece["_text"].nbytes
            if size >= FOLD_BYTES:
                yield from _folded(waiting, key)
                key, waiting, size = key + sum(map(len, waiting)), [], 0
    yield from _folded(waiting, key)


def _resolver(table_bytes: int):
    def resolve(batches):
        def records():
            for batch in batches:
                for text, key, doc_id, points, copies in zip(*(batch[c].to_pylist() for c in (
                        "text", "key", "id", "points", "copies"))):
                    yield normalised(text), key, doc_id, points, copies

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(),
                                                             pa.int64(), pa.string()))],
                ["rep", "keep_key", "keep_id", "group_size", "text_sha256"])

        rows = []
        for content, group in grace(records(), table_bytes):
            sha = hashlib.sha256(content).hexdigest()
            _, known, minus_id, minus_key = group.best
            rows += [(k, -minus_key, -minus_id if known else None, group.size, sha) for k in group.keys]
            if len(rows) >= 10_000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)
    return resolve


def _marked(docs: DataFrame, text: str, doc_id: str, columns: list[str], table_bytes: int):
    """The folded rows as a written table, and for each of its representatives the group."""
    source = docs.select(
        F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"),
        F.struct(*[F.col(c) for c in columns]).alias("_row"))
    row_type = source.schema["_row"].dataType.simpleString()
    folded = staged(source.mapInArrow(
        _fold, "key long, rep long, id long, points long, copies long, sha binary, "
               f"row {row_type}"), "exact-folded")
    reps = folded.filter("key = rep").select(
        "key", "id", "points", "copies", F.col("row").getField(text).alias("text"), "sha")
    groups = reps.repartition("sha").mapInArrow(
        _resolver(table_bytes),
        "rep long, keep_key long, keep_id long, group_size long, text_sha256 string")
    return folded, groups


def duplicate_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal without white space; null counts as empty, and empty texts are
    equal to each other. The row with the most code points stays, then the smallest id; rows
    without an id come last. Of rows equal in both, the one first in storage stays, so one row of each
    group is kept even where ids repeat. Other columns are not looked at.
    """
    folded, groups = _marked(docs, text, doc_id, [text], table_bytes)
    return folded.select("key", "rep", "id").join(groups, "rep").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("key") == F.col("keep_key")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    folded, groups = _marked(docs, text, doc_id, docs.columns, table_bytes)
    keep = groups.filter("rep = keep_key").select("rep")
    return folded.filter("key = rep").join(keep, "rep").select("row.*")
