"""Best-fit packing of documents into sequences, planned on the histogram of their lengths.

The plan never looks at documents: it places counts of equal lengths into groups of equal
sequences, so its size follows the capacity and not the corpus. Documents then take the planned
places by their rank among all pieces of their length.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_total, staged
from .tokens import byte_pairs

CAPACITY, END_ID = 1024, 2


# ---- pieces ------------------------------------------------------------------------------

def _cutter(ranks_path: str, pattern: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encode = byte_pairs(ranks_path, pattern).encode
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = []
                some = batch.slice(at, 256)
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist()):
                    ids = encode(text or "") + end
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    stops = [0, *range(first, n + 1, capacity)]
                    rows += [(doc_id, i, a, b - a, ids[4 * a:4 * b])
                             for i, (a, b) in enumerate(zip(stops, stops[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    ["doc_id", "piece", "start", "length", "ids"])
    return cut


def token_pieces(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY,
                 end_id: int = END_ID, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents' token ids, each ended by ``end_id``, in pieces of at most ``capacity``.

    Columns: doc_id, piece, start, length, ids (little-endian 32-bit). Only a longer document is
    cut: all its pieces are full but the first, which takes the rest. A null text is an empty one
    and gives a piece of one token. Repeated rows, rows that share an id and rows without one are documents of their
    own. A text's ids are in memory while it is cut. Other columns, whatever their names, are ignored; an empty table gives no piece.
    """
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _cutter(ranks_path, pattern, capacity, end_id),
        "doc_id long, piece int, start long, length long, ids binary")


# ---- the plan ----------------------------------------------------------------------------

def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal sequences: how many, and the (length, copies) of each in order of place.

    Best fit decreasing: lengths from the longest, each into the fullest sequences with room, as
    many copies as fit there. All sequences of a group get the same, so a step costs the
    same for one document or a billion. A step either uses up a length or a group, and
    leaves at most two groups more; there are at most a few for every length.
    """
    groups: dict[int, list] = defaultdict(list)      # room left -> [(how many, contents)]
    rooms: list[int] = []                            # the rooms in order

    def add(room: int, many: int, contents: list) -> None:
        if many:
            if not groups[room]:
                bisect.insort(rooms, room)
            groups[room].append((many, contents))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length
                add(capacity - fit * length, left // fit, [(length, fit)])
                if left % fit:
                    add(capacity - left % fit * length, 1, [(length, left % fit)])
                break
            room = rooms[at]
            many, contents = groups[room].pop()
            if not groups[room]:
                rooms.pop(at)
            fit = min(room // length, left)
            used = min(many, left // fit)
            add(room, many - used, contents)
            add(room - fit * length, used, [*contents, (length, fit)])
            left -= used * fit
    return [group for room in rooms for group in groups[room]]


def plan_rows(groups: list) -> list[tuple[int, int, int, int, int]]:
    """Places by length: (length, first rank, rank after the last, first sequence, offset).

    The piece of rank r takes sequence ``first sequence + r - first rank``.
    """
    taken, rows, sequence = defaultdict(int), [], 0
    for many, contents in groups:
        offset = 0
        for length, copies in contents:
            for _ in range(copies):
                rows.append((length, taken[length], taken[length] + many, sequence, offset))
                taken[length] += many
                offset += length
        sequence += many
    return rows


def _placer(rows: list):
    by_length = defaultdict(list)
    for length, *rest in rows:
        by_length[length].append(rest)
    plan = {length: np.array(sorted(r), np.int64).T for length, r in by_length.items()}

    def place(batches):
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            order = np.argsort(lengths, kind="stable")
            cuts = np.flatnonzero(np.diff(lengths[order])) + 1
            for mine in np.split(order, cuts) if len(order) else []:
                first, _, start, at = plan[int(lengths[mine[0]])]
                row = np.searchsorted(first, ranks[mine], "right") - 1
                sequence[mine] = start[row] + ranks[mine] - first[row]
                offset[mine] = at[row]
            columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "_rank"]
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])
    return place


def packed(pieces: DataFrame, capacity: int = CAPACITY, order=("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` from 1 to ``capacity``.

    ``order`` names pieces within a length; pieces equal in all of it are interchangeable. ``pieces``
    is read three times and should be a written table. No piece gives no sequence.
    """
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {r["length"]: r["n"] for r in counts}
    if histogram and not 1 <= min(histogram) <= max(histogram) <= capacity:
        raise ValueError("a piece is longer than the capacity, or empty")
    rows = plan_rows(best_fit(histogram, capacity))
    ranked = running_total(pieces, ["length"], list(order), F.lit(1).cast("long"), "_rank")
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(_placer(rows), schema)
