"""Removal of long repeated passages by a distributed merge of sorted suffixes.

Which suffixes have to be sorted? Each string of ``length`` bytes names one place inside it, its anchor: the
place whose next GRAM bytes have the least hash. Equal strings name the same place, so repeats
meet wherever the suffixes at anchors are sorted together, and those are one in about thirty.

1. Documents are gathered into chunks and written. The hashes at a chunk's anchors go, as sorted runs,
   to buckets that report which of them occur again anywhere.
2. For those anchors a chunk sorts the suffixes, each no longer than the strings that name it. Copies within
   the chunk are settled there. The rest leaves as front-coded runs: each suffix is stored
   without what it shares with the one before.
3. A bucket merges its runs in a loser tree. Every entry knows how much it shares with the last
   suffix that came out, so a comparison starts after that, and most are settled by those two
   numbers alone. What the merged suffixes share shows which strings are equal, and all but
   the earliest are reported to their chunks, which cut them out.

A passage in very many documents would bring together, at its edges, as many different suffixes.
Anchors that occur often are therefore split: each stands for six strings at most, which share
all but five bytes, and goes to a bucket by those shared bytes.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, staged

LENGTH, GRAM = 100, 40
#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 12 << 20
#: Occurrences of an anchor from which on it is split, and strings that a split anchor stands for.
OFTEN, SPLIT = 200, 6
#: Strings whose anchors are looked for at a time; with their length less than 1 << 20.
BLOCK = 1 << 19
#: Runs that one loser tree merges.
FAN_IN = 256

#: Bits of a key that hold a place within a block of strings.
_PLACE = np.uint64((1 << 20) - 1)
_TABLE = np.random.default_rng(4).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = np.random.default_rng(5).integers(0, 1 << 63, 8, np.uint64) * np.uint64(2) + np.uint64(1)


# ---- anchors -----------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, by doubling: 32 bytes and 8 bytes more."""
    h = {1: _TABLE[data]}
    for i in range(5):
        n = 1 << i
        h[2 * n] = h[n][:-n] * _STEPS[i] + h[n][n:]
        h[2 * n] ^= h[2 * n] >> np.uint64(29)
        if n != 8:
            del h[n]
    both = h[32][:len(data) - GRAM + 1] * _STEPS[6] + h[8][32:32 + len(data) - GRAM + 1]
    both ^= both >> np.uint64(32)
    both *= _STEPS[7]
    return both ^ (both >> np.uint64(29))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def _anchor_runs(data: np.ndarray, start: np.ndarray, length: int):
    """For strings that start at ``start`` (sorted): stretches of one anchor, as its place, its hash,
    and the first and last start."""
    hashes = gram_hashes(data)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    place = (sliding_least(keys, length - GRAM + 1)[start] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    return place[first], hashes[place[first]], start[first], start[last]


def anchors(data: np.ndarray, ends: np.ndarray, length: int, block: int = BLOCK):
    """Anchors of all strings of ``length`` bytes inside the documents that end at ``ends``.

    Place, hash, and how many bytes before and from the place on the strings of this anchor cover.
    Works through blocks of strings, so that a chunk's hashes are never all in memory.
    """
    inside = np.ones(max(0, len(data) - length + 1), bool)
    for end in ends[:-1]:                                    # strings that cross into the next document
        inside[max(0, end - length + 1):end] = False
    found = [[np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]]
    for at in range(0, len(inside), block):
        start = np.flatnonzero(inside[at:at + block])
        if len(start):
            place, hashes, first, last = _anchor_runs(data[at:at + block + length - 1], start, length)
            found.append([place + at, hashes, first + at, last + at])
    place, hashes, first, last = (np.concatenate(c) for c in zip(*found))
    # A stretch that a block's end cuts in two is one again.
    fresh = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][:len(place)])
    end = np.r_[fresh[1:], len(place)][:len(fresh)] - 1
    place = place[fresh]
    return place, hashes[fresh], place - first[fresh], last[end] + length - place


# ---- chunks ------------------------------------------------------------------------------

def _chunker(chunk_bytes: int):
    def chunk(batches):
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def packed():
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                ["chunk", "ids", "sizes", "data"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_buffer().to_pybytes()
                if texts and size + len(text) > chunk_bytes:
                    yield packed()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if texts:
            yield packed()
    return chunk


class Chunk:
    def __init__(self, ids, sizes, data, length: int):
        self.ids = np.array([i if i is not None else -1 << 63 for i in ids], np.int64)
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.bytes = zstandard.ZstdDecompressor().decompress(data)
        self.array = np.frombuffer(self.bytes, np.uint8)
        with np.errstate(over="ignore"):
            self.place, self.hash, self.before, self.after = anchors(self.array, self.ends, length)


def _chunks(batches, length: int, *columns: str):
    for batch in batches:
        for i in range(len(batch)):
            one = batch.slice(i, 1)
            values = [one[c][0].as_py() for c in ("chunk", "ids", "sizes", "data", *columns)]
            yield values[0], Chunk(*values[1:4], length), *values[4:]


def _rows(kind: pa.DataType, chunk: int, buckets, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int64()), pa.array([chunk] * len(data), pa.int64()), pa.array(data, kind)],
        ["bucket", "chunk", "data"])


# ---- which anchors occur again -----------------------------------------------------------

def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


#: Bytes of a hash that travel. Two anchors of one bucket that share them are taken for
#: recurring without need, and the merge finds them different.
SHORT = 5


def short(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT].tobytes()


def long(data: bytes, n: int) -> np.ndarray:
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :SHORT] = np.frombuffer(data, np.uint8, n * SHORT).reshape(n, SHORT)
    return whole.view("<u8")[:, 0]


def _hash_runs(buckets: int, length: int):
    """Per bucket the chunk's distinct hashes in order, and how often each occurs."""
    def runs(batches):
        for number, chunk in _chunks(batches, length):
            hashes, n = np.unique(chunk.hash, return_counts=True)
            bucket = _bucket(hashes, buckets)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            data, names = [], []
            for mine in np.split(np.arange(len(hashes)), cuts) if len(hashes) else []:
                names.append(int(bucket[mine[0]]))
                data.append(short(hashes[mine]) + np.minimum(n[mine], 255).astype(np.uint8).tobytes())
            yield _rows(pa.binary(), number, names, data)
    return runs


def _by_bucket(batches) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """The rows of one bucket after the other, of batches sorted by bucket."""
    bucket, rows = None, []
    for batch in batches:
        for b, chunk, data in zip(*(batch[c].to_pylist() for c in ("bucket", "chunk", "data"))):
            if b != bucket:
                if rows:
                    yield bucket, rows
                bucket, rows = b, []
            rows.append((chunk, data))
    if rows:
        yield bucket, rows


def _recurring(often: int):
    """To each chunk, for its hashes of the bucket: two bits, occurs again and occurs often."""
    def answer(batches):
        for bucket, rows in _by_bucket(batches):
            hashes = [long(d, len(d) // (SHORT + 1)) for _, d in rows]
            counts = [np.frombuffer(d, np.uint8, offset=len(h) * SHORT) for (_, d), h in zip(rows, hashes)]
            distinct, where = np.unique(np.concatenate(hashes), return_inverse=True)
            total = np.bincount(where, np.concatenate(counts))[where]
            at = 0
            for (chunk, _), h in zip(rows, hashes):
                mine = total[at:at + len(h)]
                at += len(h)
                bits = np.packbits(np.concatenate([mine > 1, mine >= often]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([bucket], pa.int64()),
                     pa.array([len(h)], pa.int64()), pa.array([bits.tobytes()], pa.binary())],
                    ["chunk", "bucket", "n", "data"])
    return answer


# ---- sorted runs -------------------------------------------------------------------------

def _suffixes(chunk: Chunk, place, before, after, width: int):
    """A row per anchor: the bytes from the anchor on, then those before it going back, then both numbers.

    Bytes that no string of the anchor covers are zero. Rows sort by what follows the anchor first.
    """
    reach = np.arange(width)
    right, left = place[:, None] + reach, place[:, None] - 1 - reach
    size = len(chunk.array)
    rows = np.zeros((len(place), 2 * width + 2), np.uint8)
    rows[:, :width] = np.where(reach < after[:, None], chunk.array[np.minimum(right, size - 1)], 0)
    rows[:, width:2 * width] = np.where(reach < before[:, None], chunk.array[np.maximum(left, 0)], 0)
    rows[:, -2], rows[:, -1] = after, before
    return rows


def front_coded(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """For sorted rows: how much each shares with the one before, and the bytes after that."""
    n, width = rows.shape
    shared = np.zeros(n, np.int64)
    differ = rows[1:] != rows[:-1]
    shared[1:] = np.where(differ.any(1), differ.argmax(1), width)
    return shared, rows[np.arange(width) >= shared[:, None]].tobytes()


def encode_run(rows: np.ndarray, ids: np.ndarray, places: np.ndarray) -> bytes:
    shared, rest = front_coded(rows)
    head = np.array([len(rows), rows.shape[1]], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(
        head + shared.astype("<u2").tobytes() + ids.astype("<i8").tobytes() + places.astype("<u4").tobytes() + rest)


def decode_run(data: bytes, chunk: int) -> Iterator[tuple[int, bytes, tuple]]:
    """Entries in order: what they share with the one before, the suffix, and (id, chunk, place)."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n, width = np.frombuffer(data, "<u4", 2).tolist()
    shared = np.frombuffer(data, "<u2", n, 8).tolist()
    ids = np.frombuffer(data, "<i8", n, 8 + 2 * n).tolist()
    places = np.frombuffer(data, "<u4", n, 8 + 10 * n).tolist()
    at, suffix = 8 + 14 * n, b""
    for same, doc_id, place in zip(shared, ids, places):
        suffix = suffix[:same] + data[at:at + width - same]
        at += width - same
        yield same, suffix, (doc_id, chunk, place)


def _split_often(place, before, after, length: int, gram: int):
    """Anchors of up to SPLIT strings each: the strings from d bytes before the place on, for each
    stretch of SPLIT values of d; the new place is where the stretch's last string starts."""
    found = []
    for low in range(0, length - gram + 1, SPLIT):
        high = low + SPLIT - 1
        # Strings from d before the place on exist for length - after <= d <= before.
        first, last = np.maximum(length - after, low), np.minimum(before, high)
        ok = first <= last
        found.append((place[ok] - low, last[ok] - low, length - first[ok] + low))
    return [np.concatenate(c) for c in zip(*found)]


def _suffix_runs(buckets: int, length: int):
    """Chunks with the answers -> front-coded runs for the buckets, and what the chunk itself removes.

    A row with a negative bucket holds removed stretches of its chunk; others hold a run of one kind
    (GRAM bytes shared, or all but those of a split anchor), named by the bucket's parity.
    """
    width = length
    core = length - SPLIT + 1

    def runs(batches):
        for number, chunk, answers in _chunks(batches, length, "answers"):
            again, often = np.zeros(len(chunk.hash), bool), np.zeros(len(chunk.hash), bool)
            hashes, where = np.unique(chunk.hash, return_inverse=True)
            marks = np.zeros((2, len(hashes)), bool)
            bucket = _bucket(hashes, buckets)
            for answer in answers or []:
                low = np.searchsorted(bucket, answer["bucket"])
                n = answer["n"]
                marks[:, low:low + n] = np.unpackbits(
                    np.frombuffer(answer["data"], np.uint8), count=2 * n).reshape(2, n)
            again, often = marks[0][where], marks[1][where]
            removed = []
            for kind, mine in ((0, again & ~often), (1, often)):
                place, before, after = (x[mine] for x in (chunk.place, chunk.before, chunk.after))
                if kind and len(place):
                    place, before, after = _split_often(place, before, after, length, GRAM)
                if not len(place):
                    continue
                for rows in _bucketed(chunk, place, before, after, kind, core, buckets, width, removed):
                    yield _rows(pa.binary(), number, *rows)
            yield _rows(pa.binary(), number, [-1 - number % buckets],
                        [np.concatenate(removed or [np.zeros(0, "<u4")]).astype("<u4").tobytes()])

    return runs


def _bucketed(chunk, place, before, after, kind, core, buckets, width, removed):
    shared = core if kind else GRAM
    names = np.empty(len(place), np.int64)
    for at in range(0, len(place), 8192):
        grams = chunk.array[place[at:at + 8192, None] + np.arange(shared)]
        names[at:at + 8192] = [xxhash.xxh3_64_intdigest(g.tobytes()) % buckets for g in grams]
    order = np.argsort(names, kind="stable")
    cuts = np.flatnonzero(np.diff(names[order])) + 1
    for mine in np.split(order, cuts):
        rows = _suffixes(chunk, place[mine], before[mine], after[mine], width)
        text = rows.view(f"S{rows.shape[1]}")[:, 0]
        ids = chunk.ids[np.searchsorted(chunk.ends, place[mine], "right")]
        sort = np.lexsort((place[mine], ids, text))
        rows, ids, at = rows[sort], ids[sort], mine[sort]
        fresh = np.r_[True, (rows[1:] != rows[:-1]).any(1)]
        later = at[~fresh]
        removed.append(np.stack([place[later] - before[later], place[later] + after[later]], 1).ravel())
        yield [int(names[mine[0]]) * 2 + kind], [encode_run(rows[fresh], ids[fresh], place[at[fresh]])]


# ---- the merge ---------------------------------------------------------------------------

class LoserTree:
    """Merges sorted runs of (shared with the one before, suffix, position).

    A node keeps the loser of its match: its suffix, and how much that shares with the last
    suffix that came out on top of the tree. Of two entries the one that shares more with
    that suffix is the smaller, without a look at the bytes; where both share the same, bytes are
    compared from there on. So no byte known to be shared is compared again.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        size = 1
        while size < len(runs):
            size *= 2
        self.size = size
        entries = [self._next(i, True) for i in range(size)]
        self.losers: list = [None] * size
        level = entries
        node = size
        while len(level) > 1:
            node //= 2
            winners = []
            for i in range(0, len(level), 2):
                winner, self.losers[node + i // 2] = self._play(level[i], level[i + 1])
                winners.append(winner)
            level = winners
        self.top = level[0]

    def _next(self, i: int, first: bool = False):
        """[shared with the last that came out, suffix, position, run], or None at the end."""
        entry = next(self.runs[i], None) if i < len(self.runs) else None
        return None if entry is None else [0 if first else entry[0], entry[1], entry[2], i]

    @staticmethod
    def _play(a, b):
        if a is None or b is None:
            return (b, a) if a is None else (a, b)
        if a[0] != b[0]:
            return (a, b) if a[0] > b[0] else (b, a)
        known = a[0]
        x, y = a[1][known:], b[1][known:]
        if x == y:
            winner, loser = (a, b) if a[2] <= b[2] else (b, a)
            loser[0] = len(loser[1])
            return winner, loser
        differ = int.from_bytes(x) ^ int.from_bytes(y)
        shared = known + len(x) - (differ.bit_length() + 7) // 8
        winner, loser = (a, b) if x < y else (b, a)
        loser[0] = shared
        return winner, loser

    def __iter__(self):
        while self.top is not None:
            shared, suffix, position, run = self.top
            yield shared, suffix, position
            entry, node = self._next(run), (self.size + run) // 2
            while node:
                entry, self.losers[node] = self._play(entry, self.losers[node])
                node //= 2
            self.top = entry


def merged(runs: list[Iterator]) -> Iterator:
    while len(runs) > FAN_IN:
        runs = [iter(LoserTree(runs[i:i + FAN_IN])) for i in range(0, len(runs), FAN_IN)]
    return iter(LoserTree(runs)) if runs else iter(())


def _later(group: list, length: int, width: int) -> Iterator[tuple[tuple, int, int]]:
    """Of entries that share their first bytes: (position, start, end) of strings that begin
    earlier elsewhere, as stretches relative to the anchor. Entries: (suffix, positions in order)."""
    if len(group) > 1:
        first: dict = {}
        covered = []
        for suffix, positions in group:
            after, before = suffix[-2], suffix[-1]
            back = suffix[width:width + before][::-1]
            whole, position = back + suffix[:after], positions[0]
            strings = [(before - d, whole[d:d + length]) for d in range(before + after - length + 1)]
            covered.append((position, strings))
            for s in strings:
                if s not in first or position < first[s]:
                    first[s] = position
        for position, strings in covered:
            low = None
            for d, s in strings:
                if first[d, s] != position:
                    if low is None:
                        low = d
                    high = d
                    continue
                if low is not None:
                    yield position, -low, length - high
                    low = None
            if low is not None:
                yield position, -low, length - high
    for suffix, positions in group:
        for position in positions[1:]:
            yield position, -suffix[-1], suffix[-2]


def _merger(length: int):
    core = length - SPLIT + 1

    def merge(batches):
        for bucket, rows in _by_bucket(batches):
            if bucket < 0:                           # stretches on their way to their chunks
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.binary())],
                    ["chunk", "removed"])
                continue
            found: dict[int, list] = defaultdict(list)

            def report(group):
                for (_, chunk, place), low, high in _later(group, length, length):
                    found[chunk].append((place + low, place + high))

            needed, group = (core if bucket % 2 else GRAM), []
            for shared, suffix, position in merged([decode_run(d, c) for c, d in rows]):
                if group and shared < needed:
                    if len(group) > 1 or len(group[0][1]) > 1:
                        report(group)
                    group = []
                if group and shared == len(suffix):
                    group[-1][1].append(position)
                else:
                    group.append((suffix, [position]))
            if group:
                report(group)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.int64()),
                     pa.array([np.array(v, "<u4").tobytes() for v in found.values()], pa.binary())],
                    ["chunk", "removed"])
    return merge


# ---- cutting -----------------------------------------------------------------------------

def _runs(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray):
    """Stretches of a chunk as maximal runs: number of the document, start, end. Runs end with their document."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order].astype(np.int64), np.maximum.accumulate(ends[order].astype(np.int64))
    document = np.searchsorted(bounds, starts, "right") - 1
    first = np.r_[True, (starts[1:] > ends[:-1]) | (document[1:] != document[:-1])][:len(starts)]
    last = np.r_[first[1:], True][:len(starts)]
    return document[first], starts[first], ends[last]


def _cutter(keep_text: bool):
    def cut(batches):
        for batch in batches:
            for i in range(len(batch)):
                ids, sizes, data, removed = (batch[c][i].as_py() for c in ("ids", "sizes", "data", "removed"))
                whole = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
                spans = np.concatenate([np.frombuffer(r, "<u4") for r in removed or []] or [np.zeros(0, "<u4")])
                bounds = np.r_[0, np.cumsum(sizes)].astype(np.int64)
                mine, starts, ends = _runs(spans[::2], spans[1::2], bounds)
                rows = []
                for k, (doc_id, size, first) in enumerate(zip(ids, sizes, bounds.tolist())):
                    low, high = np.searchsorted(mine, [k, k + 1])
                    edges = np.stack([starts[low:high], ends[low:high]], 1).ravel() - first
                    cuts = [0, *edges.tolist(), size]
                    kept = [whole[first + cuts[j]:first + cuts[j + 1]] for j in range(0, len(cuts), 2)]
                    digest = hashlib.sha256()
                    for piece in kept:
                        digest.update(piece)
                    rows.append((doc_id, size, size - sum(map(len, kept)), len(edges) // 2, digest.hexdigest(),
                                 b"".join(x.tobytes() for x in kept) if keep_text else None, edges.tolist()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])
    return cut


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
                    chunk_bytes: int = CHUNK_BYTES, often: int = OFTEN, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans.

    Removed is each byte covered by a string of ``length`` bytes (65 to 255) that also starts earlier: in a document
    of a smaller id, or earlier in the same one. ``kept`` are the other bytes, ``spans`` the
    removed stretches as start, end, start, end. Strings are judged on the input and never cross
    documents; a null text is an empty one. Rows without id come first; rows that share an id
    come in the order in which they are stored, as documents of their own. Other columns are ignored. A text longer
    than a chunk is a chunk of its own; cutting it takes memory for its bytes and its stretches.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    chunks = staged(source.mapInArrow(
        _chunker(chunk_bytes), "chunk long, ids array<long>, sizes array<long>, data binary"), "chunks")
    buckets = parts(docs)
    moved = "bucket long, chunk long, data binary"

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket").sortWithinPartitions("bucket")

    # One chunk makes much work, and files of several chunks may be read by one task.
    hashes = chunks.mapInArrow(_hash_runs(buckets, length), moved)
    answers = dealt(hashes).mapInArrow(_recurring(often), "chunk long, bucket long, n long, data binary")
    answered = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "data")).alias("answers"))
    runs = chunks.join(answered, "chunk", "left").mapInArrow(_suffix_runs(buckets, length), moved)
    removed = dealt(runs).mapInArrow(_merger(length), "chunk long, removed binary")
    by_chunk = removed.groupBy("chunk").agg(F.collect_list("removed").alias("removed"))
    return chunks.join(by_chunk, "chunk", "left").mapInArrow(
        _cutter(keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                            "kept binary, spans array<long>")
