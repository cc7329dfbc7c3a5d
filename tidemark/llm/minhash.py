"""Near duplicates by MinHash, with odd sketches to verify candidates.

Documents that agree in a band of MinHash samples are candidates. All samples of a document are also folded
into a bitmap that keeps, for each bit, the parity of the samples that fall on it; the bits in which
two bitmaps differ estimate how many samples differ, and most precisely where few do. Candidates
whose estimate is far below the threshold go; the rest are compared on their full sets.

No pairs of candidates are written out. Documents of equal words are one. Each document first meets one
hub, that of its largest bucket; what is linked is one component from then on. In buckets that still hold several
components, members and visitors meet in units that bring their bitmaps and full sets along; there
they are judged, compared and joined, and only links that join two components of a unit leave it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import components

WORDS, BANDS, BAND_ROWS, SAMPLES, BITS = 5, 32, 4, 1024, 4096
#: The estimate's standard deviation near the threshold is 0.017; five of them are given.
MARGIN = 0.085
HUB_ROUNDS = 2
#: Members of a bucket that meet in one task with those to be compared with them, and their shingles in all.
BLOCK, BLOCK_SHINGLES = 4096, 1 << 21
#: Members outside the hub's component that pass by a block in one task, not all in memory at once.
VISITORS = 4 * BLOCK

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A to Z) words between white space."""
    return (text or "").encode().translate(_LOWER).split()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < 400_000 and len(word) < 64:
            self[word] = h
        return h


def shingle_set(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than a shingle are one."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(words))
    folded = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        folded = folded * _STEP + h[i:len(h) - n + 1 + i]
    return np.unique(_mixed(folded))


_DRAWS = np.random.default_rng(20_11)
MULTIPLY = _DRAWS.integers(0, 1 << 32, SAMPLES, np.uint32) | np.uint32(1)
ADD = _DRAWS.integers(0, 1 << 32, SAMPLES, np.uint32)


def samples_of(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions, all permutations of 32-bit numbers."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), 512):
        least = np.minimum(least, (short[at:at + 512, None] * MULTIPLY + ADD).min(0))
    return least


def band_hashes(samples: np.ndarray) -> np.ndarray:
    """For rows of samples a hash of each band."""
    rows = samples[:, :BANDS * BAND_ROWS].astype(np.uint64).reshape(-1, BANDS, BAND_ROWS)
    folded = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(rows), 1))
    for i in range(BAND_ROWS):
        folded = _mixed(folded * _STEP + rows[:, :, i])
    return folded.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """For rows of samples their parity bitmaps, as 64-bit words."""
    bits = _mixed(samples.astype(np.uint64) + np.arange(SAMPLES, dtype=np.uint64) * _STEP) % np.uint64(BITS)
    cells = bits.astype(np.int64) + np.arange(len(samples))[:, None] * BITS
    parity = (np.bincount(cells.ravel(), minlength=BITS * len(samples)) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(-1, BITS), axis=1).view(np.int64)


def differing_bits(similarity: float) -> int:
    """Bits in which the bitmaps of two sets of this similarity differ on average."""
    differ = 2 * SAMPLES * (1 - similarity)
    return round(BITS / 2 * (1 - math.exp(-2 * differ / BITS)))


def _signer(batches):
    hashes = WordHashes()
    with np.errstate(over="ignore"):
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                keys, sizes, samples = [], [], []
                for text in some["text"].to_pylist():
                    words = words_of(text)
                    shingles = shingle_set(words, hashes)
                    keys.append(hashlib.sha256(b" ".join(words)).digest())
                    sizes.append(len(shingles))
                    samples.append(samples_of(shingles))
                samples = np.stack(samples)
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                     _lists(band_hashes(samples)), _lists(odd_sketches(samples))],
                    ["doc_id", "key", "n_shingles", "bands", "sketch"])


def _lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).ravel())
    return pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(pa.list_(pa.int64()))


def _set_maker(batches):
    hashes = WordHashes()
    with np.errstate(over="ignore"):
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                words = [words_of(t) for t in some["text"].to_pylist()]
                sets = [shingle_set(w, hashes).view(np.int64) for w in words]
                keys = [hashlib.sha256(b" ".join(w)).digest() for w in words]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), some["doc_id"], pa.array(sets, pa.list_(pa.int64()))],
                    ["key", "rep", "shingles"])


class _Judge:
    """Whether sets link: by size, by bitmap, and then by the full sets."""

    def __init__(self, percent: int):
        self.percent, self.limit = percent, differing_bits(percent / 100 - MARGIN)

    def near(self, sizes: np.ndarray, sketches: np.ndarray, size: int, sketch: np.ndarray) -> np.ndarray:
        small, large = np.minimum(sizes, size), np.maximum(sizes, size)
        apart = np.zeros(len(sizes), np.int64)
        for word in range(len(sketch)):
            apart += np.bitwise_count(sketches[:, word] ^ sketch[word])
        return (apart <= self.limit) & (small * 100 >= large * self.percent)

    def links(self, both: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
        return 100 * both >= self.percent * (sizes + size - both)


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]) -> dict:
    rows = {c: batch[c].to_numpy(zero_copy_only=False) for c in ("rep", "n_shingles", *names)}
    rows["sketch"] = batch["sketch"].flatten().to_numpy().view(np.uint64).reshape(len(batch), -1)
    rows["bands"] = batch["bands"].flatten().to_numpy().reshape(len(batch), -1)
    sets = batch["shingles"]
    flat, ends = sets.flatten().to_numpy(), np.r_[0, np.cumsum(sets.value_lengths().to_numpy())]
    rows["set"] = np.empty(len(batch), object)
    for i in range(len(batch)):
        rows["set"][i] = flat[ends[i]:ends[i + 1]]
    return rows


def _stretches(batches, key: tuple[str, ...], first: str, names: tuple[str, ...]):
    """Sorted rows -> (key, whether these are the unit's own, rows), cut where either changes."""
    for batch in batches:
        rows = _columns(batch, names)
        keys = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in (*key, first)], 1)
        cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(batch)]):
            if stop > start:
                yield (tuple(keys[start, :-1].tolist()), bool(keys[start, -1]),
                       {c: v[start:stop] for c, v in rows.items()})


def _pairs(found: list[tuple[int, int]]):
    if found:
        a, b = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _hub_compared(judge: _Judge) -> Callable:
    """Rows of (hub, block), the hub itself first -> links with it. Only the hub is kept."""
    def run(batches):
        hub = None
        for key, is_hub, rows in _stretches(batches, ("hub", "mb"), "first", ()):
            if is_hub:
                hub = {c: v[0] for c, v in rows.items()}
                continue
            near = judge.near(rows["n_shingles"], rows["sketch"], hub["n_shingles"], hub["sketch"])
            found = []
            for i in np.flatnonzero(near):
                both = len(np.intersect1d(rows["set"][i], hub["set"], assume_unique=True))
                if judge.links(both, rows["n_shingles"][i], hub["n_shingles"]):
                    found.append((int(hub["rep"]), int(rows["rep"][i])))
            yield from _pairs(found)
    return run


class _Unit:
    """A block of a bucket's members, by whom visitors pass; and which of all these are connected."""

    def __init__(self, judge: _Judge, bucket: int, pieces: list[dict]):
        self.judge, self.bucket = judge, bucket
        self.own = {c: np.concatenate([p[c] for p in pieces]) for c in pieces[0]}
        self.numbers: dict[int, int] = {}
        self.label = np.array([self._number(c) for c in self.own["component"]], np.int64)
        self.merged: dict[int, int] = {}
        # For each shingle that some member has, these members.
        flat = np.concatenate(self.own["set"])
        order = np.argsort(flat, kind="stable")
        member = np.repeat(np.arange(len(self.own["rep"])), [len(x) for x in self.own["set"]])[order]
        self.shingles, self.starts = np.unique(flat[order], return_index=True)
        self.ends, self.members = np.r_[self.starts[1:], len(flat)], member

    def _number(self, component: int) -> int:
        return self.numbers.setdefault(int(component), len(self.numbers))

    def _root(self, label: int) -> int:
        while label in self.merged:
            label = self.merged[label]
        return label

    def shared(self, shingles: np.ndarray) -> np.ndarray:
        """How many shingles each member has of these."""
        at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
        at = at[self.shingles[at] == shingles]
        starts, n = self.starts[at], self.ends[at] - self.starts[at]
        places = np.arange(n.sum()) + np.repeat(starts - np.r_[0, np.cumsum(n)[:-1]], n)
        return np.bincount(self.members[places], minlength=len(self.own["rep"]))

    def visit(self, rows: dict, i: int):
        """Links that join this visitor's component with others. A pair is judged in the first band in which both
        agree, and in no other bucket."""
        own, judge = self.own, self.judge
        mine = self._root(self._number(rows["component"][i]))
        found = np.flatnonzero(self.label != mine)
        if not len(found):
            return
        found = found[judge.near(own["n_shingles"][found], own["sketch"][found], rows["n_shingles"][i], rows["sketch"][i])]
        bands = rows["bands"][i]
        found = found[bands[(own["bands"][found] == bands).argmax(1)] == self.bucket]
        if not len(found):
            return
        both = self.shared(rows["set"][i])[found]
        linked = found[judge.links(both, own["n_shingles"][found], rows["n_shingles"][i])]
        for label, first in zip(*np.unique(self.label[linked], return_index=True)):
            yield int(rows["rep"][i]), int(own["rep"][linked[first]])
            self.merged[int(label)] = mine
            self.label[self.label == label] = mine


def _swept(judge: _Judge) -> Callable:
    """Rows of units (bucket, query block, member block), members first -> links that join components.

    Visitors, which are not of the hub's component, are compared with the block's own members that
    they aren't connected with yet. Only the own members are kept; visitors pass by.
    """
    def run(batches):
        def ask(rows):
            yield from _pairs([link for i in np.flatnonzero(rows["asks"]) for link in unit.visit(rows, i)])

        key, pieces, unit = None, [], None
        for at, is_own, rows in _stretches(batches, ("bucket", "qb", "mb"), "own", ("component", "asks")):
            if at != key:
                if pieces:
                    unit = _Unit(judge, key[0], pieces)
                    yield from ask(unit.own)
                key, pieces, unit = at, [], None
            if is_own:
                pieces.append(rows)
                continue
            if pieces:
                unit, pieces = _Unit(judge, key[0], pieces), []
                yield from ask(unit.own)
            if unit:
                yield from ask(rows)
        if pieces:
            unit = _Unit(judge, key[0], pieces)
            yield from ask(unit.own)
    return run


class _Linker:
    """Links between representatives, found round by round.

    ``shared``: rep, bucket, n_shingles for buckets of several; ``sets``: rep, n_shingles, bands, sketch, shingles.
    """

    def __init__(self, shared: DataFrame, sets: DataFrame, percent: int):
        self.shared, self.sets, self.judge = shared, sets, _Judge(percent)
        self.found: DataFrame | None = None
        self.labels: DataFrame | None = None

    def members(self) -> DataFrame:
        """The shared buckets' rows with the component each representative has so far."""
        if self.labels is None:
            return self.shared.withColumn("component", F.col("rep"))
        return (self.shared.join(self.labels.withColumnRenamed("id", "rep"), "rep", "left")
                .withColumn("component", F.coalesce("component", "rep")))

    def hubs(self, members: DataFrame, seed: int) -> DataFrame:
        """For buckets of several components: a member chosen by hash, with the number of its component's
        members there; the number of all, and of their shingles."""
        order = F.struct(F.xxhash64("rep", F.lit(seed)).alias("order"), "rep")
        parts = members.groupBy("bucket", "component").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"),
                                                           F.sum("n_shingles").alias("weight"))
        return (parts.groupBy("bucket").agg(
            F.min(F.struct("first.order", "first.rep", "component", "n")).alias("hub"), F.sum("n").alias("n"),
            F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("several"))
            .filter("several > 1").select("bucket", "hub", "n", "weight"))

    def hub_links(self, seed: int) -> DataFrame:
        """Each representative is compared with one hub, that of the largest bucket where they aren't connected."""
        members = self.members()
        asked = staged(members.join(self.hubs(members, seed), "bucket").filter("component <> hub.component").groupBy("rep").agg(
            F.max_by("hub.rep", F.struct("n", "hub.order")).alias("hub")), "hubs")
        blocks = asked.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("mbs"))
        dealt = asked.join(blocks, "hub").select(
            "hub", F.pmod(F.xxhash64("rep"), F.col("mbs")).alias("mb"), "rep", F.lit(False).alias("first"))
        hubs = blocks.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mbs") - 1)).alias("mb"),
                             F.col("hub").alias("rep"), F.lit(True).alias("first"))
        rows = dealt.union(hubs).join(self.sets, "rep")
        return rows.repartition("hub", "mb").sortWithinPartitions("hub", "mb", F.desc("first")).mapInArrow(
            _hub_compared(self.judge), "a long, b long")

    def units(self, seed: int) -> DataFrame:
        """Rows of units: members are dealt into blocks, and those outside the hub's component into blocks
        of visitors; each block of visitors meets each block of members in a unit of its own."""
        members = self.members()
        joined = members.join(self.hubs(members, seed), "bucket")
        asks = F.col("component") != F.col("hub.component")
        mbs = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("long")
        qbs = F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("hub.n")) / VISITORS)).cast("long")
        dealt = joined.withColumns({"mbs": mbs, "qbs": qbs}).withColumns({
            "_mb": F.pmod(F.xxhash64("rep", F.lit(1)), F.col("mbs")),
            "_qb": F.when(asks, F.pmod(F.xxhash64("rep", F.lit(2)), F.col("qbs"))).otherwise(F.lit(-1))})
        every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("qbs") - 1),
                            lambda q: F.struct(q.alias("qb"), F.col("_mb").alias("mb")))
        visits = F.filter(F.sequence(F.lit(0).cast("long"), F.col("mbs") - 1), lambda m: m != F.col("_mb"))
        visits = F.transform(visits, lambda m: F.struct(F.col("_qb").alias("qb"), m.alias("mb")))
        return dealt.withColumn("unit", F.explode(
            F.when(F.col("_qb") < 0, every).otherwise(F.concat(every, visits)))).select(
            "bucket", "unit.qb", "unit.mb", "rep", "component", (F.col("unit.mb") == F.col("_mb")).alias("own"),
            (F.col("unit.qb") == F.col("_qb")).alias("asks"))

    def swept_links(self, seed: int) -> DataFrame:
        rows = self.units(seed).join(self.sets, "rep")
        return rows.repartition("bucket", "qb", "mb").sortWithinPartitions(
            "bucket", "qb", "mb", F.desc("own")).mapInArrow(_swept(self.judge), "a long, b long")

    def add(self, links: DataFrame, label: str) -> None:
        """Go on from new links and the components they make."""
        links = staged(links, label)
        if links.limit(1).count():
            self.found = links if self.found is None else self.found.union(links)
            self.labels = components(self.found)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 75,
                    hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents link when their sets of 5-word shingles agree in at least ``percent`` percent of the
    union. A component is named by its smallest id, and that document is kept. Documents without
    words link with nothing, each a component of its own. So do rows without an id: their
    component is null and they are kept. Rows that share an id are one vertex.

    Candidates that agree in a band are missed with probability (1 - s^4)^32 at similarity s: one in
    190,000 at 0.75, and less above.

    Texts may be of any length: a text's words and set are in memory while it is read, and a unit's blocks follow the
    sizes of their sets. Equal words are one vertex for all comparisons, however many rows have them. Other
    columns, whatever their names, are ignored. An empty table gives no rows.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = staged(source.mapInArrow(
        _signer, "doc_id long, key binary, n_shingles long, bands array<long>, sketch array<long>"), "signatures")
    reps = staged(signed.filter("n_shingles > 0 and doc_id is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "representatives")
    banded = reps.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    several = banded.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter(
        "low < high").select("bucket")
    shared = staged(banded.join(several, "bucket").groupBy("rep", "bucket").agg(
        F.max("n_shingles").alias("n_shingles")), "shared-buckets")
    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    # Rows that share an id but not their words have a set each; repeated rows have one.
    sets = source.join(wanted, "doc_id", "left_semi").mapInArrow(
        _set_maker, "key binary, rep long, shingles array<long>").groupBy("key", "rep").agg(
        F.first("shingles").alias("shingles"))
    wide = staged(sets.join(reps, ["key", "rep"]).drop("key"), "shingle-sets")

    linker = _Linker(shared, wide, percent)
    for seed in range(hub_rounds):
        linker.add(linker.hub_links(seed), "hub-links")
    linker.add(linker.swept_links(hub_rounds), "swept-links")

    named = signed.select("doc_id", "key", "n_shingles").join(reps.select("key", "rep"), "key", "left")
    if linker.labels is None:
        labelled = named.withColumn("component", F.col("rep"))
    else:
        labelled = named.join(linker.labels.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return labelled.select("doc_id", "n_shingles", component.alias("component_id"),
                           F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 75) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``near_duplicates`` keeps."""
    gone = near_duplicates(docs, text, doc_id, percent).filter("not kept").select(
        F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
