"""Near duplicates among vectors by product quantisation.

An index of coarse cells holds a short code per vector: its residual from the cell's centre, cut into
parts and rounded to the nearest of 256 codewords each. A vector visits the few cells whose centres are nearest,
ranks their codes by table look-up, and computes the exact cosine for those that the codes' known
errors do not rule out. A pair is found if either vector visits the other's cell, and then counts for both.

Cells hold about equally many vectors at every size, so the work for a vector doesn't grow with their number. As many levels of
centres as that takes are laid over one another, each level the residuals of the one before. All of it is
fitted on a bounded sample, and all vectors are indexed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import components

#: Vectors the fit takes at most. Vectors of a cell on average; centres of a level at most.
SAMPLE_ROWS, MEMBERS, CENTRES = 25_000, 256, 256
#: Cells that a vector visits. Of vectors with a cosine of 0.95 or more 0.9 must be found; README has the share.
PROBES = 8
CODEWORDS, PART = 256, 8
#: Members or queries of a cell that meet in one task.
BLOCK = 4096
#: Room for rounding in single precision.
SLACK = 1e-3


def usable(vector: Column, vec_id: Column) -> Column:
    """Not null, not empty, all components finite, not all zero, and with an id."""
    def finite(x):
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf)
    found = (vec_id.isNotNull() & vector.isNotNull() & F.forall(vector, finite)
             & F.exists(vector, lambda x: x != 0))
    return F.coalesce(found, F.lit(False))


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    found = [np.argmin(distances2(x[i:i + 4096], centres), 1) for i in range(0, len(x), 4096)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def distances2(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T, 0)


class Index:
    """Levels of coarse centres and, for each part of the residual, its codewords."""

    def __init__(self, sample: np.ndarray, cells: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        depth = max(1, math.ceil(math.log(max(2, cells)) / math.log(CENTRES) - 1e-9))
        self.levels, rest = [], sample
        for _ in range(depth):
            centres = kmeans(rest, min(math.ceil(cells ** (1 / depth)), len(rest)), rng)
            rest = rest - centres[nearest(rest, centres)]
            self.levels.append(centres)
        self.parts = rest.shape[1] // PART
        self.words = [kmeans(rest[:, PART * p:PART * (p + 1)], min(CODEWORDS, len(rest)), rng, 5)
                      for p in range(self.parts)]

    def centre(self, cell: np.ndarray) -> np.ndarray:
        """Cells are numbered by their centres of all levels."""
        total = 0
        for centres in reversed(self.levels):
            total, cell = total + centres[cell % len(centres)], cell // len(centres)
        return total

    def encode(self, x: np.ndarray, cell: np.ndarray):
        """Codes, and each vector's distance from what its code stands for."""
        rest = (x - self.centre(cell)).astype(np.float32)
        codes = np.stack([nearest(rest[:, PART * p:PART * (p + 1)], w) for p, w in enumerate(self.words)], 1)
        stands = np.concatenate([w[codes[:, p]] for p, w in enumerate(self.words)], 1)
        return codes.astype(np.uint8), np.sqrt(((rest - stands) ** 2).sum(1))

    def probes(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` cells whose centres are nearest, nearest first; level by level only as many go on."""
        cell, rest = np.zeros((len(x), 1), np.int64), x[:, None, :]
        for centres in self.levels:
            d2 = distances2(rest.reshape(-1, x.shape[1]), centres).reshape(len(x), -1)
            best = np.argsort(d2, 1, kind="stable")[:, :n]
            before, here = best // len(centres), best % len(centres)
            cell = np.take_along_axis(cell, before, 1) * len(centres) + here
            rest = np.take_along_axis(rest, before[:, :, None], 1) - centres[here]
        return cell


def padded(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, filled up with zeros, and their lengths before that."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    x = np.zeros((len(lengths), width))
    x[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return unit(x), lengths


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _indexer(index: Index, width: int, probes: int):
    def assign(batches):
        for batch in batches:
            for at in range(0, len(batch), 1024):
                some = batch.slice(at, 1024)
                x = padded(some["vector"], width)[0].astype(np.float32)
                cells = index.probes(x, probes)
                codes, errors = index.encode(x, cells[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [some["rep"], some["copies"], some["vector"], pa.array(cells[:, 0]),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors.astype(np.float64)),
                     pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), cells.shape[1]).cast(
                         pa.list_(pa.int64()))],
                    ["rep", "copies", "vector", "own", "code", "error", "probes"])
    return assign


def _compare(index: Index, width: int, threshold: float):
    """Units of (cell, query block, member block): link counts of the queries, and of members that don't
    visit the query's cell in return; and links that keep all of the unit's linked vectors connected."""
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))

    def compared(cell: int, rows: dict):
        member = rows["member"]
        reps, copies, x, lengths, visits = (rows[c][member] for c in ("rep", "copies", "x", "length", "probes"))
        codes, limit = rows["code"][member], radius + rows["error"][member] + SLACK
        asked = np.flatnonzero(~member)
        links, counts = [], []
        returned = np.zeros(len(reps), np.int64)
        label = np.arange(len(reps) + len(asked))
        block = max(1, min(256, (1 << 20) // max(1, len(reps))))
        for at in range(0, len(asked), block):
            some = asked[at:at + block]
            q, mine = rows["x"][some], rows["rep"][some]
            rest = (q - index.centre(np.array([cell]))).astype(np.float32)
            d2 = np.zeros((len(some), len(reps)), np.float32)
            for p, words in enumerate(index.words):
                table = distances2(rest[:, PART * p:PART * (p + 1)], words)
                d2 += np.take(table, codes[:, p], axis=1)
            maybe = (np.sqrt(d2) <= limit) & (mine[:, None] != reps) & (rows["length"][some, None] == lengths)
            i, j = np.nonzero(maybe)
            sure = np.zeros_like(maybe)
            for some_of in range(0, len(i), 1 << 15):
                at_i, at_j = i[some_of:some_of + (1 << 15)], j[some_of:some_of + (1 << 15)]
                sure[at_i, at_j] = np.einsum("ij,ij->i", q[at_i], x[at_j]) >= threshold
            i, j = np.nonzero(sure)
            alone = (visits[j] != rows["own"][some][i, None]).all(1)
            np.add.at(returned, j[alone], rows["copies"][some][i[alone]])
            linked = sure @ copies
            for k in np.flatnonzero(linked):
                counts.append((int(mine[k]), int(linked[k])))
                # A link for every label that this query joins to its own.
                found, me = np.flatnonzero(sure[k]), len(reps) + at + k
                seen, firsts = np.unique(label[found], return_index=True)
                links += [(int(mine[k]), int(reps[found[f]])) for f in firsts]
                lowest = min(int(seen[0]), int(label[me]))
                if len(seen) > 1:
                    label[np.isin(label, seen)] = lowest
                label[me] = lowest
        counts += [(int(reps[j]), int(returned[j])) for j in np.flatnonzero(returned)]
        return counts, links

    def compare(batches):
        def emit(cell, pieces):
            rows = {c: np.concatenate([p[c] for p in pieces]) for c in pieces[0]}
            counts, links = compared(cell, rows)
            if counts:
                a = [c[0] for c in counts] + [l[0] for l in links]
                b = [None] * len(counts) + [l[1] for l in links]
                n = [c[1] for c in counts] + [None] * len(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])

        key, pieces = None, []
        for batch in batches:
            x, lengths = padded(batch["vector"], width)
            member = batch["code"].is_valid().to_numpy(zero_copy_only=False)
            codes = np.zeros((len(batch), index.parts), np.uint8)
            codes[member] = np.frombuffer(b"".join(batch["code"].drop_null().to_pylist()), np.uint8).reshape(
                -1, index.parts)
            visits = batch["probes"].flatten().to_numpy().reshape(len(batch), -1)
            rows = {"x": x, "length": lengths, "member": member, "code": codes,
                    "error": batch["error"].fill_null(0).to_numpy(zero_copy_only=False),
                    "rep": batch["rep"].to_numpy(), "copies": batch["copies"].to_numpy(),
                    "own": batch["own"].to_numpy(), "probes": visits}
            keys = np.stack([batch[c].to_numpy() for c in ("cell", "qb", "mb")], 1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(batch)]):
                if stop > start:
                    if pieces and tuple(keys[start]) != key:
                        yield from emit(int(key[0]), pieces)
                        pieces = []
                    key = tuple(keys[start])
                    pieces.append({c: v[start:stop] for c, v in rows.items()})
        if pieces:
            yield from emit(int(key[0]), pieces)
    return compare


def linked_vectors(table: DataFrame, threshold: float = 0.95, vector: str = "embedding",
                   vec_id: str = "vec_id", cells: int | None = None, probes: int = PROBES,
                   sample_rows: int = SAMPLE_ROWS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id, kept.

    Vectors link when their cosine in double precision is at least ``threshold`` (above 0) and they have
    equally many components. Copies of a vector are indexed once and count as many times as
    they occur. A vector that is null, empty, zero or has a component that is null or not finite
    links with nothing, as does a row without id (its component is null, and it is kept). Rows that
    share an id are one vertex. An empty table gives no rows.

    No pair below the threshold is linked. Of those above it one is missed where neither vector's ``probes``
    nearest cells hold the other.
    """
    v, i = F.col(vector), F.col(vec_id)
    # Single precision travels as such; all arithmetic on it is in double precision.
    single = table.schema[vector].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    ok = usable(v, i)
    name = F.sha2(F.array_join(F.transform(v, lambda x: x.cast("string")), ","), 256)
    rows = staged(table.select(i.cast("long").alias("vec_id"), F.when(ok, name).alias("name"),
                               F.when(ok, v.cast(kind)).alias("vector")), "vectors")
    distinct = staged(rows.filter("name is not null").groupBy("name").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")),
        "distinct-vectors")
    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    everyone = rows.join(distinct.select("name", "rep", "copies"), "name", "left")
    if not size["n"]:
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                               F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    width = -(-size["width"] // PART) * PART
    cells = cells or -(-size["n"] // MEMBERS)
    chance = sample_rows / size["n"]
    sample = distinct.select("rep", "vector")
    if chance < 1:
        sample = sample.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < chance * (1 << 20))
    sample = sorted(sample.collect())
    vectors = pa.array([r["vector"] for r in sample], pa.list_(pa.float64()))
    index = Index(padded(vectors, width)[0].astype(np.float32), cells)
    indexed = staged(distinct.drop("name").mapInArrow(
        _indexer(index, width, probes),
        f"rep long, copies long, vector {kind}, own long, code binary, error double, "
        "probes array<long>"), "indexed-vectors")

    # Large cells are dealt into blocks of members and of visitors.
    members = indexed.groupBy(F.col("own").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / block).alias("mbs"))
    visits = indexed.select(F.explode("probes").alias("cell")).groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / block).alias("qbs"))
    sizes = staged(members.join(visits, "cell"), "cell-sizes")

    def dealt(own, many):
        return F.pmod(F.xxhash64("rep", F.lit(own)), F.col(many))

    def every(many):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1))

    columns = ["cell", "qb", "mb", "rep", "copies", "vector", "own", "probes"]
    stored = (indexed.join(sizes, F.col("own") == F.col("cell"))
              .withColumn("mb", dealt(1, "mbs")).withColumn("qb", every("qbs")).select(*columns, "code", "error"))
    asked = (indexed.withColumn("cell", F.explode("probes")).join(sizes, "cell")
             .withColumn("qb", dealt(2, "qbs")).withColumn("mb", every("mbs"))
             .select(*columns, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("error")))
    units = stored.union(asked).repartition("cell", "qb", "mb").sortWithinPartitions("cell", "qb", "mb")
    found = staged(units.mapInArrow(_compare(index, width, threshold), "a long, b long, n long"), "vector-links")

    counts = found.filter("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    labels = components(found.filter("b is not null").select("a", "b"))
    joined = (everyone.join(counts, "rep", "left")
              .join(labels.withColumnRenamed("id", "rep"), "rep", "left"))
    component = F.coalesce("component", "rep", "vec_id")
    return joined.select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
