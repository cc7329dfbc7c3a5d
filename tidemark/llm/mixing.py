"""Mixing sources to target weights, by blocks of tokens.

The words of each source, in a fixed pseudorandom order of its documents, are cut into blocks of
equal length, shorter ones where a source is to give few words. For every output shard the number of blocks from each source is drawn; a slot's running
number within its source goes through the source's pseudorandom permutation of block numbers, and
the block of that number fills the slot. When the running number passes the last block, a new
permutation begins, so each block is taken equally often, give or take one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_total, staged

#: Words of a block at most, blocks of an output shard.
BLOCK, SHARD_BLOCKS = 128, 4096
#: Blocks that a source's target comes to at least, unless a block is a word: half a block is all that rounding costs.
LEAST_BLOCKS = 200
#: Weights of the sources in order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Slots from which numpy's hypergeometric sampler refuses; slots that are drawn one by one.
SAMPLER_LIMIT, SINGLY = 10 ** 9, 64


def word_count(text: Column) -> Column:
    """Words between white space; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.translate(trimmed, " \t\n\x0b\x0c\r", "")).cast("long")


def targets(sizes: list[int], weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words for each source: ``share`` of all by weight, none above ``most`` times its size.

    What a source can't take is shared anew among the rest by weight, until none is above.
    """
    result, free = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    weight = {i: weights[i % len(weights)] for i in range(len(sizes))}
    left = share * sum(sizes)
    while free:
        unit = left / sum(weight[i] for i in free)
        over = [i for i in free if unit * weight[i] > most * sizes[i]]
        if not over:
            for i in free:
                result[i] = unit * weight[i]
            break
        for i in over:
            result[i] = most * sizes[i]
            left -= result[i]
        free = [i for i in free if i not in over]
    return result


# ---- draws -------------------------------------------------------------------------------

def _split(rng: np.random.Generator, totals: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` slots each source gets, out of slots with these totals.

    A multinomial draw under the condition that the totals of all shards come out (the
    multivariate hypergeometric law). For counts too large for numpy's sampler, every slot is taken
    by chance, and as many as are then too many or too few, about the root of ``n``, are drawn likewise
    from the taken or the others; the law is the same.
    """
    total = int(totals.sum())
    if total < SAMPLER_LIMIT:
        return rng.multivariate_hypergeometric(totals, n, method="marginals")
    if n <= SINGLY:
        left = totals.copy()
        for _ in range(n):
            ends = left.cumsum()
            left[np.searchsorted(ends, rng.integers(ends[-1]), "right")] -= 1
        return totals - left
    part = rng.binomial(totals, n / total)
    over = int(part.sum()) - n
    if over > 0:
        return part - _split(rng, part, over)
    return part + _split(rng, totals - part, -over)


def draw(shard: int, shards: int, totals: np.ndarray, per_shard: int, seed: int):
    """Counts of each source in one output shard, and how many the shards before it took.

    Halves the shards again and again: each halving draws what the left half gets, from a
    generator seeded by that half's place, so all tasks see the same draws and none needs
    another's.
    """
    low, high = 0, shards
    before, here = np.zeros(len(totals), np.int64), totals.astype(np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        slots = min(int(here.sum()), (middle - low) * per_shard)
        left = _split(np.random.default_rng([seed, low, high]), here, slots)
        if shard < middle:
            high, here = middle, left
        else:
            low, before, here = middle, before + left, here - left
    return here, before


def permuted(index: np.ndarray, n: int, key: np.ndarray | int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key: a Feistel network of four rounds over the
    next power of four, walked until the value is below ``n``."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x = index.astype(np.uint64)
    key = np.broadcast_to(np.asarray(key, np.uint64), x.shape)
    todo = np.arange(len(x))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right, k = x[todo] >> np.uint64(half), x[todo] & mask, key[todo]
            for round_ in range(4):
                f = (right + k + np.uint64(round_ * 0x632BE5AB)) * np.uint64(0x9E3779B97F4A7C15)
                f ^= f >> np.uint64(29)
                f *= np.uint64(0xBF58476D1CE4E5B9)
                f ^= f >> np.uint64(32)
                left, right = right, left ^ (f & mask)
            x[todo] = (left << np.uint64(half)) | right
            todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def _slots(totals: list[int], blocks: list[int], shards: int, per_shard: int, seed: int):
    """Output shard numbers -> their slots: shard, slot, source number, draw, block."""
    def slots(batches):
        taken, there = np.array(totals, np.int64), blocks
        for batch in batches:
            for shard in batch["shard"].to_pylist():
                count, before = draw(shard, shards, taken, per_shard, seed)
                label = np.repeat(np.arange(len(there)), count)
                number = np.concatenate([np.arange(b, b + c) for b, c in zip(before, count)] or [[]])
                number = number.astype(np.int64)
                block, epoch = np.zeros_like(number), np.zeros_like(number)
                for s, n in enumerate(there):
                    mine = label == s
                    if mine.any():
                        epoch[mine] = number[mine] // n
                        block[mine] = permuted(number[mine] % n, n, epoch[mine] * 65_537 + s * 31 + seed)
                order = np.random.default_rng([seed, shard, 1]).permutation(len(label))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(label), shard), pa.int64()),
                     pa.array(np.arange(len(label)), pa.int64()), pa.array(label[order], pa.int64()),
                     pa.array(epoch[order], pa.int64()), pa.array(block[order], pa.int64())],
                    ["shard", "slot", "source_no", "epoch", "block"])
    return slots


# ---- the mix -----------------------------------------------------------------------------

class Mix:
    """``documents``: one row per document with its place in its source and the source's target;
    ``spans``: one row per stretch of a document that a slot of the output takes."""

    def __init__(self, documents: DataFrame, spans: DataFrame):
        self.documents, self.spans = documents, spans


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0,
        block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = 0, text: str = "text",
        doc_id: str = "doc_id", source: str = "source", key: Column | None = None) -> Mix:
    """Plan the mix of all documents.

    ``documents``: key (of the row), doc_id, size, source_size, target, begin. ``spans``: shard, slot,
    key, epoch (0 for the first time a block is taken), first (word of the document), words.
    ``key`` names the rows; by default they are numbered here.

    Sources are ordered by code point, null last, a source of its own; the number of sources
    must fit the driver. Documents without words belong to their source and are never
    taken. Rows that repeat an id are documents of their own. An empty table gives an empty mix.
    """
    sized = staged(docs.select(
        (F.monotonically_increasing_id() if key is None else key).alias("key"),
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(doc_id), F.col(text), F.lit(seed)).alias("tie")), "mix-sizes")
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in found]
    wanted = targets(sizes, weights, share, most)
    words = [max(1, min(block, int(w) // LEAST_BLOCKS)) for w in wanted]
    blocks = [-(-s // n) for s, n in zip(sizes, words)]
    taken = [min(int(most * n), round(w * n / s)) if s else 0 for w, n, s in zip(wanted, blocks, sizes)]
    shards = max(1, -(-sum(taken) // shard_blocks))

    spark = docs.sparkSession
    sources = spark.createDataFrame(
        [(i, r["source"], r["size"], w, n) for i, (r, w, n) in enumerate(zip(found, wanted, words))],
        "source_no long, name string, source_size long, target double, block_words long")
    known = sized.join(sources, sized["source"].eqNullSafe(sources["name"])).drop("name")
    placed = running_total(known, ["source_no"], ["tie"], F.col("size"), "begin")
    documents = staged(placed.drop("tie"), "mix-places")

    slots = spark.range(0, shards, 1, min(shards, 10_000)).select(F.col("id").alias("shard")).mapInArrow(
        _slots(taken, blocks, shards, shard_blocks, seed),
        "shard long, slot long, source_no long, epoch long, block long")
    first, last = F.expr("begin div block_words"), F.expr("(begin + size - 1) div block_words")
    pieces = documents.filter("size > 0").select(
        "source_no", "key", "begin", "size", "block_words", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest("begin", F.col("block") * F.col("block_words"))
    high = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * F.col("block_words"))
    # Spark takes the slots for as small as the range they are made from; both sides are large.
    spans = slots.hint("merge").join(pieces, ["source_no", "block"]).select(
        "shard", "slot", "key", "epoch", (low - F.col("begin")).alias("first"), (high - low).alias("words"))
    return Mix(documents, spans)


def taken_words(mixed: Mix) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (repeats counted)."""
    taken = mixed.spans.groupBy("key").agg(F.sum("words").alias("taken"))
    return mixed.documents.join(taken, "key", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def _cut(schema_names: list[str], text_at: int):
    import re
    word = re.compile(r"[^\x20\x09-\x0D]+")

    def cut(batches):
        for batch in batches:
            texts = []
            for text, spans in zip(batch["row"].field(text_at).to_pylist(), batch["spans"].to_pylist()):
                ends = [m.span() for m in word.finditer(text)]
                spans = sorted((s["first"], s["words"]) for s in spans)
                runs = []
                for first, n in spans:
                    if runs and runs[-1][1] == first:
                        runs[-1][1] = first + n
                    else:
                        runs.append([first, first + n])
                texts.append("\n".join(text[ends[a][0]:ends[b - 1][1]] for a, b in runs))
            columns = batch["row"].flatten()
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, schema_names)
    return cut


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix as documents: for each document and each time its blocks come round, the words taken.

    A document taken whole keeps its text but for white space at its ends; of one taken in part, the stretches
    taken follow one another on lines of their own. All columns are those of ``docs``; repeats
    give several rows with one id.
    """
    stored = staged(docs.select(F.monotonically_increasing_id().alias("key"),
                                F.struct(*[F.col(c) for c in docs.columns]).alias("row")), "mix-rows")
    columns = docs.columns
    # Names of the struct's fields can't clash with the key, nor with columns made on the way.
    mixed = mix(stored.select("row.*", F.col("key").alias("\u0000key")), text=text,
                key=F.col("\u0000key"), **options)
    spans = mixed.spans.groupBy("key", "epoch").agg(
        F.collect_list(F.struct("first", "words")).alias("spans"))
    joined = stored.join(spans, "key").select("row", "spans")
    return joined.mapInArrow(_cut(columns, columns.index(text)), docs.schema)
