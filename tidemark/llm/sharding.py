"""Two-pass external shuffle of documents into shards.

The first pass scatters the rows into buckets by a seeded hash; a bucket fits a task's memory. The
second pass shuffles each bucket by Fisher and Yates's method and writes it. One bucket after the other
is then a random order of all rows, and the shards are equal stretches of that order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Rows and bytes of text of a bucket on average.
BUCKET_ROWS, BUCKET_BYTES = 16_384, 32 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform order of ``n`` positions: each place, from the last, swaps with one up to itself."""
    order = list(range(n))
    with_place = rng.integers(0, np.arange(1, n + 1))
    for place in range(n - 1, 0, -1):
        other = with_place[place]
        order[place], order[other] = order[other], order[place]
    return np.array(order, np.int64)


def _shuffled(seed: int, bounds: list[int]):
    """Rows sorted by bucket, the bucket's start first -> the rows in random order, with shard and slot."""
    def shuffled(batches):
        def emit(bucket, pieces):
            rows = pa.Table.from_batches(pieces)
            start = rows["start"][0].as_py()
            rows = rows.slice(1)
            rng = np.random.default_rng([seed & 0xFFFFFFFF, bucket])
            rows = rows.select(["row"]).take(pa.array(fisher_yates(len(rows), rng)))
            at = start + np.arange(len(rows))
            shard = np.searchsorted(bounds, at, "right") - 1
            rows = rows.append_column("shard", pa.array(shard, pa.int32()))
            rows = rows.append_column("slot", pa.array(at - np.array(bounds)[shard], pa.int64()))
            yield from rows.combine_chunks().to_batches(1024)

        bucket, pieces = None, []
        for batch in batches:
            buckets = batch["bucket"].to_numpy()
            cuts = np.flatnonzero(np.diff(buckets)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if b > a:
                    if pieces and buckets[a] != bucket:
                        yield from emit(bucket, pieces)
                        pieces = []
                    bucket = int(buckets[a])
                    pieces.append(batch.slice(a, b - a))
        if pieces:
            yield from emit(bucket, pieces)
    return shuffled


def _bounds(total: int, shards: int) -> list[int]:
    """Where each shard begins; counts are at most one apart."""
    return [-(-i * total // shards) for i in range(shards)]


def shuffled_shards(docs: DataFrame, shards: int, seed: int = 0, text: str = "text",
                    doc_id: str = "doc_id", bucket_rows: int = BUCKET_ROWS,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all rows in a random order and return them as ``row`` (all columns), ``shard``, ``slot``.

    Shards hold counts at most one apart (law ``rows``); slots run from 0 without gaps. The order
    depends on the seed, the ids and the texts, not on how the table is stored. Null ids and
    texts are values like others. Rows equal in id and text are interchangeable; they share a
    bucket. An empty table gives no rows. With fewer rows than shards some shards are empty.
    """
    tie = F.xxhash64(F.col(doc_id), F.col(text), F.lit(seed))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), tie.alias("tie"))
    size = docs.agg(F.count(F.lit(1)).alias("rows"),
                    F.sum(F.octet_length(F.col(text))).alias("bytes")).first()
    total = size["rows"]
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                  -(-total // bucket_rows), -(-(size["bytes"] or 0) // bucket_bytes))
    scattered = rows.withColumn("bucket", F.pmod(F.xxhash64("tie"), F.lit(buckets)))
    # Where each bucket starts in the order of all rows travels to the bucket as a row of its own.
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    both = scattered.unionByName(starts, allowMissingColumns=True)
    by_bucket = both.repartition("bucket").sortWithinPartitions("bucket", F.col("start").isNull(), "tie")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, shard int, slot long"
    return staged(by_bucket.mapInArrow(_shuffled(seed, _bounds(total, shards)), schema), "shuffled")
