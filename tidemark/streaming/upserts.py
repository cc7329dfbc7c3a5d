"""Counts over an upsert stream: a message replaces the earlier one of its key, which then no longer counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.keyed import last_per_key
from ..session import stage, staging
from ..sinks.versions import BUCKET_ROWS, KeyedTable, summed
from .sinks import to_each


class LatestCounts:
    """How many message keys stand in each group by their last message, kept up by a stream.

    Two keyed tables below ``path``: the last message of each message key, and the count of each group. A
    micro-batch reads the messages it replaces, takes one from the group of each and adds one to the new
    group. The counts are published first, then the messages, both under the micro-batch's number. A replay
    therefore finds the messages as they were before, unless it has nothing left to do.
    """

    def __init__(self, spark: SparkSession, path: str, messages: StructType, key: str, message_key: list[str],
                 order: list[str], name: str = "count", bucket_rows: int = BUCKET_ROWS):
        self.key, self.message_key, self.order, self.name = key, message_key, order, name
        columns = list(dict.fromkeys([*message_key, *order, key]))
        self.last = KeyedTable(spark, f"{path}/messages", StructType([messages[c] for c in columns]), message_key,
                               order, bucket_rows)
        self.counts = KeyedTable(spark, f"{path}/counts", StructType(
            [messages[key], StructField(name, LongType())]), [key], (), bucket_rows)

    def read(self) -> DataFrame:
        """Groups that some message key stands in, with their counts."""
        return self.counts.read()

    def take(self, batch: DataFrame, number: int) -> None:
        """Count a micro-batch."""
        with staging(batch.sparkSession):
            new = stage(last_per_key(batch.select(*self.last.schema.names), self.message_key, self.order), "upserts")
            if self.counts.version().batch < number:
                self.counts.apply(self.changes(new), lambda a, b: summed(a, b, [self.key], self.name), number)
            self.last.merge(new, number)

    def changes(self, new: DataFrame) -> DataFrame:
        """By how much the last messages of some keys change the counts; earlier ones than the known change nothing."""
        when = F.struct(*self.order)
        arrived = new.select(*self.message_key, F.col(self.key).alias("_new"), when.alias("_at"))
        known = self.last.rows_near(new).select(
            *(F.col(c).alias(f"_k{i}") for i, c in enumerate(self.message_key)), F.col(self.key).alias("_old"),
            when.alias("_was"))
        same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(self.message_key)]
        wins = F.col("_was").isNull() | (F.col("_at") >= F.col("_was"))
        both = arrived.join(known, same, "left").filter(wins)
        deltas = both.select(F.explode(F.array(
            F.struct(F.col("_new").alias(self.key), F.lit(1).cast("bigint").alias(self.name)),
            F.struct(F.col("_old").alias(self.key), F.lit(-1).cast("bigint").alias(self.name)))).alias("d")).select("d.*")
        return deltas.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(
            F.sum(self.name).alias(self.name)).filter(F.col(self.name) != 0)


def to_latest_counts(messages: DataFrame, counts: LatestCounts, checkpoint: str, every: str | None = None,
                     name: str | None = None) -> StreamingQuery:
    """Keep ``counts`` up with a stream of messages."""
    return to_each(messages, counts.take, checkpoint, every, name)
