"""Incremental reads by an increasing key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def rows_after(df: DataFrame, key: str, mark: int | None, upto: int | None = None) -> DataFrame:
    """Rows with ``key`` above ``mark`` and at most ``upto``.

    Both bounds reach the scan: a JDBC source gets them in its WHERE clause and
    Parquet skips the row groups outside them.
    """
    if mark is not None:
        df = df.filter(F.col(key) > F.lit(mark))
    if upto is not None:
        df = df.filter(F.col(key) <= F.lit(upto))
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, mark: int | None = None,
              partitions: int = 16, fetch_rows: int = 500, **options) -> DataFrame:
    """A database table above a high-water mark, read in ``partitions`` key ranges.

    One range is one task; give 1 only for small tables or a key without order.
    """
    reader = spark.read.format("jdbc").options(url=url, fetchsize=fetch_rows, **options)
    floor = "" if mark is None else f" WHERE {key} > {int(mark)}"
    if partitions > 1:
        bounds = reader.option(
            "query", f"SELECT min({key}) lo, max({key}) hi FROM {table}{floor}").load().first()
        if bounds["lo"] is not None:
            reader = reader.options(partitionColumn=key, lowerBound=int(bounds["lo"]),
                                    upperBound=int(bounds["hi"]), numPartitions=partitions)
    return reader.option("dbtable", f"(SELECT * FROM {table}{floor}) t").load()


class HighWaterMark:
    """The last key taken from a source, kept as an append-only table.

    A mark is recorded only after its rows have landed, so a run that fails in
    between takes the same rows again; land them under a name derived from the
    mark (see ``poll``) and the repeat replaces them.
    """

    def __init__(self, spark: SparkSession, path: str, source: str):
        self.spark, self.path, self.source = spark, path, source

    def get(self) -> int | None:
        try:
            marks = self.spark.read.schema("source string, mark bigint").parquet(self.path)
            return marks.filter(F.col("source") == self.source).agg(F.max("mark")).first()[0]
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def advance(self, mark: int) -> None:
        self.spark.createDataFrame([(self.source, int(mark))], "source string, mark bigint") \
            .coalesce(1).write.mode("append").parquet(self.path)


#: Key ranges that one look at a source is split into.
RANGES = 1024


def cut_key(rows: DataFrame, key: str, max_rows: int, ranges: int = RANGES) -> int | None:
    """The largest key up to which there are at most ``max_rows`` rows, or the first key if it alone has more.

    Rows are counted in equal ranges of the key; where the running total passes the bound, that range is
    split again, until it is a single key. Each look reads only its own range, and gives the driver
    ``ranges`` counts, so gaps and dense stretches of the key cost a few looks and no sort. None without rows.
    """
    found = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    low, high, n = found
    if low is None or n <= max_rows:
        return high
    taken = 0
    while low < high:
        width = -(-(high - low + 1) // ranges)
        within = rows.filter(F.col(key).between(low, high))
        place = F.call_function("div", F.col(key).cast("decimal(20,0)") - F.lit(low), F.lit(width))
        counts = sorted(within.groupBy(place.alias("range")).count().collect())
        for at, count in counts:
            if taken + count > max_rows:
                low, high = low + at * width, min(high, low + at * width + width - 1)
                break
            taken += count
        else:
            return high
    return low if not taken else low - 1


def poll(source: DataFrame, key: str, state: HighWaterMark, out: str,
         span: int | None = None, max_rows: int | None = None) -> int | None:
    """Land the rows above the mark under ``out`` and move the mark to the last of them.

    ``span`` bounds one poll by a width of key range, ``max_rows`` by a number of rows, which only
    the rows of a single key may exceed. Returns the new mark, or None when there was nothing new. Landed rows are read
    back with ``spark.read.parquet(out)``; column ``above`` tells the poll.
    """
    mark = state.get()
    fresh = rows_after(source, key, mark)
    upto = None
    if span is not None:
        first = fresh.agg(F.min(key)).first()[0]
        if first is None:
            return None
        upto = first + span - 1
    if max_rows is not None:
        upto = cut_key(rows_after(fresh, key, None, upto), key, max_rows)
        if upto is None:
            return None
    batch = rows_after(source, key, mark, upto)
    target = f"{out}/above={'start' if mark is None else mark}"
    landed = Observation()
    batch.sortWithinPartitions(key).observe(landed, F.max(key).alias("last")).write.mode("overwrite").parquet(target)
    last = landed.get.get("last")
    if last is not None:
        state.advance(last)
    return last
