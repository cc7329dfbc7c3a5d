"""How filters interact: what each removes alone, after others, and on average over all orders.

Documents come as available-now micro-batches. Each one's failing filters are a mask of bits. Four bits depend on
its own text; the fifth says that a smaller id has the same text, which later files can change. So a state
keyed by text holds the least id so far and how many rows have it, by part and labels. Where a
micro-batch brings a smaller id, the rows counted without the fifth bit are retracted from the counters of
their parts and counted with it.

Each micro-batch adds one folder to a log: its texts with their numbers, and what it retracts. The log up to then is the
state, and the counters are the sums of its changes. A replay replaces the folder, and reads only
those before it, so a run that breaks off counts nothing twice. All figures of all orders follow from the
counters, 32 masks for each part.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import staged

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
WORD_BREAK = r"[\x20\x09-\x0D]+"
_WHO = ["part", "good", "toxic"]
#: One row for a text's rows of a part and labels. ``uncopied`` and ``copied`` are what it adds to the counters;
#: ``first`` says that its ``low`` is the least id so far, which ``n_low`` of its rows have.
_LOG = ("key binary, mask int, part string, good boolean, toxic boolean, low long, n_low long, first boolean, "
        "uncopied long, copied long")


def own_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself: A short, B repetitive, C shouting, D symbols."""
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [n < 50, F.size(F.array_distinct(words)) * F.lit(100) < n * F.lit(65), capitals.cast("long") * 100 > F.length(text).cast("long") * 5,
             text.rlike(r"[#$%&*|]")]
    bits = [F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def _folded(rows: DataFrame) -> DataFrame:
    """Copies in a micro-batch as one row for each part and labels: the least id, the rows with it, the rows with
    any id and those without. Each step sums within the tasks first, so copies may be any number."""
    by_id = rows.groupBy("key", "mask", *_WHO, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("doc_id").isNotNull()
    return by_id.groupBy("key", "mask", *_WHO).agg(
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_without")).select(
        "key", "mask", *_WHO, F.col("first.doc_id").alias("low"), F.col("first.n").alias("n_low"), "n", "n_without")


def _judged(new: DataFrame, before: DataFrame) -> DataFrame:
    """The log of a micro-batch from its folded rows and the log before it.

    A text's rows meet by one window; they are as many as parts and labels that have it.
    """
    held = before.filter("first").select("key", "mask", *_WHO, "low", "n_low", F.lit(None).cast("long").alias("n"),
                                         F.lit(None).cast("long").alias("n_without"))
    text, known = Window.partitionBy("key"), F.col("n").isNull()
    both = new.unionByName(held).withColumns({
        "held": F.min(F.when(known, F.col("low"))).over(text),
        "arrived": F.min(F.when(~known, F.col("low"))).over(text)})
    first = ~known & F.coalesce(F.col("low") == F.least("arrived", "held"), F.lit(False))
    n_first = F.when(first, F.col("n_low")).otherwise(F.lit(0))
    retracted = known & (F.col("low") == F.col("held")) & (F.col("arrived") < F.col("held"))
    return both.filter(~known | retracted).select(
        "key", "mask", *_WHO, "low", "n_low", first.alias("first"),
        F.when(known, -F.col("n_low")).otherwise(n_first + F.col("n_without")).alias("uncopied"),
        F.when(known, F.col("n_low")).otherwise(F.col("n") - n_first).alias("copied"))


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """By how much each micro-batch changes the counters: batch, part, good, toxic, mask, n."""
    log = spark.read.schema(f"{_LOG}, batch long").parquet(f"{folder}/log")
    return log.select("batch", *_WHO, F.explode(F.array(
        F.struct(F.col("mask"), F.col("uncopied").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(DUPLICATE)).alias("mask"), F.col("copied").alias("n")))).alias("c")).select(
        "batch", *_WHO, "c.*").groupBy("batch", *_WHO, "mask").agg(F.sum("n").alias("n")).filter("n <> 0")


def _labelled(labels: DataFrame) -> DataFrame:
    """One row per id; several labels of a document are joined by or."""
    def any_one(name):
        return F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(name)

    return labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        any_one("quality"), any_one("toxic"))


def count_masks(docs: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """Counters of a stream of documents (doc_id, text, source), run to its end: part, good, toxic, mask, n.

    ``folder`` gets the checkpoint and the log. Run again with the same folder after a failure or when
    files have been added: what has been counted stays so.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"), own_mask(text).alias("mask"))
    known = staged(_labelled(labels), "labelled")
    found = narrow.join(known, F.col("doc_id") == F.col("_id"), "left").select(
        "key", "mask", "part", F.coalesce("quality", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"), "doc_id")

    def add(batch: DataFrame, number: int) -> None:
        before = spark.read.schema(f"{_LOG}, batch long").parquet(f"{folder}/log").filter(F.col("batch") < number)
        _judged(_folded(batch), before).write.mode("overwrite").parquet(f"{folder}/log/batch={number}")

    spark.createDataFrame([], _LOG).write.mode("overwrite").parquet(f"{folder}/log/batch=-1")
    found.writeStream.foreachBatch(add).trigger(availableNow=True).option(
        "checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()
    return changes(spark, folder).groupBy(*_WHO, "mask").agg(F.sum("n").alias("n")).filter("n <> 0")


def orders_report(counts: DataFrame) -> DataFrame:
    """Of counters a row for each part, order of the filters and step: part, filter_order, step (from 1), kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley (removed by the step's filter, summed over all orders)."""
    masks = F.sequence(F.lit(0), F.lit(2 ** len(FILTERS) - 1))
    by_part = counts.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n"))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n"))).alias("toxic")).groupBy("part").agg(F.map_from_entries(
            F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("of"))
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    steps = by_part.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bits(letters: Column) -> Column:
        each = F.transform(F.filter(F.split(letters, ""), lambda x: x != ""), lambda x: F.ascii(x) - F.lit(ord(FILTERS[0])))
        return F.aggregate(each, F.lit(0), lambda total, i: total + F.call_function("shiftleft", F.lit(1), i))

    this = F.expr("substring(filter_order, step, 1)")
    stepped = steps.withColumns({"own": bits(this), "earlier": bits(F.expr("substring(filter_order, 1, step - 1)"))})

    def total(field: str, condition, weight=None) -> Column:
        def value(m):
            n = F.coalesce(F.col("of")[m][field], F.lit(0).cast("long"))
            return n if weight is None else n * weight(m)
        return F.aggregate(F.filter(masks, condition), F.lit(0).cast("long"), lambda t, m: t + value(m))

    own, earlier = F.col("own"), F.col("earlier")

    def fails(m):
        return m.bitwiseAND(own) != 0

    def removed(m):
        return fails(m) & (m.bitwiseAND(earlier) == 0)

    share = len(list(permutations(FILTERS)))
    return stepped.select(
        "part", "filter_order", "step",
        total("n", lambda m: m.bitwiseAND(own.bitwiseOR(earlier)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: fails(m) & (m.bitwiseAND(earlier) != 0)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
        # Of the orders, as many put a filter first among those that a text fails as any other of them.
        total("n", fails, lambda m: (F.lit(share) / F.bit_count(m)).cast("long")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, folder: str | None = None) -> DataFrame:
    """The report of ``orders_report`` over a stream of documents (doc_id, text, source) with labels (doc_id, quality, toxic).

    A null text is empty, a null source the part "". Filters: A under 50 words; B distinct words under
    65 percent; C capital letters over 5 percent; D any of ``#$%&*|``; E the text of a smaller id. Rows that share an id and a
    text are no copies of one another; rows without an id are copies of none, and none of theirs. Several
    labels of an id count if one of them says so. Texts may be of any length, and copies of a text any number: they are
    summed within the tasks for each part and labels. Other columns are ignored. Without documents there are no rows.
    """
    return orders_report(count_masks(docs, labels, folder or fresh_path(docs.sparkSession, "filter-audit")))


def stream_of(spark: SparkSession, path: str, per_core: int = 4) -> DataFrame:
    """Parquet files as a stream whose micro-batches give each core ``per_core`` read partitions.

    A stream source takes a folder or a glob but no single file, so the path becomes a glob for itself.
    """
    folder, _, name = path.rpartition("/")
    schema = spark.read.parquet(path).schema
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return spark.readStream.schema(schema).option(
        "maxBytesPerTrigger", size * per_core * spark.sparkContext.defaultParallelism).parquet(
            f"{folder}/[{name[0]}]{name[1:]}")
