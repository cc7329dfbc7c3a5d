import pytest
from pyspark.sql import functions as F

from tidemark.schemas import Field, Table
from tidemark.sinks import tables as sink
from tidemark.sources import files

SPEC = Table("people", (Field("id", "int", required=True), Field("name", "string")), key=("id",))


def test_partitioned_write_prunes(spark, tmp_path, plan):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("year"))
    sink.write_parquet(df, str(tmp_path / "t"), ["year"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 100
    assert "PartitionFilters: [isnotnull(year" in plan(back.filter("year = 1"))
    sink.write_parquet(df.limit(10), str(tmp_path / "t"), ["year"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_many_directories_warns(spark):
    df = spark.range(100)
    with pytest.warns(UserWarning):
        assert sink.warn_if_many_directories(df, ["id"], limit=50) > 50


def test_rebalance_splits_a_hot_directory(spark, tmp_path):
    """Nine tenths of the rows in one directory are written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 200000, 1, 8).select(
            F.xxhash64("id").alias("v"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("p"))
        sink.write_parquet(df, str(tmp_path / "t"), ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t/p=0").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200000


@pytest.fixture
def small_files(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sorted_write_spreads_equal_rows(spark, tmp_path, small_files):
    df = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"))
    sink.write_sorted(df, str(tmp_path / "t"), ["k"])
    per_file = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count()
    counts = [r["count"] for r in per_file.collect()]
    assert sum(counts) == 60000 and max(counts) < 30000


def test_bucketed_join_needs_no_shuffle(spark, plan):
    spark.sql("CREATE DATABASE IF NOT EXISTS b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("l", "r"):
            sink.write_bucketed(spark.range(1000).select("id", F.lit(name).alias(name)),
                                f"b.{name}", 4, ["id"])
        joined = spark.table("b.l").join(spark.table("b.r"), "id")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quoted_csv_round_trip(spark, tmp_path, rows):
    data = [(1, 'say "hi", now'), (2, "two\nlines"), (3, "plain")]
    df = spark.createDataFrame(data, "id int, text string")
    sink.write_quoted_csv(df, str(tmp_path / "t"))
    texts = "".join(p.read_text() for p in (tmp_path / "t").glob("*.csv"))
    assert '"id","text"' in texts and '"3","plain"' in texts
    assert rows(files.read_csv(spark, str(tmp_path / "t"), "id int, text string",
                               multiLine=True)) == data


def test_load_append_and_truncate(spark, rows):
    df = spark.createDataFrame([("kim", 1)], "name string, id int")      # other column order
    sink.drop_tables(spark, [SPEC], "d")
    sink.create_tables(spark, [SPEC], "d")
    sink.create_tables(spark, [SPEC], "d")                               # no effect
    sink.load_table(df, SPEC, "d")
    assert rows(sink.load_table(df, SPEC, "d")) == [(1, "kim")] * 2
    assert rows(sink.load_table(df, SPEC, "d", truncate=True)) == [(1, "kim")]
    with pytest.raises(ValueError, match="surplus"):
        sink.load_table(df.withColumn("x", F.lit(1)), SPEC, "d")
    with pytest.raises(ValueError, match="missing"):
        sink.load_table(df.select("id"), SPEC, "d")


def test_script(spark):
    n = sink.run_script(spark, """
        CREATE DATABASE IF NOT EXISTS s;
        CREATE TABLE IF NOT EXISTS s.t (a int) USING parquet;

        ;
        DROP TABLE IF EXISTS s.t;
    """)
    assert n == 3 and not spark.catalog.tableExists("s.t")


def test_keyed_write_and_merge(spark, tmp_path, rows, plan):
    df = spark.createDataFrame(
        [("s", 1, 10, "a"), ("s", 1, 11, "b"), ("s", 2, 5, "c"), ("t", 1, 1, "d")],
        "song string, user int, at int, v string")
    table = sink.write_keyed(df, str(tmp_path / "t"), ["song"], ["user"], ["at"])
    assert rows(table) == [("s", 1, 11, "b"), ("s", 2, 5, "c"), ("t", 1, 1, "d")]
    changes = spark.createDataFrame(
        [("s", 1, 11, "e"), ("s", 2, 4, "late"), ("u", 9, 1, "new")], df.schema)
    assert rows(sink.merge_keyed(table, changes, ["song", "user"], ["at"])) == [
        ("s", 1, 11, "e"), ("s", 2, 5, "c"), ("t", 1, 1, "d"), ("u", 9, 1, "new")]
    assert "EqualTo(song,s)" in plan(table.filter("song = 's'"))


def test_keyed_table_spans_files_for_a_hot_partition_key(spark, tmp_path, small_files):
    df = spark.range(0, 40000, 1, 8).select(
        F.lit("hit").alias("song"), F.col("id").alias("user"), F.lit(1).alias("at"))
    sink.write_keyed(df, str(tmp_path / "t"), ["song"], ["user"], ["at"])
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 4
