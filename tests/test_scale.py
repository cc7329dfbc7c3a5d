"""What the plans look like, and how they take a key with a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dense_key
from tidemark.operators.joins import join_on, lookup_join, within_bound
from tidemark.operators.keyed import last_per_key
from tidemark.plans import star
from tidemark.workload import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    changed = {}

    def change(key, value):
        changed[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_bound_is_checked_by_rows_and_bytes(spark):
    small, wide = spark.range(100), spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert within_bound(small, rows=100)
    assert not within_bound(small, rows=99)
    assert not within_bound(wide, size=5000)


def test_lookup_beyond_the_bound_is_not_broadcast(spark, plan, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left, right = spark.range(1000), spark.range(1000)
    assert "Broadcast" in plan(lookup_join(left, right, ["id"]))
    beyond = lookup_join(left, right, ["id"], rows=10)
    assert "Broadcast" not in plan(beyond) and beyond.count() == 1000


def test_hot_join_key_is_split(spark, conf, tmp_path):
    """A key with most of the rows: its partition is read by several tasks."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "50k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")
    left = spark.range(0, 100000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 500).alias("k"),
        F.xxhash64("id").alias("v"))
    right = spark.range(500).select(F.col("id").alias("j"), F.xxhash64("id").alias("w"))
    joined = join_on(left, right, [(left["k"], right["j"])])
    joined.write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100000
    counted = joined.groupBy("k").count()
    counted.collect()
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()


def test_null_left_keys_are_spread(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    left = spark.range(0, 8000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(100).select(F.col("id").alias("j"))
    joined = join_on(left, right, [(left["k"], right["j"])], "left", spread_nulls=True)
    per_task = joined.groupBy(F.spark_partition_id().alias("p"), F.col("k").isNull().alias("n"))
    nulls = [r["count"] for r in per_task.count().collect() if r["n"]]
    assert len(nulls) == 4 and max(nulls) < 2000
    assert joined.count() == 8000


def test_last_per_key_reduces_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(last_per_key(df, ["k"], ["id"]))
    assert text.count("Exchange") == 1
    assert text.index("partial_max") > text.index("Exchange")


def test_dense_key_has_no_one_task_sort_of_the_rows(spark, plan):
    text = plan(dense_key(spark.range(1000), ["id"], "key"))
    # The only single-partition step is over one row per partition.
    assert text.count("SinglePartition") == 1
    assert text.index("SinglePartition") < text.index("HashAggregate(keys=[_part")


def test_fact_scan_reads_only_what_it_needs(spark, plan):
    text = plan(QUERIES["fact_inner"].run(spark, SF))
    assert "EqualTo(l_returnflag,R)" in text
    assert "l_extendedprice" not in text and "o_totalprice" not in text


def test_star_fact_projects_before_it_joins(spark, plan):
    text = plan(QUERIES["star_pipeline_songplays"].run(spark, SF))
    assert "p_retailprice" not in text
    assert star.rules_of("pipeline").join == "left"
