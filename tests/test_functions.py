import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn


def one(spark, column, value, dtype):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(column(F.col("x")).alias("y")).first()["y"]


def test_epoch_precisions(spark):
    millis = 1543092353796
    assert one(spark, fn.millis_to_timestamp, millis, "bigint") == \
        dt.datetime(2018, 11, 24, 20, 45, 53, 796000)
    assert one(spark, fn.millis_to_second, millis, "bigint") == \
        dt.datetime(2018, 11, 24, 20, 45, 53)
    assert one(spark, fn.millis_to_timestamp, None, "bigint") is None


@pytest.mark.parametrize("day,week,sunday0,sunday1", [
    (dt.datetime(2018, 12, 31), 1, 1, 2),      # Monday of ISO week 1 of 2019
    (dt.datetime(2018, 11, 25), 47, 0, 1),     # a Sunday
    (dt.datetime(2018, 11, 24), 47, 6, 7),     # a Saturday
])
def test_calendar(spark, day, week, sunday0, sunday1):
    df = spark.createDataFrame([(day,)], "t timestamp")
    zero = df.select(*fn.calendar_parts(F.col("t"), 0)).first()
    assert (zero["week"], zero["weekday"]) == (week, sunday0)
    assert df.select(fn.weekday(F.col("t"), 1).alias("w")).first()["w"] == sunday1
    with pytest.raises(ValueError):
        fn.weekday(F.col("t"), 2)


@pytest.mark.parametrize("text,want", [
    (" a ", " a "), ("", None), ("  ", None), (" \t\r\n", None), (None, None), ("x", "x")])
def test_blank(spark, text, want):
    assert one(spark, fn.none_if_blank, text, "string") == want


@pytest.mark.parametrize("text,target,want", [
    ("83", "int", 83), ("83.0", "bigint", 83), ("", "int", None), ("abc", "int", None),
    ("1540708070796.0", "bigint", 1540708070796), ("1.54112E+12", "bigint", 1541120000000),
    ("205.5", "decimal(18,0)", 206), ("-97.5", "decimal(18,0)", -98), ("3000000000", "int", None),
    ("205.26975", "double", 205.26975)])
def test_typed(spark, text, target, want):
    assert one(spark, lambda c: fn.typed(c, "string", target), text, "string") == want


def test_typed_width_and_epoch(spark):
    assert one(spark, lambda c: fn.typed(c, "string", "string", 3), "émile", "string") == "émi"
    at = one(spark, lambda c: fn.typed(c, "string", "timestamp", epoch_millis=True),
             "1543092353796", "string")
    assert at == dt.datetime(2018, 11, 24, 20, 45, 53, 796000)


def test_base64_payload(spark):
    assert one(spark, fn.base64_text, "Q3VzdG9tZXI=", "string") == "Customer"
    for bad in ("not base64!", "***", "Q3V", None):
        assert one(spark, fn.base64_text, bad, "string") in (None, "Cu")
    assert one(spark, fn.leading_part, "2001-01-03", "string") == "2001"
    assert one(spark, fn.leading_part, "2001", "string") == "2001"


def test_json(spark):
    schema = "a int, b string"
    got = one(spark, lambda c: fn.parse_json(c, schema), '{"a": 1, "b": "x"}', "string")
    assert tuple(got) == (1, "x")
    assert tuple(one(spark, lambda c: fn.parse_json(c, schema), '{"a', "string")) == (None, None)
    df = spark.createDataFrame([(1, None, "x")], "a int, b int, c string")
    assert df.select(fn.emit_json().alias("j")).first()["j"] == '{"a":1,"c":"x"}'


def test_first_of_empty_array(spark):
    items = "array<struct<element:string>>"
    first = lambda c: fn.first_of(c, "element")
    assert one(spark, first, [("x",), ("y",)], items) == "x"
    assert one(spark, first, [], items) is None
    assert one(spark, first, None, items) is None


def test_lines_and_slugs(spark):
    flags = spark.createDataFrame(
        [(True, True, False), (False, True, True), (False, False, True), (False, False, False),
         (None, True, None)], "r boolean, b boolean, g boolean")
    lines = [r[0] for r in flags.select(
        fn.line_of_flags(F.col("r"), F.col("b"), F.col("g"))).collect()]
    assert lines == ["red", "blue", "green", "N/A", "blue"]
    colours = spark.createDataFrame([("red",), ("N/A",), (None,)], "l string").select(
        fn.category_colour(F.col("l")).alias("c")).collect()
    assert [r["c"] for r in colours] == ["#DC143C", "0xFFFFFF", "0xFFFFFF"]
    assert one(spark, fn.slug, "O'Hare", "string") == "ohare"
    assert one(spark, fn.slug, "95th/Dan Ryan-South", "string") == "95th_and_dan_ryan_south"
    assert one(spark, fn.spaced, "out_of_service", "string") == "out of service"


@pytest.mark.parametrize("rides,ratio,steps,want", [
    (22811.6, 0.01, 1, 228), (2.5, 1.0, 1, 2), (3.5, 1.0, 1, 4), (-5.0, 1.0, 1, 0),
    (22811.6, 0.09, 12, 171)])
def test_expected_count(spark, rides, ratio, steps, want):
    df = spark.createDataFrame([(rides, ratio)], "d double, r double")
    got = df.select(fn.expected_count(F.col("d"), F.col("r"), steps).alias("n")).first()["n"]
    assert got == want


def test_hash_key(spark):
    df = spark.createDataFrame([(867, "2018-11-24 20:45:53"), (None, "x")], "s int, t string")
    got = [r[0] for r in df.select(fn.hash_key(F.col("s"), F.col("t"))).collect()]
    assert got == [hashlib.md5(b"8672018-11-24 20:45:53").hexdigest(), None]


def test_dense_key_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("v"), "id")
    got = fn.dense_key(df, ["v", "id"], "key", start=10).orderBy("key").collect()
    assert [r["key"] for r in got] == list(range(10, 5010))
    assert [r["v"] for r in got] == sorted(r["v"] for r in got)


def test_identity_without_order(spark):
    df = spark.range(0, 3000, 1, 7)
    got = fn.dense_key(df, None, "key", start=5)
    assert sorted(r["key"] for r in got.collect()) == list(range(5, 3005))


def test_dense_key_spreads_equal_rows(spark):
    """A third of all rows alike must not end in one range."""
    same = spark.range(0, 20000, 1, 8).select(F.lit(5).alias("v"))
    other = spark.range(0, 40000, 1, 8).select((F.col("id") % 1000).alias("v"))
    got = fn.dense_key(same.union(other), ["v"], "key")
    assert got.select("key").distinct().count() == 60000
    assert got.agg(F.max("key")).first()[0] == 59999
