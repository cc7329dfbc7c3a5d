import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import quality
from tidemark.operators.keyed import count_per_key, distinct_in_order, last_per_key, latest
from tidemark.operators.staging import normalise, rejected
from tidemark.schemas import Field, Table

TABLE = Table("t", (
    Field("name", "string", 4), Field("n", "int", required=True),
    Field("kind", "string", allowed=("a", "b")),
), key=("n",))


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [("  ", "1", "a"), ("abcdef", "x", "c"), ("", "2", None), ("ok", "2", "b")],
        "name string, n string, kind string")


def test_normalise(raw, rows):
    assert rows(normalise(raw, TABLE)) == sorted(
        [(None, 1, "a"), ("abcd", None, "c"), (None, 2, None), ("ok", 2, "b")], key=repr)


def test_rejected(raw, rows):
    assert rows(rejected(raw, TABLE)) == [("kind", 0), ("n", 1), ("name", 0)]


def test_declared_rules(raw, rows):
    clean = normalise(raw, TABLE)
    assert rows(quality.check_table(clean, TABLE)) == [("domain:kind", 1), ("not_null:n", 1)]
    assert rows(quality.repeated_keys(clean, ["n"])) == [(2, 2)]
    assert rows(quality.null_counts(clean)) == [("kind", 1), ("n", 1), ("name", 2)]
    assert rows(quality.outside_domain(clean, {"kind": ("a",)})) == [("kind", 2)]


def test_orphans(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.orphans(child, "k", parent, "id")) == [(2, 2)]


def test_checks_gate(spark, rows):
    good = ("SELECT count(*) FROM VALUES (1), (2) t(x) WHERE x IS NULL", 0)
    assert rows(quality.run_checks(spark, [good[0]], [0])) == [(good[0], "0", "0")]
    with pytest.raises(quality.QualityError):
        quality.run_checks(spark, [good[0], "SELECT 1"], [0, 2])
    with pytest.raises(ValueError):
        quality.run_checks(spark, [good[0]], [])


def test_checks_stop_at_first_failure(spark):
    with pytest.raises(quality.QualityError):
        quality.run_checks(spark, ["SELECT 1", "SELECT raise_error('not reached')"], [0, 0])


def test_weather_domain(spark, rows):
    df = spark.createDataFrame([("sunny",), ("hail",)], "status string")
    assert rows(quality.outside_domain(df, {"status": schemas.WEATHER_STATES})) == [("status", 1)]


def test_last_per_key(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, t int, v string")
    assert rows(last_per_key(df, ["k"], ["t"])) == [("a", 2, None), ("b", 1, "y")]


def test_counts(spark, rows):
    df = spark.createDataFrame(
        [(1, "m1", 1), (1, "m1", 2), (2, "m1", 3), (2, "m2", 4), (None, "m3", 5)],
        "station int, message string, t int")
    assert rows(count_per_key(df, "station")) == [(1, 2), (2, 2)]
    table = count_per_key(df, "station", mode="latest_per_key", message_key=["message"],
                          order=["t"])
    assert rows(table) == [(2, 2)]
    with pytest.raises(ValueError):
        count_per_key(df, "station", mode="latest_per_key")
    with pytest.raises(ValueError):
        count_per_key(df, "station", mode="other")


def test_latest_defaults(spark):
    reports = spark.createDataFrame([(41, "windy", 1), (42, "cloudy", 2)],
                                    "temperature int, status string, t int")
    defaults = {"temperature": 70.0, "status": "sunny"}
    assert tuple(latest(reports, ["t"], defaults).first()) == (42.0, "cloudy")
    assert tuple(latest(reports.filter("t > 9"), ["t"], defaults).first()) == (70.0, "sunny")


def test_distinct_in_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("b", 9), ("c", 1)], "name string, o int")
    assert [r["name"] for r in distinct_in_order(df, "name", "o").collect()] == ["c", "b", "a"]


def test_null_key_left_join_matches_plain(spark, rows):
    from tidemark.operators.joins import join_on
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (1, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "n"), (1, "y")], "j int, w string")
    plain = left.join(right, F.col("k") == F.col("j"), "left")
    spread = join_on(left, right, [(left["k"], right["j"])], "left", spread_nulls=True)
    assert rows(spread) == rows(plain)
    assert spread.columns == plain.columns


@pytest.mark.parametrize("salts", [1, 3, 8])
def test_salted_join_matches_plain(spark, rows, salts):
    from tidemark.operators.joins import salted_join
    left = spark.createDataFrame([(i % 3, i) for i in range(30)] + [(None, 99)], "k int, v int")
    right = spark.createDataFrame([(0, "a"), (0, "b"), (2, "c"), (None, "d")], "j int, w string")
    plain = left.join(right, F.col("k") == F.col("j"))
    assert rows(salted_join(left, right, "k", "j", salts)) == rows(plain)
