"""Streaming jobs over several micro-batches, against their batch results."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans import calls, risk
from tidemark.sinks import tables
from tidemark.sources import topics
from tidemark.streaming import jobs, sinks


def publish(spark, folder, n, values, topic="t", key=None, at=None):
    """One file of messages; files are numbered so that each is its own micro-batch."""
    data = [(None if key is None else bytearray(key[i].encode()), bytearray(v.encode()), topic, 0,
             n * 1000 + i, (at or dt.datetime(2024, 1, 1)) + dt.timedelta(seconds=i), 0)
            for i, v in enumerate(values)]
    spark.createDataFrame(data, schemas.ENVELOPE).coalesce(1).write.mode("append").parquet(folder)


def call(at, kind="Theft", disposition="ABA"):
    return json.dumps({"original_crime_type_name": kind, "call_date_time": at,
                       "disposition": disposition})


@pytest.fixture(autouse=True)
def state_rows(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    spark.conf.set(key, "true")
    yield
    spark.conf.set(key, "false")


LATE = ["2024-01-01T12:00:00", "2024-01-02T00:00:00", "2024-01-02T00:01:00",
        "2024-01-01T12:01:00"]


def codes(spark):
    """A few codes, two with one description."""
    return spark.createDataFrame([("ABA", "Abated"), ("A2", "Abated"), ("CIT", "Cited")], schemas.CODE)


def run_files(spark, tmp_path, mode):
    """Four messages, one per micro-batch, the last one twelve hours late."""
    source = str(tmp_path / "in")
    for n, at in enumerate(LATE):
        publish(spark, source, n, [call(at)])
        out = topics.file_topics(spark, source, "t", max_files_per_trigger=1)
        query = jobs.call_statistics(out, codes(spark), str(tmp_path / "out"),
                                     mode, every=None)
        query.awaitTermination()
    return query


def test_complete_mode_counts_late_calls(spark, tmp_path):
    query = run_files(spark, tmp_path, "complete")
    result = sinks.read_complete(spark, str(tmp_path / "out/calls"))
    counts = {r["window"]["start"]: r["count"] for r in result.collect()}
    assert counts == {dt.datetime(2024, 1, 1, 11, 55): 2, dt.datetime(2024, 1, 1, 12): 2,
                      dt.datetime(2024, 1, 1, 23, 55): 2, dt.datetime(2024, 1, 2): 2}
    assert {r["description"] for r in result.collect()} == {"Abated"}
    report = sinks.progress_report(query).collect()
    assert sum(r["rows_dropped_late"] for r in report) == 0
    assert max(r["state_rows"] for r in report) == 4


def test_update_mode_drops_late_calls(spark, tmp_path):
    query = run_files(spark, tmp_path, "update")
    result = sinks.read_updates(spark, str(tmp_path / "out/calls"), jobs.CALL_KEYS)
    counts = {r["window"]["start"]: r["count"] for r in result.collect()}
    assert counts == {dt.datetime(2024, 1, 1, 11, 55): 1, dt.datetime(2024, 1, 1, 12): 1,
                      dt.datetime(2024, 1, 1, 23, 55): 2, dt.datetime(2024, 1, 2): 2}
    report = sinks.progress_report(query).collect()
    assert sum(r["rows_dropped_late"] for r in report) == 2


def test_update_mode_keeps_codes_of_one_description_apart(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    for n, kinds in enumerate((["ABA", "A2"], ["A2", "CIT"])):
        publish(spark, source, n, [call("2024-01-01T12:01:00", disposition=k) for k in kinds])
        jobs.call_statistics(topics.file_topics(spark, source, "t"), codes(spark), str(tmp_path / "out"),
                             "update", every=None).awaitTermination()
    result = sinks.read_updates(spark, str(tmp_path / "out/calls"), jobs.CALL_KEYS)
    batch = calls.call_statistics(spark.read.schema(schemas.ENVELOPE).parquet(source), codes(spark))
    assert rows(result, *batch.columns) == rows(batch)
    assert rows(result.filter("window.start = '2024-01-01 12:00:00'"), "disposition", "count") == [
        ("A2", 2), ("ABA", 1), ("CIT", 1)]


def test_append_mode_emits_closed_windows(spark, tmp_path):
    query = run_files(spark, tmp_path, "append")
    result = spark.read.parquet(str(tmp_path / "out/calls")).collect()
    counts = {r["window"]["start"]: r["count"] for r in result}
    assert counts == {dt.datetime(2024, 1, 1, 11, 55): 1, dt.datetime(2024, 1, 1, 12): 1}
    assert sum(r["rows_dropped_late"] for r in sinks.progress_report(query).collect()) == 2


def test_malformed_null_and_unknown_calls(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    publish(spark, source, 0, [
        call("2024-01-01T12:00:00"), '{"bad', call("2024-01-01T12:01:00", disposition=None),
        call("2024-01-01T12:02:00", disposition="???"), call(None), call("2024-01-01T12:03:00")])
    batch = spark.read.schema(schemas.ENVELOPE).parquet(source)
    counts = calls.call_statistics(batch, codes(spark))
    assert rows(counts, "window.start", "description", "count") == sorted([
        (dt.datetime(2024, 1, 1, 11, 55), "Abated", 2), (dt.datetime(2024, 1, 1, 12), "Abated", 2)],
        key=repr)
    by_type = calls.count_by_type(calls.calls_from(batch))
    assert rows(by_type, "count") == [(1,), (1,), (1,), (3,)]


def test_console_and_fixed_trigger(spark, tmp_path):
    source = str(tmp_path / "in")
    publish(spark, source, 0, [call("2024-01-01T12:00:00")])
    df = calls.calls_from(topics.file_topics(spark, source, "t"))
    query = sinks.to_console(df, str(tmp_path / "ck"), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert sinks.progress_report(query).filter("input_rows = 1").count() == 1


def test_replayed_batch_replaces_its_output(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for _ in range(2):
        df.write.mode("overwrite").parquet(str(tmp_path / "batch_id=0"))
    df.withColumn("v", F.lit(2)).write.parquet(str(tmp_path / "batch_id=1"))
    assert rows(sinks.read_updates(spark, str(tmp_path), ["k"])) == [("a", 2)]
    assert rows(sinks.read_complete(spark, str(tmp_path))) == [("a", 2)]


def test_reading_does_not_grow_with_old_batches(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    def batches(low, high):
        for n in range(low, high):
            spark.createDataFrame([("all", n), (f"k{n % 3}", n)], "k string, v int").coalesce(1).write.parquet(
                f"{path}/batch_id={n}")
    def want(n):
        return sorted([("all", n), *[(f"k{i}", max(x for x in range(n + 1) if x % 3 == i)) for i in range(3)]], key=repr)
    batches(0, 6)
    assert sinks.compact_updates(spark, path, ["k"]) == 5
    assert sinks.compact_updates(spark, path, ["k"]) == 0
    first = sinks.read_updates(spark, path, ["k"])
    assert rows(first) == want(5)
    files = len(first.inputFiles())
    batches(6, 12)
    assert rows(sinks.read_updates(spark, path, ["k"])) == want(11)
    assert sinks.compact_updates(spark, path, ["k"]) == 6
    again = sinks.read_updates(spark, path, ["k"])
    assert rows(again) == want(11) and len(again.inputFiles()) <= files


def test_unfinished_fold_counts_for_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    spark.createDataFrame([("a", 1)], "k string, v int").write.parquet(f"{path}/batch_id=0")
    spark.createDataFrame([("a", 9)], "k string, v int").write.parquet(f"{path}/_base/batch_id=0")
    (tmp_path / "out/_base/batch_id=0/_SUCCESS").unlink()
    assert rows(sinks.read_updates(spark, path, ["k"])) == [("a", 1)]


def test_progress_log_keeps_all_reports(spark, tmp_path):
    source = str(tmp_path / "in")
    for n in range(5):
        publish(spark, source, n, [call("2024-01-01T12:00:00")] * (n + 1))
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    log = sinks.ProgressLog(spark, str(tmp_path / "reports"), "logged")
    spark.streams.addListener(log)
    try:
        df = calls.calls_from(topics.file_topics(spark, source, "t", max_files_per_trigger=1))
        query = sinks.to_batches(df, str(tmp_path / "o"), str(tmp_path / "ck"), "append", name="logged")
        query.awaitTermination()
        assert log.read().agg({"input_rows": "sum"}).first()[0] == 15
        assert sinks.progress_report(query).count() <= 2
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_untracked_state_is_null(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    query = run_files(spark, tmp_path, "complete")
    assert {r["state_rows"] for r in sinks.progress_report(query).collect()} == {None}


def customer(email="ada@test.com", birth="1999-12-31"):
    import base64
    record = {"customerName": "Ada Example", "email": email, "phone": "5550100", "birthDay": birth}
    element = base64.b64encode(json.dumps(record).encode()).decode()
    return json.dumps({"key": "Q3VzdA==", "existType": "NONE", "ch": False, "incr": False,
                       "zSetEntries": [{"element": element, "score": 0.0}]})


def score(email, value):
    return json.dumps({"customer": email, "score": value, "riskDate": "2020-09-14T07:54:06.417Z"})


def test_customer_golden(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    publish(spark, source, 0, [
        customer("ada@test.com", "1999-12-31"),
        json.dumps({"key": "x", "zSetEntries": []}),            # no entry
        json.dumps({"key": "x", "value": "other"}),             # another type
        json.dumps({"key": "x", "zSetEntries": [{"element": "not base64!"}]}),
        json.dumps({"key": "x", "zSetEntries": [{"element": "Q3V"}]}),
        customer(email=None), customer(birth=None), '{"bad'])
    got = risk.customers_from(spark.read.schema(schemas.ENVELOPE).parquet(source))
    assert got.columns == ["customerName", "email", "phone", "birthDay", "birthYear"]
    assert rows(got) == [("Ada Example", "ada@test.com", "5550100", "1999-12-31", "1999")]


def test_risk_date(spark):
    df = spark.createDataFrame([(bytearray(score("a", 7.0).encode()),)], "value binary")
    assert tuple(risk.risks_from(df).first()) == ("a", 7.0, dt.date(2020, 9, 14))


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_join_pairs_all_history(spark, tmp_path, salts):
    """Customers and scores that arrive in either order, one twice, all meet."""
    people, scores = str(tmp_path / "people"), str(tmp_path / "scores")
    steps = [([customer("a@x")], [score("b@x", 1.0)]), ([customer("b@x"), customer("a@x")], []),
             ([], [score("a@x", -2.5), score("a@x", 3.0), score("z@x", 9.0)])]
    for n, (c, s) in enumerate(steps):
        publish(spark, people, n, c)
        publish(spark, scores, n, s)
        jobs.customer_risk(topics.file_topics(spark, people, "t"),
                           topics.file_topics(spark, scores, "t"),
                           str(tmp_path / "out"), salts=salts).awaitTermination()
    messages = spark.read.parquet(str(tmp_path / "out/risk")).collect()
    got = sorted((r["key"], json.loads(r["value"])["score"]) for r in messages)
    assert got == [("a@x", -2.5), ("a@x", -2.5), ("a@x", 3.0), ("a@x", 3.0), ("b@x", 1.0)]
    assert json.loads(messages[0]["value"]).keys() == {"customer", "score", "email", "birthYear"}
    assert {r["topic"] for r in messages} == {"customer-risk"}


def test_deliveries_keep_all_cores_busy(spark, rows, tmp_path):
    """A table of one file streams in three micro-batches, each read by as many tasks as there are cores."""
    from tidemark.workload import inputs

    orders = spark.range(6000).selectExpr("if(id % 7 = 0, null, id % 500) AS o_custkey", "id % 3 AS n").coalesce(1)
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    taken = inputs.stream(spark, str(tmp_path), "orders").withColumn("task", F.spark_partition_id())
    query = sinks.to_batches(taken, str(tmp_path / "out"), str(tmp_path / "checkpoint"), "append")
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    tasks = got.groupBy(sinks.BATCH).agg(F.count_distinct("task").alias("n")).collect()
    assert [r["n"] for r in tasks] == [spark.sparkContext.defaultParallelism] * inputs.DELIVERIES
    assert rows(got, "o_custkey", "n") == rows(orders)


def test_bounded_join_forgets(spark, tmp_path):
    people, scores = str(tmp_path / "people"), str(tmp_path / "scores")
    day = dt.datetime(2024, 1, 1)
    for n, hours in enumerate((0, 1, 10, 11)):
        at = day + dt.timedelta(hours=hours)
        publish(spark, people, n, [customer(f"c{n}@x")], at=at)
        publish(spark, scores, n, [score("c0@x", float(n))], at=at)
        query = jobs.customer_risk(topics.file_topics(spark, people, "t"),
                                   topics.file_topics(spark, scores, "t"),
                                   str(tmp_path / "out"), within="2 HOURS")
        query.awaitTermination()
    messages = spark.read.parquet(str(tmp_path / "out/risk")).collect()
    assert sorted(json.loads(r["value"])["score"] for r in messages) == [0.0, 1.0]
    assert sinks.progress_report(query).collect()[-1]["state_rows"] < 8


def test_latest_customer_only(spark, rows):
    people = spark.createDataFrame(
        [("a", "1950", 1), ("a", "1960", 2), ("b", "1970", 1)],
        "email string, birthYear string, n int")
    scores = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("c", 3.0)],
                                   "customer string, score float")
    assert rows(risk.customer_risk_latest(people, scores, ["n"])) == [
        ("a", 1.0, "a", "1960"), ("a", 2.0, "a", "1960")]


def test_merged_batches_are_safe_to_repeat(spark, tmp_path):
    """A replay of a micro-batch mends a table that was left half replaced."""
    path, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def rows(*found):
        return spark.createDataFrame(found, "id long, at long, value string")

    def now():
        return sorted(map(tuple, tables.read_mergeable(spark, path).select("id", "at", "value").collect()))

    tables.write_mergeable(rows(*[(i, 0, "a") for i in range(20)]), path, ["id"], ["at"], 4)
    write = sinks._merger(path, checkpoint, ["id"], ["at"], 4)
    write(rows((1, 2, "b"), (30, 1, "b")), 0)
    second = rows(*[(i, 1, "c") for i in range(0, 20, 2)], (1, 1, "late"))
    write(second, 1)
    want = sorted([(i, 1, "c") if i % 2 == 0 else (i, 0, "a") for i in range(20) if i != 1]
                  + [(1, 2, "b"), (30, 1, "b")])
    assert now() == want
    half = spark.read.parquet(f"{checkpoint}/merged/{sinks.BATCH}=1")
    half.filter("id > 9").write.parquet(f"{path}-half")
    tables.replace_folders(spark.read.parquet(f"{path}-half"), path, ["id"])
    assert now() != want
    write(second, 1)
    assert now() == want
    write(rows((1, 1, "late")), 2)
    assert now() == want
