"""Keyed tables in versions, counts that retract, and the gate before publishing."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.keyed import count_per_key
from tidemark.operators.quality import QualityError
from tidemark.plans import star
from tidemark.sinks import publish, versions
from tidemark.sinks.versions import ConcurrentMerge, KeyedTable
from tidemark.sources import files, incremental
from tidemark.streaming.upserts import LatestCounts

ROW = "k int, at int, v string"


def keyed(spark, path, **options):
    return KeyedTable(spark, str(path), ROW, ["k"], ["at"], **options)


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def test_merges_split_buckets_and_keep_the_last_row(spark, tmp_path, rows):
    rng, want, table = random.Random(1), {}, keyed(spark, tmp_path / "t", bucket_rows=20)
    for batch in range(4):
        changes = [(rng.randint(0, 60 * (batch + 1)), rng.randint(0, 9), f"{batch}-{i}") for i in range(80)]
        assert table.merge(frame(spark, changes), batch)
        last = {}
        for k, at, v in sorted(changes, key=lambda c: (c[1], c[2])):
            last[k] = (k, at, v)
        for k, row in last.items():
            if k not in want or row[1] >= want[k][1]:
                want[k] = row
        assert rows(table.read()) == sorted(want.values(), key=repr)
        buckets = table.version().buckets
        assert sum(b.rows for b in buckets) == len(want) and max(b.rows for b in buckets) <= 20
        # Prefixes cover all hashes once.
        assert sum(2.0 ** -b.depth for b in buckets) == 1
    assert max(b.depth for b in buckets) >= 3


def test_a_hot_key_splits_no_bucket(spark, tmp_path, rows):
    table = keyed(spark, tmp_path / "t", bucket_rows=10)
    table.merge(spark.range(5000).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("at"), F.lit("x").alias("v")))
    assert len(table.version().buckets) == 1 and rows(table.read()) == [(1, 4999, "x")]


def test_readers_see_a_whole_version(spark, tmp_path, rows):
    table = keyed(spark, tmp_path / "t").create(frame(spark, [(1, 1, "a"), (2, 1, "b")]))
    before = table.read()
    seen = []

    def slowly(current, new):
        seen.append(rows(keyed(spark, tmp_path / "t").read()))       # a reader while the merge runs
        return versions.merge_keyed(current, new, ["k"], ["at"])

    table.apply(frame(spark, [(2, 2, "c"), (3, 1, "d")]), slowly)
    assert seen == [[(1, 1, "a"), (2, 1, "b")]] and rows(before) == [(1, 1, "a"), (2, 1, "b")]
    assert rows(table.read()) == [(1, 1, "a"), (2, 2, "c"), (3, 1, "d")]
    assert rows(table.read(1)) == [(1, 1, "a"), (2, 1, "b")]
    table.merge(frame(spark, [(9, 1, "e")]))
    assert table.vacuum(keep=1) == 2 and table.versions() == [3]
    assert rows(table.read()) == [(1, 1, "a"), (2, 2, "c"), (3, 1, "d"), (9, 1, "e")]


def test_a_batch_counts_once_and_a_failed_merge_changes_nothing(spark, tmp_path, rows):
    table = keyed(spark, tmp_path / "t")
    assert table.read().count() == 0
    assert table.merge(frame(spark, [(1, 1, "a")]), 0) and not table.merge(frame(spark, [(1, 5, "again")]), 0)
    other = keyed(spark, tmp_path / "t")

    def overtaken(current, new):
        other.merge(frame(spark, [(2, 1, "other")]), 1)
        return new

    with pytest.raises(ConcurrentMerge):
        table.apply(frame(spark, [(1, 9, "lost")]), overtaken, 1)
    assert rows(table.read()) == [(1, 1, "a"), (2, 1, "other")]
    assert table.merge(frame(spark, []), 2) and table.version().batch == 2


def test_only_touched_buckets_are_read(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", bucket_rows=10).create(frame(spark, [(i, 0, "") for i in range(200)]))
    near = table.rows_near(frame(spark, [(7, 0, "")]))
    assert 0 < near.count() <= 10 and near.filter("k = 7").count() == 1
    before = {b.folder for b in table.version().buckets}
    table.merge(frame(spark, [(7, 1, "x")]))
    assert len(before - {b.folder for b in table.version().buckets}) == 1


@pytest.mark.parametrize("bucket_rows", [3, 1000])
def test_counts_retract(spark, tmp_path, rows, bucket_rows):
    rng, schema = random.Random(2), "id int, at int, kind string"
    struct = spark.createDataFrame([], schema).schema
    counts = LatestCounts(spark, str(tmp_path / "c"), struct, "kind", ["id"], ["at"], bucket_rows=bucket_rows)
    every = []
    for batch in range(4):
        some = [(rng.randint(0, 12), rng.randint(0, 40), rng.choice(["a", "b", "c", None])) for _ in range(15)]
        # Equal orders are decided by the arrival between batches; keep them apart.
        some = [r for r in some if (r[0], r[1]) not in {(e[0], e[1]) for e in every}]
        every += some
        counts.take(spark.createDataFrame(some, schema), batch)
        counts.take(spark.createDataFrame(some, schema), batch)       # a replay
        whole = spark.createDataFrame(every, schema)
        assert rows(counts.read()) == rows(count_per_key(whole, "kind", mode="latest_per_key", message_key=["id"], order=["at"]))


def test_counts_after_a_failure_between_the_two_tables(spark, tmp_path, rows, monkeypatch):
    schema = "id int, at int, kind string"
    counts = LatestCounts(spark, str(tmp_path / "c"), spark.createDataFrame([], schema).schema, "kind", ["id"], ["at"])
    counts.take(spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], schema), 0)
    with monkeypatch.context() as patched:
        patched.setattr(counts.last, "merge", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            counts.take(spark.createDataFrame([(1, 2, "b")], schema), 1)
    counts.take(spark.createDataFrame([(1, 2, "b")], schema), 1)
    assert rows(counts.read()) == [("a", 1), ("b", 1)]
    counts.take(spark.createDataFrame([(2, 3, None)], schema), 2)
    assert rows(counts.read()) == [("b", 1)]


# ---- write, audit, publish -----------------------------------------------------------------

@pytest.fixture
def raw(spark):
    logs = spark.createDataFrame(
        [("a", "in", f"n{i}", "f", i, "l", 1.0, "free", "x", "GET", "NextSong", 1.0, 7, "s", 200, 1541105830796 + i * 1000,
          "ua", str(i)) for i in range(4)], schemas.LOG_JSON)
    songs = spark.createDataFrame([(None,) * len(spark.createDataFrame([], schemas.SONG_JSON).columns)], schemas.SONG_JSON) \
        .select(*(F.lit({"song_id": "S1", "title": "s", "artist_id": "A1", "artist_name": "a"}[c]).alias(c)
                  if c in ("song_id", "title", "artist_id", "artist_name") else F.col(c).alias(c)
                  for c in spark.createDataFrame([], schemas.SONG_JSON).columns))
    return logs, songs


@pytest.mark.parametrize("truncate", [True, False])
def test_a_failed_gate_leaves_the_old_tables(spark, raw, rows, truncate):
    database = f"gate_{truncate}".lower()
    passes = (["SELECT count(*) > 0 FROM {db}.users", f"SELECT count(*) FROM {database}.users WHERE user_id IS NULL"], [True, 0])
    star.run_warehouse(spark, *raw, database, checks=passes)
    before = {t: rows(spark.table(f"{database}.{t}")) for t in star.TABLES}
    logs = raw[0].withColumn("userId", F.concat(F.lit("9"), "userId"))
    with pytest.raises(QualityError):
        star.run_warehouse(spark, logs, raw[1], database, truncate=truncate,
                           checks=([f"SELECT max(user_id) FROM `{database}`.users"], [3]))
    assert {t: rows(spark.table(f"{database}.{t}")) for t in star.TABLES} == before
    assert not [d.name for d in spark.catalog.listDatabases() if "candidate" in d.name]
    star.run_warehouse(spark, logs, raw[1], database, truncate=truncate,
                       checks=([f"SELECT max(user_id) FROM `{database}`.users"], [93]))
    assert spark.table(f"{database}.users").count() == (4 if truncate else 8)
    assert spark.table(f"{database}.songplays").count() == (4 if truncate else 8)


def test_publishing_moves_no_rows_and_keeps_the_last_version(spark, raw, rows):
    star.run_warehouse(spark, *raw, "moves", checks=(["SELECT 1"], [1]))
    old = spark.table("moves.users")
    first = publish.location_of(spark, "moves.users")
    was = rows(old)
    star.run_warehouse(spark, raw[0].limit(1), raw[1], "moves", checks=(["SELECT 1"], [1]))
    assert publish.location_of(spark, "moves.users") != first
    assert rows(spark.read.parquet(first)) == was              # a reader of the old table can end
    assert spark.table("moves.users").count() == 1
    star.run_warehouse(spark, *raw, "moves", checks=(["SELECT 1"], [1]))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(first)


# ---- sources -------------------------------------------------------------------------------

@pytest.mark.parametrize("ranges", [2, 7, 1024])
def test_polls_are_bounded_by_rows(spark, tmp_path, ranges, monkeypatch):
    monkeypatch.setattr(incremental.cut_key, "__defaults__", (ranges,))
    keys = [1, 2, 3] + [10] * 30 + list(range(50, 90)) + [10 ** 15, 10 ** 15 + 1, 2 ** 62]
    source = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, i int").repartition(3)
    state = incremental.HighWaterMark(spark, str(tmp_path / "marks"), "s")
    out = str(tmp_path / "out")
    marks = []
    while (mark := incremental.poll(source, "k", state, out, max_rows=12)) is not None:
        marks.append(mark)
    landed = spark.read.parquet(out)
    assert landed.count() == len(keys)
    polls = {r["above"]: (r["n"], r["keys"]) for r in landed.groupBy("above").agg(
        F.count("*").alias("n"), F.count_distinct("k").alias("keys")).collect()}
    assert all(n <= 12 or keys == 1 for n, keys in polls.values())
    assert marks[0] == 9 or marks[0] == 3 or marks[0] < 10
    # No poll could have taken the next key as well.
    left = sorted(keys)
    for mark in marks:
        taken = [k for k in left if k <= mark]
        left = left[len(taken):]
        assert not left or len(taken) + left.count(left[0]) > 12


def test_rejected_records_keep_text_and_file(spark, tmp_path, rows):
    (tmp_path / "in/deep").mkdir(parents=True)
    (tmp_path / "in/a.json").write_text('{"n": "1", "t": "x"}\n{"n": \n\n{"n": "2"}\n')
    (tmp_path / "in/deep/b.json").write_text('not json\n{"n": "3", "t": " "}\n')
    spec = schemas.Table("r", (schemas.Field("n", "int"), schemas.Field("t", "string")))
    good = files.stage_json(spark, str(tmp_path / "in"), spec, rejects=str(tmp_path / "bad"))
    assert rows(good) == [(1, "x"), (2, None), (3, None)]
    lost = files.read_rejects(spark, str(tmp_path / "bad")).collect()
    assert sorted((r["record"], r["file"].rsplit("/", 1)[1]) for r in lost) == [("not json", "b.json"), ('{"n": ', "a.json")]
    assert files.stage_json(spark, str(tmp_path / "in"), spec).count() == 5
    star.stage_table(spark, spec, "rejecting", str(tmp_path), "in", rejects=str(tmp_path / "lost"))
    assert files.read_rejects(spark, str(tmp_path / "lost/r")).count() == 2


def test_late_years_leave_the_state(spark, tmp_path):
    """A row too late for its join partner's watermark is lost, though its partner was there."""
    from tidemark.plans import risk
    from tidemark.streaming import sinks
    from tidemark.sources.topics import table_stream
    people = "email string, birthYear string, timestamp timestamp"
    scores = "customer string, score float, timestamp timestamp"
    base = str(tmp_path)
    for part, rows_of in enumerate([
            ([("a", "1990", "2024-01-01"), ("b", "1991", "2024-06-01")], [("a", 1.0, "2024-01-02"), ("b", 2.0, "2024-06-02")]),
            ([("c", "1992", "2024-01-01")], [("a", 3.0, "2024-01-02"), ("b", 4.0, "2024-06-01"), ("c", 5.0, "2024-06-03")])]):
        for name, rows, schema in (("p", rows_of[0], people), ("s", rows_of[1], scores)):
            frame = spark.createDataFrame(rows, schema.replace(" timestamp,", " string,").replace("timestamp timestamp", "timestamp string"))
            frame.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.mode("append").parquet(f"{base}/{name}")
        joined = risk.customer_risk_bounded(table_stream(spark, f"{base}/p", people), table_stream(spark, f"{base}/s", scores),
                                            "10 DAYS", lateness="1 day")
        sinks.to_files(joined, f"{base}/out", f"{base}/check").awaitTermination()
    assert sorted(r["score"] for r in spark.read.parquet(f"{base}/out").collect()) == [1.0, 2.0, 4.0]
    report = {r["name"]: (r["operator"], r["rows"]) for r in sinks.state_report(spark, f"{base}/check").collect()}
    assert list(report) == ["symmetricHashJoin"] and report["symmetricHashJoin"][1] < 7


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    from tidemark.sinks.tables import with_blooms
    import pyarrow.parquet as pq
    # Values too many for a dictionary, spread over all row groups' ranges.
    rows = spark.range(0, 400_000, 1, 4).select("id", F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("other"))
    wanted = rows.filter("id = 7").first()["other"]
    read = {}
    for name, blooms in (("plain", {}), ("bloom", {"other": 50_000})):
        with_blooms(rows.write.option("parquet.block.size", 200_000).option(
            "parquet.enable.dictionary", "false").option("parquet.block.size.row.check.min", 1000), blooms).parquet(str(tmp_path / name))
        frame = spark.read.schema(rows.schema).parquet(str(tmp_path / name)).filter(F.col("other") == wanted)
        assert [r["id"] for r in frame.collect()] == [7]
        metrics = frame._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
        read[name] = metrics.apply("numOutputRows").value()
        assert pq.ParquetFile(next((tmp_path / name).glob("part-00000*"))).num_row_groups > 2
    assert read["bloom"] < read["plain"] / 3


def test_violations_are_counted_while_loading(spark):
    from tidemark.operators.quality import check_table
    from tidemark.sinks import tables as sink
    for sort in ((), ("n",)):
        spec = schemas.Table(f"loaded{len(sort)}", (schemas.Field("n", "int", required=True),
                                                     schemas.Field("t", "string", allowed=("a", "b"))), sort=sort)
        sink.create_tables(spark, [spec], "violating")
        rows = spark.range(4000).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("n"),
                                        F.when(F.col("id") % 3 > 0, "a").otherwise("c").alias("t"))
        found = {}
        loaded = sink.load_table(rows, spec, "violating", violations=found)
        assert found == {r["rule"]: r["violations"] for r in check_table(loaded, spec).collect()}
        assert found == {"not_null:n": 800, "domain:t": 1334}


def test_scripts_keep_semicolons_in_quotes():
    from tidemark.sinks.tables import statements
    assert statements("SELECT ';' AS a; -- not; here\nSELECT \"x;\" /* nor; here */ - 1;;\n `c;d`/2") == [
        "SELECT ';' AS a", "SELECT \"x;\"  - 1", "`c;d`/2"]


def test_colocated_join_has_no_exchange(spark, raw, plan, rows):
    rules = star.VARIANTS["lake"]
    spark.sql("CREATE DATABASE IF NOT EXISTS alike")
    plain = [star.staged(raw[0], rules.staged_logs), star.staged(raw[1], rules.staged_songs)]
    sides = star.colocated(*plain, rules, "alike", 4)
    fact = star.songplays(*sides, rules)
    assert "SortMergeJoin" in plan(fact) and "Exchange" not in plan(fact)
    assert rows(fact.drop("songplay_id")) == rows(star.songplays(*plain, rules).drop("songplay_id")) != []


def test_reports_are_folded(spark, tmp_path):
    from tidemark.streaming import sinks
    path = str(tmp_path / "log")

    def report(*numbers):
        for n in numbers:
            spark.createDataFrame([(n, "t", n, 1.0, 1.0, None, 0, 0, None, 1)], sinks.PROGRESS).coalesce(1).write.mode(
                "append").parquet(path)

    def seen():
        return sorted(r["batch_id"] for r in sinks.read_reports(spark, path).collect())

    def files():
        return len(list((tmp_path / "log").glob("part-*.parquet")))

    report(0, 1, 2)
    assert sinks.fold_reports(spark, path) == 3 and seen() == [0, 1, 2] and files() == 3
    report(3)
    assert seen() == [0, 1, 2, 3] and sinks.fold_reports(spark, path) == 4 and files() == 1
    assert sinks.fold_reports(spark, path) == 4 and seen() == [0, 1, 2, 3]
    report(4)
    assert seen() == [0, 1, 2, 3, 4]
