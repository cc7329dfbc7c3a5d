import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.schemas import Field, Table
from tidemark.sources import files, incremental, topics


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_nested_json_glob(spark, tmp_path):
    for i, part in enumerate(("A/A/A", "A/B/C")):
        write(tmp_path / "song_data" / part / "s.json", json.dumps(
            {"num_songs": 1, "song_id": f"SO{i}", "artist_location": "", "duration": 152.92036}))
    glob = files.read_songs(spark, f"{tmp_path}/song_data/*/*/*/*.json")
    assert {r["song_id"] for r in glob.collect()} == {"SO0", "SO1"}
    assert files.read_json_tree(spark, str(tmp_path), schemas.SONG_JSON).count() == 2


def test_stage_json_by_name_and_mapping(spark, tmp_path):
    record = {"userId": "83", "ts": 1543092353796, "registration": 1540708070796.0,
              "song": " ", "u": {"first": "Ada"}, "length": 205.5, "artist": "x" * 300}
    write(tmp_path / "log.json", json.dumps(record))
    row = files.stage_json(spark, str(tmp_path / "log.json"), schemas.STAGED_LOGS).first()
    assert (row["userId"], row["registration"], row["song"]) == (83, 1540708070796, None)
    assert row["ts"] == dt.datetime(2018, 11, 24, 20, 45, 53, 796000)
    assert len(row["artist"]) == 256
    mapped = files.stage_json(spark, str(tmp_path / "log.json"), schemas.ROUNDED_LOGS,
                              {"firstName": "$.u.first"}).first()
    assert (mapped["firstName"], mapped["length"], mapped["ts"]) == ("Ada", 206, 1543092353796)
    with pytest.raises(ValueError):
        files.with_mapping(schemas.STAGED_LOGS, {"nope": "$.x"})


def test_mapping_file(spark, tmp_path):
    table = Table("t", (Field("a", "int"), Field("b", "string")))
    write(tmp_path / "paths.json", json.dumps({"jsonpaths": ["$['x']", "$.y.z"]}))
    write(tmp_path / "data.json", json.dumps({"x": "5", "y": {"z": "q"}}))
    mapping = files.read_mapping(spark, str(tmp_path / "paths.json"), table)
    assert tuple(files.stage_json(spark, str(tmp_path / "data.json"), table, mapping).first()) == \
        (5, "q")


def test_csv_with_blanks_after_commas(spark, tmp_path, rows):
    write(tmp_path / "p/1.csv", "id, username, currency, amount\n1, kim, EUR, 5\n2, lee, , x\n")
    write(tmp_path / "p/2.csv", 'id, username, currency, amount\n3,"a, b",USD,7\n')
    table = Table("p", (Field("id", "int"), Field("username", "string"),
                        Field("currency", "string"), Field("amount", "int")))
    assert rows(files.stage_csv(spark, str(tmp_path / "p"), table)) == [
        (1, "kim", "EUR", 5), (2, "lee", None, None), (3, "a, b", "USD", 7)]


def test_dated_path():
    assert files.dated_path("s3://logs/", "log_data", dt.date(2018, 11, 2)) == \
        "s3://logs/2018/11/02/log_data"
    assert files.dated_path("s3://logs", "/log_data") == "s3://logs/log_data"


def test_lookup_and_messages(spark, tmp_path):
    write(tmp_path / "codes.json", json.dumps(
        [{"disposition_code": "ABA", "description": "Abated"},
         {"disposition_code": "22", "description": "Cancel"}], indent=2))
    codes = files.read_lookup(spark, str(tmp_path / "codes.json"), schemas.CODE)
    assert codes.count() == 2
    messages = files.explode_to_messages(spark, str(tmp_path / "codes.json"), schemas.CODE, "codes")
    assert messages.schema["value"].dataType.typeName() == "binary"
    values = [json.loads(bytes(r["value"])) for r in messages.collect()]
    assert {"disposition_code": "22", "description": "Cancel"} in values
    assert messages.first()["key"] is None


def test_incremental_polls(spark, tmp_path, rows):
    source = spark.createDataFrame([(i, f"s{i}") for i in range(1, 11)], "stop_id int, name string")
    state = incremental.HighWaterMark(spark, str(tmp_path / "marks"), "stations")
    out = str(tmp_path / "landed")
    assert state.get() is None
    assert incremental.poll(source.filter("stop_id <= 4"), "stop_id", state, out) == 4
    # The second poll lands its rows and fails before it records the mark.
    incremental.rows_after(source, "stop_id", 4, 6).write.parquet(f"{out}/above=4")
    assert incremental.poll(source, "stop_id", state, out, span=3) == 7
    assert incremental.poll(source, "stop_id", state, out) == 10
    assert incremental.poll(source, "stop_id", state, out) is None
    assert incremental.poll(source, "stop_id", state, out, span=5) is None
    landed = spark.read.option("recursiveFileLookup", True).parquet(out)
    assert sorted(r["stop_id"] for r in landed.collect()) == list(range(1, 11))


def test_incremental_bounds_reach_the_scan(spark, tmp_path, plan):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    text = plan(incremental.rows_after(spark.read.parquet(str(tmp_path / "t")), "id", 5, 9))
    assert "GreaterThan(id,5)" in text and "LessThanOrEqual(id,9)" in text


def test_topic_pattern(spark, rows):
    df = spark.createDataFrame([("station.arrivals.ohare",), ("weather",),
                                ("x.station.arrivals.a",)], "topic string")
    assert rows(topics.on_topic(df, pattern=r"station\.arrivals\.\w*")) == \
        [("station.arrivals.ohare",)]
    assert rows(topics.on_topic(df, topic="weather")) == [("weather",)]


def test_kafka_needs_one_subscription(spark):
    with pytest.raises(ValueError):
        topics.kafka_topics(spark, "host:9092")
    with pytest.raises(ValueError):
        topics.kafka_topics(spark, "host:9092", topic="a", pattern="b")


def test_kafka_options_are_accepted_up_to_the_missing_connector(spark, tmp_path):
    from pyspark.errors import AnalysisException, StreamingQueryException
    from tidemark.streaming import sinks
    with pytest.raises(AnalysisException, match="kafka"):
        topics.kafka_topics(spark, "host:9092", pattern=r"^station\.arrivals\.\w*",
                            earliest=False, max_per_trigger=400)
    spark.range(1).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    with pytest.raises((AnalysisException, StreamingQueryException), match="kafka"):
        sinks.to_kafka(rows, "id", "host:9092", "out", str(tmp_path / "ck"))


def test_avro_schema():
    got = json.loads(topics.avro_schema(
        schemas.ARRIVAL, nullable=("prev_station_id", "prev_direction")))
    kinds = {f["name"]: f["type"] for f in got["fields"]}
    assert kinds["station_id"] == "int" and kinds["prev_station_id"] == ["null", "int"]
    weather = json.loads(topics.avro_schema(
        schemas.WEATHER, enums={"status": schemas.WEATHER_STATES}))
    assert weather["fields"][1]["type"]["symbols"] == list(schemas.WEATHER_STATES)


def test_decoded_key_and_value(spark, rows):
    df = spark.createDataFrame(
        [(bytearray(b'{"timestamp": 5}'), bytearray(b'{"temperature": 3, "status": "sunny"}'), 9),
         (None, bytearray(b"bad"), 10)], "key binary, value binary, offset bigint")
    got = topics.decoded(df, schemas.WEATHER, schemas.MESSAGE_KEY, keep=("offset",))
    assert got.columns == ["offset", "timestamp", "temperature", "status"]
    assert rows(got) == [(10, None, None, None), (9, 5, 3, "sunny")]
    with pytest.raises(ValueError):
        topics.decode(F.col("value"), schemas.WEATHER, "xml")


def test_json_arrays_are_bounded(spark):
    """A table that grows gives more arrays, not a longer one."""
    from tidemark.workload import files as workload
    rows = workload._as_arrays(spark.range(4 * workload.ARRAY_KEYS).selectExpr("id", "'x' AS name"), "id").collect()
    sizes = [len(json.loads(r.value)) for r in rows]
    assert sizes == [workload.ARRAY_KEYS] * 4
