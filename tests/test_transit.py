import datetime as dt
import json
import random

import pytest

from tidemark import schemas
from tidemark.plans import demand, transit
from tidemark.sources import topics
from tidemark.streaming import jobs, sinks

from test_streams import publish


@pytest.fixture
def stops(spark):
    data = [
        # stop, station, name, order, red, blue, green
        (1, 100, "O'Hare", 0, False, True, False),
        (2, 100, "O'Hare", 0, False, True, False),
        (3, 200, "Clark/Lake", 14, False, False, True),
        (4, 200, "Clark/Lake", 16, False, True, False),     # moves from green to blue
        (5, 300, "Far-South", 9, True, False, False),
        (6, 400, "Elsewhere", 1, False, False, False),
        (7, 300, "Far-South", 10, False, False, False),     # moves from red to none
    ]
    return spark.createDataFrame(
        [(s, "E", n, n, n, i, o, r, b, g) for s, i, n, o, r, b, g in data], schemas.STOP)


def test_station_table(stops, rows):
    assert rows(transit.station_table(stops)) == [
        (100, "O'Hare", 0, "blue"), (200, "Clark/Lake", 16, "blue"),
        (300, "Far-South", 10, "N/A"), (400, "Elsewhere", 1, "N/A")]


def test_line_stations(stops, rows):
    """A station stays on every line it was ever reported on."""
    assert rows(transit.line_stations(stops), "line", "station_id", "order") == [
        ("blue", 100, 0), ("blue", 200, 16), ("green", 200, 14), ("red", 300, 9)]


def test_stops_on_line(stops):
    assert [r["stop_id"] for r in transit.stops_on(stops, "blue").collect()] == [1, 2, 4]
    with pytest.raises(ValueError):
        transit.stops_on(stops, "pink")


def test_routing(spark, rows):
    df = spark.createDataFrame(
        [("stations.table", "red"), ("stations.table", "N/A"), ("weather", "red")],
        "topic string, line string")
    assert rows(transit.routed(df, "station")) == [("stations.table", "red")]
    assert rows(transit.of_line(df, "station", "blue")) == []


def arrival(station, train, direction, line, status="in_service", prev=None, prev_dir=None):
    return dict(station_id=station, train_id=train, direction=direction, line=line,
                train_status=status, prev_station_id=prev, prev_direction=prev_dir)


def replay(members, messages):
    """The board by brute force: apply messages one at a time."""
    board = {}

    def slot(line, station):
        return board.setdefault((line, station), {"a": None, "b": None, "n": 0})

    for kind, m in messages:
        if kind == "turnstiles":
            for line, station in members:
                if station == m["station_id"]:
                    slot(line, station)["n"] += 1
            continue
        prev, prev_dir = m["prev_station_id"], m["prev_direction"]
        if prev is not None and prev_dir is not None and (m["line"], prev) in members:
            slot(m["line"], prev)["a" if prev_dir == "a" else "b"] = None
        if (m["line"], m["station_id"]) in members:
            side = "a" if m["direction"] == "a" else "b"
            slot(m["line"], m["station_id"])[side] = (
                m["train_id"], m["train_status"].replace("_", " "))
    return sorted(
        (line, station, *(s["a"] or (None, None)), *(s["b"] or (None, None)), s["n"])
        for (line, station), s in board.items())


def test_board_over_micro_batches_equals_replay(spark, stops, tmp_path, rows):
    rng = random.Random(3)
    members = {(r["line"], r["station_id"]) for r in transit.line_stations(stops).collect()}
    messages = []
    for n in range(240):
        if rng.random() < 0.3:
            messages.append(("turnstiles", {"station_id": rng.choice([100, 200, 300, 999]),
                                            "station_name": "x", "line": "blue"}))
            continue
        messages.append(("station.arrivals.x", arrival(
            rng.choice([100, 200, 300, 999]), f"T{rng.randrange(6)}", rng.choice("abc"),
            rng.choice(["red", "blue", "green", "pink", None]), rng.choice(schemas.TRAIN_STATES),
            rng.choice([None, 100, 200, 999]), rng.choice([None, "a", "b"]))))
    messages.append(("station.arrivals.x", arrival(300, "LAST", "a", "red")))
    messages.append(("station.arrivals.x", arrival(999, "LAST", "a", "red", prev=300, prev_dir="a")))
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    weather = [json.dumps({"temperature": t, "status": "windy"}) for t in (40, 42)]
    for part in range(3):
        chunk = range(part * 81, min((part + 1) * 81, len(messages)))
        for topic in ("turnstiles", "station.arrivals.x"):
            mine = [i for i in chunk if messages[i][0] == topic]
            spark.createDataFrame(
                # Several messages share a millisecond; the offset decides.
                [(bytearray(json.dumps({"timestamp": i // 5}).encode()),
                  bytearray(json.dumps(messages[i][1]).encode()), topic, 0, i,
                  dt.datetime(2024, 1, 1), 0) for i in mine],
                schemas.ENVELOPE).coalesce(1).write.mode("append").parquet(source)
        if part == 1:
            publish(spark, source, 0, weather, "weather", ['{"timestamp":1}', '{"timestamp":2}'])
        stream = topics.file_topics(spark, source, max_files_per_trigger=1)
        for query in jobs.transit_status(stream, stops, base).values():
            query.awaitTermination()
    state = transit.board_rows(jobs.board_table(spark, base).read())
    assert rows(state) == sorted(replay(members, messages), key=repr)
    entries = sinks.read_updates(spark, f"{base}/entries", ["station_id"])
    want = {}
    for topic, m in messages:
        if topic == "turnstiles":
            want[m["station_id"]] = want.get(m["station_id"], 0) + 1
    assert rows(entries) == sorted(want.items(), key=repr)
    assert tuple(jobs.read_weather(spark, base).first()) == (42.0, "windy")
    view = jobs.read_board(spark, base, stops).collect()
    assert [(r["line"], r["station_id"]) for r in view] == [
        ("blue", 100), ("blue", 200), ("green", 200), ("red", 300)]
    assert view[-1]["train_a"] == "---" and view[0]["station_slug"] == "ohare"
    assert view[0]["colour"] == "#1E90FF"


def test_board_view_without_events(spark, stops):
    stations = transit.line_stations(stops)
    none = transit.entry_events(spark.createDataFrame([], "timestamp bigint, offset bigint, "
                                                          "station_id int"))
    view = transit.board_view(transit.board(none, stations), stations).collect()
    assert len(view) == 4
    assert {(r["train_a"], r["train_b"], r["entries"]) for r in view} == {("---", "---", 0)}


def test_changelog_stream(spark, stops, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    for n, row in enumerate(stops.orderBy("stop_id").collect()):
        publish(spark, source, n, [json.dumps(row.asDict())], "stations")
    stream = topics.file_topics(spark, source, max_files_per_trigger=2)
    jobs.station_changelog(stream, base).awaitTermination()
    last = sinks.read_updates(spark, f"{base}/stations", ["key"]).collect()
    lines = {r["key"]: json.loads(r["value"])["line"] for r in last}
    assert lines == {"100": "blue", "200": "blue", "300": "N/A", "400": "N/A"}
    assert spark.read.parquet(f"{base}/stations").count() > 4     # a log of changes


def test_demand(spark, rows):
    seed = spark.createDataFrame(
        [(1, "A", "10/01/2018", 2400.5, 1200.0, 600.0, 1)], schemas.SEED)
    curve = spark.createDataFrame([(h, 0.01 if h < 12 else 0.05) for h in range(25)],
                                  schemas.CURVE)
    weekday = demand.expected_entries_on(seed, curve, dt.date(2018, 10, 1))
    assert weekday.count() == 24                                  # hour 24 of the curve is not used
    assert rows(weekday.filter("hour IN (0, 23)")) == [(1, 0, 24), (1, 23, 120)]
    saturday = demand.expected_entries_on(seed, curve, dt.date(2018, 10, 6), steps_per_hour=5)
    assert rows(saturday.filter("hour = 23")) == [(1, 23, 12)]
    assert demand.day_kind(dt.date(2018, 10, 7)) == "sunday"
