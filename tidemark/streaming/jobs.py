"""The streaming jobs from source to sink, as a user starts them.

Each takes message streams (``sources.topics``) and returns started queries.
``base`` is a folder for results and checkpoints; every query has its own below it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.keyed import count_per_key
from ..operators.messages import fields_of
from ..plans import calls, risk, transit
from ..session import stage, staging
from ..sinks.versions import KeyedTable
from ..sources.topics import decode, decoded, kafka_topics, on_topic
from . import sinks

# Pace of the call statistics.
CALLS_EVERY = "17 seconds"
CALLS_PER_TRIGGER = 400


def call_statistics(messages: DataFrame, codes: DataFrame, base: str, mode: str = "complete",
                    every: str | None = CALLS_EVERY) -> StreamingQuery:
    """Described counts per sliding window.

    ``mode="complete"`` keeps and rewrites every window. For an unbounded input
    use ``"update"``: late calls are dropped, old windows leave the state, and
    each trigger writes only the windows that changed
    (``sinks.read_updates(spark, path, CALL_KEYS)``).
    """
    result = calls.call_statistics(messages, codes)
    return sinks.to_batches(result, f"{base}/calls", f"{base}/checkpoint/calls", mode, every)


CALL_KEYS = ["window", "original_crime_type_name", "disposition"]


def call_statistics_from_kafka(spark: SparkSession, servers: str, topic: str, codes: DataFrame,
                               base: str, mode: str = "update", every: str | None = CALLS_EVERY,
                               per_trigger: int | None = CALLS_PER_TRIGGER, **options) -> StreamingQuery:
    """``call_statistics`` of a topic, at most ``per_trigger`` messages at a time."""
    messages = kafka_topics(spark, servers, topic, max_per_trigger=per_trigger, **options)
    return call_statistics(messages, codes, base, mode, every)


def customer_risk(customer_messages: DataFrame, risk_messages: DataFrame, base: str,
                  topic: str = "customer-risk", servers: str | None = None, salts: int = risk.SALTS,
                  within: str | None = None, every: str | None = None) -> StreamingQuery:
    """Scores with email and birth year, as JSON messages keyed by email.

    Published to Kafka if ``servers`` is given, else to ``base``. ``within``
    bounds the time between customer and score, and with it the state.
    """
    if within:
        joined = risk.customer_risk_bounded(
            risk.customers_from(customer_messages, ("timestamp",)),
            risk.risks_from(risk_messages, ("timestamp",)), within)
    else:
        joined = risk.customer_risk(risk.customers_from(customer_messages),
                                    risk.risks_from(risk_messages), salts)
    checkpoint = f"{base}/checkpoint/risk"
    if servers:
        return sinks.to_kafka(joined, "email", servers, topic, checkpoint, every=every)
    return sinks.to_topic_files(joined, "email", topic, f"{base}/risk", checkpoint, every=every)


ARRIVAL_TOPICS = r"station\.arrivals\.\w*"
TURNSTILE_TOPIC = "turnstiles"
WEATHER_TOPIC = "weather"
STOPS_TOPIC = "stations"


def station_changelog(messages: DataFrame, base: str, every: str | None = None) -> StreamingQuery:
    """Stop records to the consolidated station table, as its changelog."""
    stops = decoded(on_topic(messages, STOPS_TOPIC), schemas.STOP)
    return sinks.to_topic_files(transit.station_table(stops), "station_id", "stations.table",
                                f"{base}/stations", f"{base}/checkpoint/stations", "update", every)


#: How the Avro schemas of messages differ from plain columns.
ARRIVAL_AVRO = {"enums": {"train_status": schemas.TRAIN_STATES},
                "nullable": ("prev_station_id", "prev_direction")}
WEATHER_AVRO = {"enums": {"status": schemas.WEATHER_STATES}}


def board_messages(messages: DataFrame, encoding: str = "json") -> DataFrame:
    """Arrivals and turnstile entries with topic, offset, time and the fields of an arrival.

    Each message is decoded once. An entry has the station only.
    """
    entry = F.col("topic") == TURNSTILE_TOPIC
    taken = on_topic(messages, pattern=f"{ARRIVAL_TOPICS}|{TURNSTILE_TOPIC}")
    value = decode(F.col("value"), schemas.ARRIVAL, encoding, **ARRIVAL_AVRO)
    if encoding != "json":       # in JSON the station has the same name in both
        at = decode(F.col("value"), schemas.TURNSTILE, encoding)["station_id"]
        arrival = StructType.fromDDL(schemas.ARRIVAL)
        only = F.struct(*[(at if f.name == "station_id" else F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in arrival.fields])
        value = F.when(entry, only).otherwise(value)
    return fields_of(taken, [decode(F.col("key"), schemas.MESSAGE_KEY, encoding), value],
                     ("topic", "offset"))


#: The board's table: the last event of each slot with its order, and the entries.
_SLOT = "struct<event_time:bigint,event_offset:bigint,kind:int,train_id:string,status:string>"
BOARD_STATE = f"line string, station_id int, a {_SLOT}, b {_SLOT}, entries bigint"


def board_table(spark: SparkSession, base: str) -> KeyedTable:
    return KeyedTable(spark, f"{base}/board", BOARD_STATE, ["line", "station_id"])


def transit_status(messages: DataFrame, stops: DataFrame | Callable[[], DataFrame], base: str, encoding: str = "json",
                   every: str | None = None) -> dict[str, StreamingQuery]:
    """The board, the entry counts and the weather, from one message stream.

    Arrivals and entries pass through the board once, in one query, and are merged into a keyed table. ``stops`` as a function
    is called in each micro-batch, so a station takes part in the board from the first micro-batch that finds it
    there; what came before passed it by. As a frame, the stations are those of the start.
    """
    spark = messages.sparkSession
    fixed = None if callable(stops) else stage(transit.line_stations(stops), "stations")
    entries = decoded(on_topic(messages, TURNSTILE_TOPIC), schemas.TURNSTILE,
                      schemas.MESSAGE_KEY, encoding, ("offset",))
    weather = decoded(on_topic(messages, WEATHER_TOPIC), schemas.WEATHER,
                      schemas.MESSAGE_KEY, encoding, ("offset",), **WEATHER_AVRO)
    table = board_table(spark, base)

    def take(batch: DataFrame, number: int) -> None:
        stations = transit.line_stations(stops()) if callable(stops) else fixed
        events = transit.board_events(batch, F.col("topic") == TURNSTILE_TOPIC)
        with staging(spark):
            new = stage(transit.board_state(events, stations), "board")
            table.apply(new, transit.merged_board, number)
            table.vacuum()

    parts = {
        "entries": count_per_key(entries, "station_id"),
        "weather": transit.current_weather(weather, ["timestamp", "offset"]),
    }
    modes = {"entries": "update", "weather": "complete"}
    board = sinks.to_each(board_messages(messages, encoding), take, f"{base}/checkpoint/board", every, "board")
    return {"board": board} | {
        name: sinks.to_batches(df, f"{base}/{name}", f"{base}/checkpoint/{name}", modes[name],
                               every, name)
        for name, df in parts.items()
    }


def read_board(spark: SparkSession, base: str, stops: DataFrame) -> DataFrame:
    """The board as displayed, from what ``transit_status`` has written so far."""
    state = transit.board_rows(board_table(spark, base).read())
    return transit.board_view(state, transit.line_stations(stops))


def read_weather(spark: SparkSession, base: str) -> DataFrame:
    return sinks.read_complete(spark, f"{base}/weather").select(
        F.col("temperature"), F.col("status"))
