"""Transit: line field of stations, live status board, entry counts and weather.

The board is one aggregation over events and runs on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import category_colour, line_of_flags, slug, spaced
from ..functions.text import LINES
from ..operators.keyed import last_per_key, latest

CLEAR, SET, ENTRY = 0, 1, 2
NO_TRAIN = "---"

# The weather shown before any report has come in.
WEATHER_DEFAULTS = {"temperature": 70.0, "status": "sunny"}


def with_line(stops: DataFrame) -> DataFrame:
    """Stops with one line field in place of the flags."""
    line = line_of_flags(F.col("red"), F.col("blue"), F.col("green"))
    return stops.select("stop_id", "station_id", "station_name", "order", line.alias("line"))


def stops_on(stops: DataFrame, line: str) -> DataFrame:
    """Stops whose flag of a line is set, in the line's order."""
    if line not in LINES:
        raise ValueError(f"unknown line {line!r}")
    return stops.filter(F.col(line)).orderBy("order", "stop_id")


def station_table(stops: DataFrame) -> DataFrame:
    """The last record of each station in order of stop: the consolidated station table."""
    return last_per_key(with_line(stops), ["station_id"], ["stop_id"]) \
        .select("station_id", "station_name", "order", "line")


def line_stations(stops: DataFrame) -> DataFrame:
    """The stations of each displayed line; a station may be on several."""
    members = with_line(stops).filter(F.col("line").isin(*LINES))
    return last_per_key(members, ["line", "station_id"], ["stop_id"]) \
        .select("line", "station_id", "station_name", "order")


def of_line(messages: DataFrame, topic_part: str, line: str) -> DataFrame:
    """Messages for one line: of topics whose name holds ``topic_part``, with that line."""
    return messages.filter(F.col("topic").contains(topic_part) & (F.col("line") == line))


def routed(messages: DataFrame, topic_part: str) -> DataFrame:
    """Messages for any displayed line; those of other lines are discarded."""
    return messages.filter(F.col("topic").contains(topic_part) & _displayed())


def _displayed() -> Column:
    return F.coalesce(F.col("line").isin(*LINES), F.lit(False))


def _slot(direction: Column) -> Column:
    return F.when(direction == "a", "a").otherwise("b")


def _event(station: Column, slot: Column, kind: int, train: Column | None = None,
           status: Column | None = None) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(
        station.alias("station_id"), slot.alias("slot"), F.lit(kind).alias("kind"),
        (nothing if train is None else train).alias("train_id"),
        (nothing if status is None else status).alias("status"))


def _moves() -> Column:
    """An arrival as events: it clears the slot it left, if that is known, and sets the one it took."""
    left = _event(F.col("prev_station_id"), _slot(F.col("prev_direction")), CLEAR)
    taken = _event(F.col("station_id"), _slot(F.col("direction")), SET, F.col("train_id"),
                   spaced(F.col("train_status")))
    known = F.col("prev_station_id").isNotNull() & F.col("prev_direction").isNotNull()
    return F.when(known, F.array(left, taken)).otherwise(F.array(taken))


def board_events(messages: DataFrame, entry: Column, time: str = "timestamp",
                 offset: str = "offset") -> DataFrame:
    """Arrivals and turnstile entries, told apart by ``entry``, as board events in one pass.

    An entry counts on every line of its station and has no line of its own. An arrival is an
    event of its line; one without line, or of a line not displayed, is discarded.
    """
    # An entry has no fields but the station's, which its moves would leave unread.
    entered = F.array(_event(F.col("station_id"), F.lit(None).cast("string"), ENTRY))
    kept = messages.filter(entry | _displayed())
    return kept.select(
        F.when(~entry, F.col("line")).alias("line"), F.col(time).alias("event_time"),
        F.col(offset).alias("event_offset"), F.explode(F.when(entry, entered).otherwise(_moves())).alias("e"),
    ).select("line", "event_time", "event_offset", "e.*")


def arrival_events(arrivals: DataFrame, time: str = "timestamp",
                   offset: str = "offset") -> DataFrame:
    """Each arrival as one or two board events."""
    return board_events(arrivals, F.lit(False), time, offset)


def entry_events(entries: DataFrame, time: str = "timestamp",
                 offset: str = "offset") -> DataFrame:
    """Each turnstile entry as one board event."""
    return entries.select(
        F.lit(None).cast("string").alias("line"), F.col(time).alias("event_time"),
        F.col(offset).alias("event_offset"),
        _event(F.col("station_id"), F.lit(None).cast("string"), ENTRY).alias("e"),
    ).select("line", "event_time", "event_offset", "e.*")


def _slot_state(slot: str) -> Column:
    """The last event of a slot. One that cleared it has no train."""
    event = F.struct("event_time", "event_offset", "kind", "train_id", "status")
    return F.max(F.when(F.col("slot") == slot, event))


def board_state(events: DataFrame, stations: DataFrame) -> DataFrame:
    """Per line and station: the last event of each slot, and the number of entries.

    Only stations of the dimension count. Works in update and complete mode.
    """
    members = stations.select(F.col("line").alias("on_line"), "station_id")
    known = events.join(members, "station_id", "inner").filter(
        (F.col("kind") == ENTRY) | (F.col("line") == F.col("on_line")))
    return known.groupBy(F.col("on_line").alias("line"), "station_id").agg(
        _slot_state("a").alias("a"), _slot_state("b").alias("b"),
        F.count_if(F.col("kind") == ENTRY).alias("entries"),
    )


def merged_board(current: DataFrame, new: DataFrame) -> DataFrame:
    """Two states of the board as one: later events win their slot, entries add up."""
    return current.unionByName(new).groupBy("line", "station_id").agg(
        F.max("a").alias("a"), F.max("b").alias("b"), F.sum("entries").alias("entries"))


def board_rows(state: DataFrame) -> DataFrame:
    """A state with the train and status in each slot, and the entries so far."""
    return state.select(
        "line", "station_id",
        F.col("a.train_id").alias("train_a"), F.col("a.status").alias("status_a"),
        F.col("b.train_id").alias("train_b"), F.col("b.status").alias("status_b"),
        "entries",
    )


def board(events: DataFrame, stations: DataFrame) -> DataFrame:
    """Per line and station: the train and status in each slot, and the entries so far.

    A station without events appears only in ``board_view``.
    """
    return board_rows(board_state(events, stations))


def board_view(state: DataFrame, stations: DataFrame) -> DataFrame:
    """The board as displayed: all stations by line and order, ``---`` for an empty slot."""
    rank = F.array_position(F.array(*[F.lit(name) for name in LINES]), F.col("line"))
    full = stations.join(state, ["line", "station_id"], "left")
    return full.orderBy(rank, "order", "station_id").select(
        "line", category_colour(F.col("line")).alias("colour"), "station_id", "station_name",
        slug(F.col("station_name")).alias("station_slug"), "order",
        F.coalesce("train_a", F.lit(NO_TRAIN)).alias("train_a"), "status_a",
        F.coalesce("train_b", F.lit(NO_TRAIN)).alias("train_b"), "status_b",
        F.coalesce("entries", F.lit(0)).alias("entries"),
    )


def current_weather(reports: DataFrame, order: list[str]) -> DataFrame:
    """The latest temperature and status, or the defaults."""
    return latest(reports, order, WEATHER_DEFAULTS)
