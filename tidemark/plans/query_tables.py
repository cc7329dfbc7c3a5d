"""Query tables from activity logs: one keyed table per question, and the lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import last_per_key
from ..sinks.tables import write_keyed, write_quoted_csv

# Columns of the projected event set, in file order.
EVENT_COLUMNS = ["artist", "firstName", "gender", "itemInSession", "lastName", "length",
                 "level", "location", "sessionId", "song", "userId"]


@dataclass(frozen=True)
class QueryTable:
    partition_key: tuple[str, ...]
    clustering_key: tuple[str, ...] = ()

    @property
    def key(self) -> list[str]:
        return [*self.partition_key, *self.clustering_key]


QUERY_TABLES = {
    "song_by_session": QueryTable(("session_id", "item_in_session")),
    "songs_by_user_session": QueryTable(("user_id", "session_id"), ("item_in_session",)),
    "users_by_song": QueryTable(("song",), ("user_id",)),
}

#: Arrival order of the rows: files are named by day; event times are too coarse to order by.
ORDER = ["source_file", "session_id", "item_in_session"]


def events(logs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows about a song (those with an artist), with the columns of the event set."""
    return logs.filter(F.col("artist") != "").select(*EVENT_COLUMNS, *keep)


def rows(event_set: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The event set with the tables' column names and types; lengths are 32-bit."""
    return event_set.select(
        F.col("sessionId").try_cast("int").alias("session_id"),
        F.col("itemInSession").try_cast("int").alias("item_in_session"),
        F.col("userId").try_cast("int").alias("user_id"),
        F.col("artist").alias("artist_name"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        F.col("length").try_cast("float").alias("duration"),
        "level", "location", "song", *keep,
    )


def query_table(table_rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """The last row of each primary key of a table."""
    return last_per_key(table_rows, QUERY_TABLES[name].key, order)


def song_in_session(table: DataFrame, session_id: int, item: int) -> DataFrame:
    return table.filter(
        (F.col("session_id") == session_id) & (F.col("item_in_session") == item)
    ).select("artist_name", "song", "duration")


def songs_of_user_session(table: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """What a user heard in a session, in the order heard."""
    return table.filter(
        (F.col("user_id") == user_id) & (F.col("session_id") == session_id)
    ).select("item_in_session", "artist_name", "song", "first_name", "last_name") \
        .orderBy("item_in_session")


def users_of_song(table: DataFrame, song: str) -> DataFrame:
    return table.filter(F.col("song") == song).select("first_name", "last_name", "user_id") \
        .orderBy("user_id").select("first_name", "last_name")


def run(logs: DataFrame, out: str, order: list[str] | None = None) -> dict[str, DataFrame]:
    """Write the event set as quoted CSV and each query table; returns the tables.

    ``logs`` are activity rows with a ``source_file`` column.
    """
    order = order or ORDER
    out = out.rstrip("/")
    event_set = events(logs, ("source_file",))
    write_quoted_csv(event_set.select(*EVENT_COLUMNS), f"{out}/events_csv")
    table_rows = rows(event_set, ("source_file",))
    written = {}
    for name, spec in QUERY_TABLES.items():
        table = write_keyed(table_rows, f"{out}/{name}", list(spec.partition_key),
                            list(spec.clustering_key), order)
        written[name] = table.drop("source_file")
    return written
