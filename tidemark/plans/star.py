"""Star schema of song plays: one fact and four dimensions, under selectable rules.

The same five tables exist under three sets of rules (``VARIANTS``), which
differ in staging, filters, join, keys and de-duplication. A ``Rules`` value
states each choice, so a caller may also mix them with ``dataclasses.replace``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (calendar_parts, dense_key, hash_key, millis_to_second,
                         millis_to_timestamp, sparse_key, to_second)
from ..operators.joins import join_on
from ..operators.keyed import last_per_key
from ..operators.quality import run_checks
from ..operators.staging import normalise
from ..schemas import Table
from ..session import stage, staging
from ..sinks import tables as sink
from ..sinks.publish import Candidates
from ..sources import files

PLAY = "NextSong"
TABLES = ("songplays", "users", "songs", "artists", "time")


@dataclass(frozen=True)
class Rules:
    tables: dict[str, Table]                  # declared output tables
    staged_logs: Table | None = None          # None: take the raw records as they are
    staged_songs: Table | None = None
    plays_only: frozenset[str] = frozenset()  # tables built from page = NextSong only
    join: str = "inner"                       # inner | left
    match_length: bool = False                # also match length to duration, rounded
    fact_distinct: bool = False
    fact_key: str = "sparse"                  # dense (by content) | identity | sparse | md5
    fact_time: str = "millisecond"            # second | millisecond
    dedup: str = "none"                       # none | distinct | latest
    time_distinct: bool = False
    not_null: tuple[tuple[str, str], ...] = ()  # (table, raw column that must be present)
    time_from: str = "logs"                   # logs | songplays
    weekday_base: int = 0                     # number of Sunday


VARIANTS = {
    "warehouse": Rules(
        tables=schemas.WAREHOUSE,
        staged_logs=schemas.STAGED_LOGS, staged_songs=schemas.STAGED_SONGS,
        fact_distinct=True, fact_key="dense", fact_time="second",
        dedup="distinct", time_distinct=True,
        not_null=(("users", "userId"), ("songs", "song_id"), ("artists", "artist_id"),
                  ("time", "ts")),
    ),
    "lake": Rules(
        tables=schemas.LAKE,
        plays_only=frozenset({"songplays", "users", "time"}),
        not_null=(("users", "userId"), ("songs", "song_id"), ("artists", "song_id"),
                  ("time", "ts"), ("songplays", "ts")),
        weekday_base=1,
    ),
    "pipeline": Rules(
        tables=schemas.PIPELINE,
        staged_logs=schemas.ROUNDED_LOGS, staged_songs=schemas.ROUNDED_SONGS,
        plays_only=frozenset({"songplays", "users"}),
        join="left", match_length=True, fact_key="md5", fact_time="second",
        dedup="distinct", time_from="songplays",
    ),
}


def rules_of(variant: str | Rules) -> Rules:
    return variant if isinstance(variant, Rules) else VARIANTS[variant]


def staged(df: DataFrame, table: Table | None) -> DataFrame:
    return normalise(df, table) if table else df


def _keep(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """Apply the page and not-null filters that hold for a table."""
    if table in rules.plays_only:
        df = df.filter(F.col("page") == PLAY)
    for name, column in rules.not_null:
        if name == table:
            df = df.filter(F.col(column).isNotNull())
    return df


def _event_time(df: DataFrame, precision: str):
    ts = F.col("ts")
    if df.schema["ts"].dataType.typeName() == "timestamp":
        return to_second(ts) if precision == "second" else ts
    return millis_to_second(ts) if precision == "second" else millis_to_timestamp(ts)


def songplays(logs: DataFrame, songs: DataFrame, rules: Rules, first_key: int = 0) -> DataFrame:
    """The fact: plays matched to songs by artist and title."""
    spec = rules.tables["songplays"]
    plays = _keep(logs, "songplays", rules).select(
        "artist", "song", "length", "userId", "level", "sessionId", "location", "userAgent",
        _event_time(logs, rules.fact_time).alias("start_time"),
    )
    known = songs.select("title", "artist_name", "duration", "song_id", "artist_id")
    keys = [(plays["artist"], known["artist_name"]), (plays["song"], known["title"])]
    if rules.match_length:
        whole = "decimal(18,0)"
        keys.append((plays["length"].cast(whole), known["duration"].cast(whole)))
    joined = join_on(plays, known, keys, rules.join, spread_nulls=True)
    named = {
        "start_time": F.col("start_time"),
        "month": F.month("start_time"),
        "year": F.year("start_time"),
        "user_id": F.col("userId"),
        "level": F.col("level"),
        "song_id": F.col("song_id"),
        "artist_id": F.col("artist_id"),
        "session_id": F.col("sessionId"),
        "location": F.col("location"),
        "user_agent": F.col("userAgent"),
    }
    body = [n for n in spec.names if n != "songplay_id"]
    fact = joined.select(*[named[n].alias(n) for n in body])
    if rules.fact_distinct:
        fact = fact.distinct()
    if rules.fact_key in ("dense", "identity"):
        order = body if rules.fact_key == "dense" else None
        return dense_key(fact, order, "songplay_id", first_key)
    if rules.fact_key == "md5":
        stamp = F.date_format("start_time", "yyyy-MM-dd HH:mm:ss")
        return fact.select(hash_key(F.col("session_id"), stamp).alias("songplay_id"), *body)
    return fact.select(sparse_key().alias("songplay_id"), *body)


def colocated(logs: DataFrame, songs: DataFrame, rules: Rules, database: str,
              buckets: int) -> tuple[DataFrame, DataFrame]:
    """Staged logs and songs for an inner ``songplays``, in tables bucketed alike by artist and title.

    Both sides of the fact's join lie in matching buckets, so it moves no rows; a load that joins the same tables again, or others
    by the same key, shares the one shuffle of this write. Rows without artist or title match nothing and are left out.
    """
    if rules.join != "inner":
        raise ValueError("rows without a match would be lost")
    sides = {"logs_by_song": (_keep(logs, "songplays", rules), ["artist", "song"]),
             "songs_by_title": (songs, ["artist_name", "title"])}
    spark = logs.sparkSession
    for name, (rows, key) in sides.items():
        sink.write_bucketed(rows.dropna(subset=key), f"`{database}`.{name}", buckets, key)
    plays, known = (spark.table(f"`{database}`.{name}") for name in sides)
    return plays, known.hint("merge")


def _dimension(df: DataFrame, rules: Rules, key: str, order: list[str],
               columns: dict[str, str]) -> DataFrame:
    """Project, rename and de-duplicate. ``columns`` maps target to source names."""
    if rules.dedup == "latest":
        payload = [source for target, source in columns.items() if source != key]
        df = last_per_key(df.select(*dict.fromkeys([*columns.values(), *order])), [key],
                          order, payload)
    out = df.select(*[F.col(source).alias(target) for target, source in columns.items()])
    return out.distinct() if rules.dedup == "distinct" else out


def _renames(spec: Table, source: dict[str, str]) -> dict[str, str]:
    return {n: source.get(n, n) for n in spec.names}


def users(logs: DataFrame, rules: Rules) -> DataFrame:
    columns = _renames(rules.tables["users"], {
        "user_id": "userId", "first_name": "firstName", "last_name": "lastName"})
    return _dimension(_keep(logs, "users", rules), rules, "userId",
                      ["ts", "sessionId", "itemInSession"], columns)


def songs_dimension(songs: DataFrame, rules: Rules) -> DataFrame:
    columns = _renames(rules.tables["songs"], {})
    return _dimension(_keep(songs, "songs", rules), rules, "song_id",
                      ["year", "title", "duration"], columns)


def artists(songs: DataFrame, rules: Rules) -> DataFrame:
    columns = _renames(rules.tables["artists"], {
        "name": "artist_name", "location": "artist_location",
        "latitude": "artist_latitude", "longitude": "artist_longitude"})
    return _dimension(_keep(songs, "artists", rules), rules, "artist_id",
                      ["year", "song_id"], columns)


def time(source: DataFrame, rules: Rules) -> DataFrame:
    """Calendar parts of the event times of the logs, or of the fact's start times."""
    if rules.time_from == "songplays":
        stamps = source.select("start_time")
    else:
        stamps = _keep(source, "time", rules).select(
            _event_time(source, "millisecond").alias("start_time"))
    if rules.time_distinct or rules.dedup == "latest":
        stamps = stamps.distinct()
    return stamps.select("start_time", *calendar_parts(F.col("start_time"), rules.weekday_base))


def build(logs: DataFrame, songs: DataFrame, variant: str | Rules,
          only: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """The star's tables from raw logs and songs."""
    rules = rules_of(variant)
    song_rows = staged(songs, rules.staged_songs)

    def rows_for(name: str) -> DataFrame:
        # The raw page is compared before it is normalised, so the filter reaches the scan.
        raw = logs.filter(F.col("page") == PLAY) if name in rules.plays_only else logs
        return staged(raw, rules.staged_logs)

    def fact() -> DataFrame:
        return songplays(rows_for("songplays"), song_rows, rules)

    make = {
        "songplays": fact,
        "users": lambda: users(rows_for("users"), rules),
        "songs": lambda: songs_dimension(song_rows, rules),
        "artists": lambda: artists(song_rows, rules),
        "time": lambda: time(
            fact() if rules.time_from == "songplays" else rows_for("time"), rules),
    }
    return {name: make[name]() for name in only}


#: Partition columns of each lake table.
LAKE_PARTITIONS = {"songs": ["year"], "time": ["year", "month"],
                   "songplays": ["year", "month"], "users": [], "artists": []}


def as_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Name the tables for use in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def run_lake(logs: DataFrame, songs: DataFrame, out: str,
             partitions: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Write the lake variant as partitioned Parquet; returns the path of each table.

    The raw records are parsed once and staged as Parquet, from which each table
    reads its own columns, until the tables are written. Songs have a folder per year, sorted by
    artist within its files. ``{"songs": ["year", "artist_id"]}`` makes one folder per artist and
    year; a warning tells when these are too many.
    """
    partitions = LAKE_PARTITIONS | (partitions or {})
    paths = {name: f"{out.rstrip('/')}/{name}" for name in TABLES}
    with staging(logs.sparkSession):
        logs = stage(logs.filter(F.col("page") == PLAY), "lake-logs")
        songs = stage(songs, "lake-songs")
        if len(partitions["songs"]) > 1:
            sink.warn_if_many_directories(songs, partitions["songs"])
        for name, df in build(logs, songs, "lake").items():
            sort = ["artist_id"] if name == "songs" and partitions[name] == ["year"] else []
            sink.write_parquet(df, paths[name], partitions[name], sort=sort)
    return paths


def stage_table(spark: SparkSession, table: Table, database: str, root: str, key: str,
                run_date: dt.date | None = None, file_format: str = "json",
                mapping: dict[str, str] | None = None, rejects: str | None = None) -> DataFrame:
    """Replace a staging table by the files below ``root/key``, or below a run date's folder.

    ``rejects`` is a folder that gets the malformed JSON records, below the table's name.
    """
    path = files.dated_path(root, key, run_date)
    with staging(spark):
        if file_format.lower() == "csv":
            rows = files.stage_csv(spark, path, table)
        elif file_format.lower() == "json":
            rows = files.stage_json(spark, path, table, mapping, rejects and f"{rejects.rstrip('/')}/{table.name}")
        else:
            raise ValueError(f"unknown file format {file_format!r}")
        sink.create_tables(spark, [table], database)
        return sink.load_table(rows, table, database, truncate=True)


def load_star(spark: SparkSession, log_rows: DataFrame, song_rows: DataFrame, rules: Rules,
              database: str, truncate: bool = True,
              checks: tuple[list[str], list[object]] | None = None) -> dict[str, Table]:
    """Load the star from staged rows: the fact and its dimensions, then the checks, and publish what passed.

    With checks, all tables are loaded aside. The checks' queries read them there, by names qualified with the
    database or with ``{db}``. If one fails, its error is raised and the database's tables stay as they were.
    With the pipeline's rules the time table is read back from the loaded fact
    instead of joining again.
    """
    if rules.fact_key == "dense":
        # An identity column promises no order; loading sorts the rows in its own way.
        rules = replace(rules, fact_key="identity")
    sink.create_tables(spark, rules.tables.values(), database)
    first_key = 0
    if rules.fact_key == "identity" and not truncate:
        loaded = sink.read_table(spark, rules.tables["songplays"], database)
        first_key = loaded.agg(F.coalesce(F.max("songplay_id") + 1, F.lit(0))).first()[0]
    candidates = Candidates(spark, rules.tables.values(), database, truncate) if checks else None

    def load(name: str, df: DataFrame) -> DataFrame:
        if candidates:
            return candidates.load(df, rules.tables[name])
        return sink.load_table(df, rules.tables[name], database, truncate)

    try:
        fact = load("songplays", songplays(log_rows, song_rows, rules, first_key))
        load("users", users(log_rows, rules))
        load("songs", songs_dimension(song_rows, rules))
        load("artists", artists(song_rows, rules))
        load("time", time(fact if rules.time_from == "songplays" else log_rows, rules))
        if candidates:
            queries, expected = checks
            run_checks(spark, [candidates.redirected(q) for q in queries], expected)
    except BaseException:
        if candidates:
            candidates.discard()
        raise
    if candidates:
        candidates.publish()
    return rules.tables


def run_warehouse(spark: SparkSession, logs: DataFrame, songs: DataFrame, database: str,
                  variant: str | Rules = "warehouse", truncate: bool = True,
                  checks: tuple[list[str], list[object]] | None = None) -> dict[str, Table]:
    """Load the star into catalog tables from raw records, which are staged once."""
    rules = rules_of(variant)
    with staging(spark):
        log_rows = stage(staged(logs, rules.staged_logs), "staged-logs")
        song_rows = stage(staged(songs, rules.staged_songs), "staged-songs")
        return load_star(spark, log_rows, song_rows, rules, database, truncate, checks)


#: The pipeline's quality gate: users and songs without a key.
GATE = ("SELECT count(*) FROM {db}.users WHERE user_id IS NULL",
        "SELECT count(*) FROM {db}.songs WHERE song_id IS NULL")


def run_pipeline(spark: SparkSession, root: str, database: str, variant: str = "pipeline",
                 run_date: dt.date | None = None, log_mapping: dict[str, str] | None = None,
                 log_key: str = "log_data", song_key: str = "song_data", rejects: str | None = None,
                 checks: tuple[list[str], list[object]] = (list(GATE), [0] * len(GATE))) -> dict[str, Table]:
    """Stage both sources from files, load the star aside, and publish it if it passes the quality gate."""
    rules = rules_of(variant)
    logs = stage_table(spark, rules.staged_logs, database, root, log_key, run_date,
                       mapping=log_mapping, rejects=rejects)
    songs = stage_table(spark, rules.staged_songs, database, root, song_key, rejects=rejects)
    return load_star(spark, logs, songs, rules, database, checks=checks)
