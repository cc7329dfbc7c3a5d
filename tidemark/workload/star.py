"""Star schema and query tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_parts
from ..operators.joins import join_on
from ..operators.quality import QualityError, check_star
from ..plans import query_tables, star
from ..session import fresh_path, stage
from ..sinks.tables import write_keyed, write_lines
from .inputs import LOGS_SQL, SONGS_SQL, logs, songs
from .registry import register, table


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables hold them."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if f.dataType.typeName() == "timestamp" else F.col(f"`{f.name}`") for f in df.schema
    ])


def _calendar_sql(ts: str, base: int) -> str:
    return (
        f"CAST(hour({ts}) AS INTEGER) AS hour, CAST(day({ts}) AS INTEGER) AS day, "
        f"CAST(week({ts}) AS INTEGER) AS week, CAST(month({ts}) AS INTEGER) AS month, "
        f"CAST(year({ts}) AS INTEGER) AS year, "
        f"CAST(dayofweek({ts}) + {base} AS INTEGER) AS weekday"
    )


_MS = "make_timestamp(ts * 1000)"
_SECOND = "make_timestamp((ts // 1000) * 1000000)"
_CLEAN_USER = "CAST(NULLIF(\"userId\", '') AS INTEGER)"
_CLEAN_LOCATION = "NULLIF(trim(location), '')"
_FACT_ORDER = ("start_time", "user_id", "level", "song_id", "artist_id", "session_id",
               "location", "user_agent")

_SQL = {
    ("warehouse", "songplays"): f"""
WITH {LOGS_SQL}, {SONGS_SQL}, fact AS (
  SELECT DISTINCT {_SECOND} AS start_time, {_CLEAN_USER} AS user_id, level, song_id, artist_id,
    "sessionId" AS session_id, {_CLEAN_LOCATION} AS location, "userAgent" AS user_agent
  FROM logs JOIN songs ON song = title AND artist = artist_name)
SELECT row_number() OVER (ORDER BY {", ".join(f"{c} ASC NULLS FIRST" for c in _FACT_ORDER)}) - 1
  AS songplay_id, * FROM fact""",
    ("warehouse", "users"): f"""
WITH {LOGS_SQL} SELECT DISTINCT {_CLEAN_USER} AS user_id, "firstName" AS first_name,
  "lastName" AS last_name, gender, level FROM logs WHERE "userId" <> ''""",
    ("warehouse", "songs"): f"""
WITH {SONGS_SQL} SELECT DISTINCT song_id, title, artist_id, year, duration FROM songs""",
    ("warehouse", "artists"): f"""
WITH {SONGS_SQL} SELECT DISTINCT artist_id, artist_name AS name,
  NULLIF(artist_location, '') AS location, artist_latitude AS latitude,
  artist_longitude AS longitude FROM songs""",
    ("warehouse", "time"): f"""
WITH {LOGS_SQL}, t AS (SELECT DISTINCT {_MS} AS start_time FROM logs)
SELECT start_time, {_calendar_sql("start_time", 0)} FROM t""",

    ("lake", "songplays"): f"""
WITH {LOGS_SQL}, {SONGS_SQL}
SELECT {_MS} AS start_time, CAST(month({_MS}) AS INTEGER) AS month,
  CAST(year({_MS}) AS INTEGER) AS year, "userId" AS user_id, level, song_id, artist_id,
  "sessionId" AS session_id, location, "userAgent" AS user_agent
FROM logs JOIN songs ON song = title AND artist = artist_name WHERE page = 'NextSong'""",
    ("lake", "users"): f"""
WITH {LOGS_SQL} SELECT "userId" AS user_id, "firstName" AS first_name, "lastName" AS last_name,
  gender, level FROM logs WHERE page = 'NextSong'""",
    ("lake", "songs"): f"""
WITH {SONGS_SQL} SELECT song_id, title, artist_id, year, duration FROM songs""",
    ("lake", "artists"): f"""
WITH {SONGS_SQL} SELECT artist_id, artist_name, artist_location, artist_latitude,
  artist_longitude FROM songs""",
    ("lake", "time"): f"""
WITH {LOGS_SQL}, t AS (SELECT {_MS} AS start_time FROM logs WHERE page = 'NextSong')
SELECT start_time, {_calendar_sql("start_time", 1)} FROM t""",

    ("pipeline", "songplays"): f"""
WITH {LOGS_SQL}, {SONGS_SQL}, plays AS (
  SELECT *, {_SECOND} AS start_time FROM logs WHERE page = 'NextSong')
SELECT md5("sessionId" || strftime(start_time, '%Y-%m-%d %H:%M:%S')) AS songplay_id, start_time,
  {_CLEAN_USER} AS user_id, level, song_id, artist_id, "sessionId" AS session_id,
  {_CLEAN_LOCATION} AS location, "userAgent" AS user_agent
FROM plays LEFT JOIN songs ON song = title AND artist = artist_name
  AND CAST(length AS DECIMAL(18,0)) = CAST(duration AS DECIMAL(18,0))""",
    ("pipeline", "users"): f"""
WITH {LOGS_SQL} SELECT DISTINCT {_CLEAN_USER} AS user_id, "firstName" AS first_name,
  "lastName" AS last_name, gender, level FROM logs WHERE page = 'NextSong'""",
    ("pipeline", "songs"): f"""
WITH {SONGS_SQL} SELECT DISTINCT song_id, title, artist_id, year,
  CAST(duration AS DECIMAL(18,0)) AS duration FROM songs""",
    ("pipeline", "artists"): f"""
WITH {SONGS_SQL} SELECT DISTINCT artist_id, artist_name AS name,
  NULLIF(artist_location, '') AS location, CAST(artist_latitude AS DECIMAL(18,0)) AS latitude,
  CAST(artist_longitude AS DECIMAL(18,0)) AS longitude FROM songs""",
    ("pipeline", "time"): f"""
WITH {LOGS_SQL}, {SONGS_SQL}, t AS (
  SELECT {_SECOND} AS start_time FROM logs LEFT JOIN songs
    ON song = title AND artist = artist_name
    AND CAST(length AS DECIMAL(18,0)) = CAST(duration AS DECIMAL(18,0))
  WHERE page = 'NextSong')
SELECT start_time, {_calendar_sql("start_time", 0)} FROM t""",
}


def _register_star(variant: str, name: str, sql: str) -> None:
    @register(f"star_{variant}_{name}", sql)
    def run(spark, sf_dir):
        built = star.build(logs(spark, sf_dir), songs(spark, sf_dir), variant, (name,))[name]
        # The lake's key is unique but may differ between runs.
        return _naive(built.drop("songplay_id") if variant == "lake" else built)


for (_variant, _name), _sql in _SQL.items():
    _register_star(_variant, _name, _sql)


@register("star_users_latest", f"""
WITH {LOGS_SQL}, last AS (
  SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY ts DESC, "sessionId" DESC,
    "itemInSession" DESC, "firstName" DESC, "lastName" DESC, gender DESC, level DESC) AS rn
  FROM logs WHERE "userId" <> '')
SELECT {_CLEAN_USER} AS user_id, "firstName" AS first_name, "lastName" AS last_name, gender, level
FROM last WHERE rn = 1""")
def users_latest(spark, sf_dir):
    """One row per user, the last by event time."""
    rules = replace(star.VARIANTS["warehouse"], dedup="latest")
    return star.build(logs(spark, sf_dir), songs(spark, sf_dir), rules, ("users",))["users"]


@register("star_checks", f"""
WITH {LOGS_SQL}, {SONGS_SQL},
users AS (SELECT DISTINCT {_CLEAN_USER} AS user_id, "firstName", level FROM logs
  WHERE page = 'NextSong'),
fact AS (SELECT md5("sessionId" || strftime({_SECOND}, '%Y-%m-%d %H:%M:%S')) AS id, ts,
    {_CLEAN_USER} AS user_id
  FROM logs LEFT JOIN songs ON song = title AND artist = artist_name
    AND CAST(length AS DECIMAL(18,0)) = CAST(duration AS DECIMAL(18,0))
  WHERE page = 'NextSong')
SELECT 'users' AS "table", 'unique:user_id' AS rule, count(*) AS violations
FROM (SELECT user_id FROM users GROUP BY user_id HAVING count(*) > 1)
UNION ALL SELECT 'songplays', 'unique:songplay_id', count(*)
FROM (SELECT id FROM fact GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'users', 'not_null:user_id', count(*) FROM users WHERE user_id IS NULL
UNION ALL SELECT 'songplays', 'not_null:songplay_id', count(*) FROM fact WHERE id IS NULL
UNION ALL SELECT 'songplays', 'not_null:start_time', count(*) FROM fact WHERE ts IS NULL
UNION ALL SELECT 'songplays', 'not_null:user_id', count(*) FROM fact WHERE user_id IS NULL""")
def checks(spark, sf_dir):
    """Declared rules of the pipeline's users and fact; a distinct is no unique key."""
    built = star.build(logs(spark, sf_dir), songs(spark, sf_dir), "pipeline",
                       ("users", "songplays"))
    specs = star.VARIANTS["pipeline"].tables
    loaded = {n: stage(df, f"checks-{n}") for n, df in built.items()}
    return check_star(loaded, {n: specs[n] for n in loaded})


# ---- the fact rules on the plain tables ----------------------------------------------

@register("fact_inner", """
SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND year(l_shipdate) = year(o_orderdate)
WHERE l_returnflag = 'R'""")
def fact_inner(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    orders = table(spark, sf_dir, "orders")
    keys = [(line["l_orderkey"], orders["o_orderkey"]),
            (F.year(line["l_shipdate"]), F.year(orders["o_orderdate"]))]
    return join_on(line, orders, keys).select(
        "l_orderkey", "l_linenumber", "l_quantity", "o_custkey", "o_orderstatus")


@register("fact_left_rounded", """
SELECT l_orderkey, l_linenumber, l_partkey, p_name
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  AND CAST(l_quantity AS DECIMAL(18,0)) = CAST(p_size AS DECIMAL(18,0))
WHERE l_returnflag = 'R'""")
def fact_left_rounded(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    whole = "decimal(18,0)"
    keys = [(line["l_partkey"], part["p_partkey"]),
            (line["l_quantity"].cast(whole), part["p_size"].cast(whole))]
    return join_on(line, part, keys, "left", spread_nulls=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_name")


def _time_dim(base: int):
    @register(f"time_dim_base{base}", f"""
SELECT o_orderkey, {_calendar_sql("o_orderdate", base)} FROM orders""")
    def run(spark, sf_dir):
        return table(spark, sf_dir, "orders").select(
            "o_orderkey", *calendar_parts(F.col("o_orderdate"), base))


_time_dim(0)
_time_dim(1)


# ---- query tables ----------------------------------------------------------------------

_ORDER = ["ts", "session_id", "item_in_session", "user_id", "artist_name", "song", "duration",
          "level", "location"]


def _rows(spark, sf_dir) -> DataFrame:
    return query_tables.rows(query_tables.events(logs(spark, sf_dir), ("ts",)), ("ts",))


_ROWS_SQL = f"""{LOGS_SQL}, plays AS (
  SELECT "sessionId" AS session_id, "itemInSession" AS item_in_session,
    CAST("userId" AS INTEGER) AS user_id, artist AS artist_name, "firstName" AS first_name,
    "lastName" AS last_name, gender, CAST(length AS FLOAT) AS duration, level, location, song, ts
  FROM logs WHERE artist <> '')"""


_COLUMNS = ("session_id, item_in_session, user_id, artist_name, first_name, last_name, gender, "
            "duration, level, location, song")


def _last_sql(key: str, columns: str = _COLUMNS, where: str = "true") -> str:
    order = ", ".join(f"{c} DESC" for c in _ORDER)
    return f"""
WITH {_ROWS_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM plays)
SELECT {columns} FROM ranked WHERE rn = 1 AND {where}"""


def _register_query_table(name: str) -> None:
    @register(f"table_{name}", _last_sql(", ".join(query_tables.QUERY_TABLES[name].key)))
    def run(spark, sf_dir):
        return query_tables.query_table(_rows(spark, sf_dir), name, _ORDER).drop("ts")


for _name in query_tables.QUERY_TABLES:
    _register_query_table(_name)


def _last_play(spark, sf_dir):
    """The key of the last play of the highest session, to look up."""
    key = F.max(F.struct("session_id", "item_in_session", "user_id"))
    return _rows(spark, sf_dir).agg(key).first()[0]


def _asked(columns: str) -> str:
    return (f"({columns}) = (SELECT ({columns}) FROM plays\n"
            "  ORDER BY session_id DESC, item_in_session DESC, user_id DESC LIMIT 1)")


def _keyed(spark, sf_dir, name: str):
    """The query table as the job writes it, clustered by its key."""
    spec = query_tables.QUERY_TABLES[name]
    return write_keyed(_rows(spark, sf_dir), fresh_path(spark, name), list(spec.partition_key),
                       list(spec.clustering_key), _ORDER)


@register("lookup_song_in_session", _last_sql(
    "session_id, item_in_session", "artist_name, song, duration",
    _asked("session_id, item_in_session")))
def lookup_song(spark, sf_dir):
    t = _keyed(spark, sf_dir, "song_by_session")
    play = _last_play(spark, sf_dir)
    return query_tables.song_in_session(t, play["session_id"], play["item_in_session"])


@register("lookup_songs_of_user_session", _last_sql(
    "user_id, session_id, item_in_session",
    "item_in_session, artist_name, song, first_name, last_name", _asked("user_id, session_id")))
def lookup_user_session(spark, sf_dir):
    t = _keyed(spark, sf_dir, "songs_by_user_session")
    play = _last_play(spark, sf_dir)
    return query_tables.songs_of_user_session(t, play["user_id"], play["session_id"])


@register("lookup_users_of_song", _last_sql(
    "song, user_id", "first_name, last_name", "song = 'Song 10'"))
def lookup_users(spark, sf_dir):
    return query_tables.users_of_song(_keyed(spark, sf_dir, "users_by_song"), "Song 10")


@register("star_pipeline_published", _SQL["pipeline", "songplays"])
def pipeline_published(spark, sf_dir):
    """The pipeline job from files to published tables. A run whose gate fails in between leaves them as they were."""
    root = fresh_path(spark, "pipeline-files")
    write_lines(logs(spark, sf_dir), f"{root}/log_data/2018/11")
    write_lines(songs(spark, sf_dir), f"{root}/song_data/A/B")
    database = "tidemark_" + root.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}-tables'")
    star.run_pipeline(spark, root, database)
    try:
        star.run_pipeline(spark, root, database, checks=(["SELECT count(*) FROM {db}.songplays"], [-1]))
    except QualityError:
        return _naive(spark.table(f"{database}.songplays"))
    raise AssertionError("a check that does not hold passed")


@register("star_colocated_songplays", _SQL["lake", "songplays"])
def colocated_songplays(spark, sf_dir):
    """The lake's fact from tables that are bucketed by artist and title."""
    rules = star.VARIANTS["lake"]
    path = fresh_path(spark, "colocated")
    database = "tidemark_" + path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    sides = star.colocated(star.staged(logs(spark, sf_dir), rules.staged_logs),
                           star.staged(songs(spark, sf_dir), rules.staged_songs), rules, database, 8)
    return _naive(star.songplays(*sides, rules).drop("songplay_id"))
