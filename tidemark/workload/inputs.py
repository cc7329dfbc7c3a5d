"""Job inputs derived from the given tables, in Spark and as SQL.

Only projections: the derived inputs have one row per row of their table and
cost no shuffle. The SQL text beside each is the same projection for the twin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import emit_json
from ..session import fresh_path, size_of
from ..sources.topics import table_stream
from .registry import table


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# ---- activity logs (lineitem) and songs (part) -----------------------------------

def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as activity records: order = session, supplier = user, part = song."""
    c = F.col
    play = c("l_returnflag") != "R"
    day_millis = (c("l_orderkey") * 1009 + c("l_linenumber") * 137) % 86400000
    return table(spark, sf_dir, "lineitem").select(
        F.when(play, _text("Artist ", c("l_partkey") % 997)).alias("artist"),
        F.lit("Logged In").alias("auth"),
        _text("First", c("l_suppkey")).alias("firstName"),
        F.when(c("l_suppkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        c("l_linenumber").alias("itemInSession"),
        _text("Last", c("l_suppkey")).alias("lastName"),
        F.when(play, c("l_quantity") + c("l_tax")).alias("length"),
        F.when(c("l_linestatus") == "O", "paid").otherwise("free").alias("level"),
        F.when(c("l_linenumber") == 1, "  ").when(c("l_linenumber") == 2, "")
        .otherwise(_text("City ", c("l_suppkey") % 50)).alias("location"),
        F.lit("PUT").alias("method"),
        F.when(play, "NextSong").otherwise("Home").alias("page"),
        (c("l_suppkey") + 1500000000000).cast("double").alias("registration"),
        c("l_orderkey").cast("int").alias("sessionId"),
        F.when(play, _text("Song ", c("l_partkey"))).alias("song"),
        F.lit(200).alias("status"),
        (F.unix_millis(c("l_shipdate").cast("timestamp")) + day_millis).alias("ts"),
        _text("Agent ", c("l_linestatus")).alias("userAgent"),
        F.when(~play & (c("l_linenumber") == 7), "")
        .otherwise(c("l_suppkey").cast("string")).alias("userId"),
    )


LOGS_SQL = """logs AS (
  SELECT CASE WHEN l_returnflag <> 'R' THEN 'Artist ' || (l_partkey % 997) END AS artist,
    'First' || l_suppkey AS "firstName",
    CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    l_linenumber AS "itemInSession", 'Last' || l_suppkey AS "lastName",
    CASE WHEN l_returnflag <> 'R' THEN l_quantity + l_tax END AS length,
    CASE WHEN l_linestatus = 'O' THEN 'paid' ELSE 'free' END AS level,
    CASE l_linenumber WHEN 1 THEN '  ' WHEN 2 THEN '' ELSE 'City ' || (l_suppkey % 50) END
      AS location,
    CASE WHEN l_returnflag <> 'R' THEN 'NextSong' ELSE 'Home' END AS page,
    CAST(l_orderkey AS INTEGER) AS "sessionId",
    CASE WHEN l_returnflag <> 'R' THEN 'Song ' || l_partkey END AS song,
    epoch_ms(l_shipdate) + (l_orderkey * 1009 + l_linenumber * 137) % 86400000 AS ts,
    'Agent ' || l_linestatus AS "userAgent",
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN ''
      ELSE CAST(l_suppkey AS VARCHAR) END AS "userId"
  FROM lineitem)"""


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as song records; titles of large parts differ from those played."""
    c = F.col
    return table(spark, sf_dir, "part").select(
        F.lit(1).alias("num_songs"),
        _text("AR", c("p_partkey") % 997).alias("artist_id"),
        F.when(c("p_size") >= 5, c("p_retailprice") / 10).alias("artist_latitude"),
        (c("p_size") * -1.5).alias("artist_longitude"),
        F.when(c("p_size") % 2 == 0, "").otherwise(c("p_type")).alias("artist_location"),
        _text("Artist ", c("p_partkey") % 997).alias("artist_name"),
        _text("SO", c("p_partkey")).alias("song_id"),
        F.when(c("p_size") > 40, _text("Song ", c("p_partkey"), " (live)"))
        .otherwise(_text("Song ", c("p_partkey"))).alias("title"),
        (c("p_size") + 0.25).alias("duration"),
        F.when(c("p_size") < 10, 0).otherwise(c("p_size") + 1950).alias("year"),
    )


SONGS_SQL = """songs AS (
  SELECT 'AR' || (p_partkey % 997) AS artist_id,
    CASE WHEN p_size >= 5 THEN p_retailprice / 10 END AS artist_latitude,
    CAST(p_size AS DOUBLE) * CAST(-1.5 AS DOUBLE) AS artist_longitude,
    CASE WHEN p_size % 2 = 0 THEN '' ELSE p_type END AS artist_location,
    'Artist ' || (p_partkey % 997) AS artist_name, 'SO' || p_partkey AS song_id,
    'Song ' || p_partkey || CASE WHEN p_size > 40 THEN ' (live)' ELSE '' END AS title,
    CAST(p_size AS DOUBLE) + CAST(0.25 AS DOUBLE) AS duration,
    CASE WHEN p_size < 10 THEN 0 ELSE p_size + 1950 END AS year
  FROM part)"""


# ---- streams over the tables -------------------------------------------------------

#: Bytes of a table that one micro-batch takes at most, and micro-batches that a table takes at least.
PER_TRIGGER, DELIVERIES = 512 * 1024**3, 3


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of its files in several micro-batches.

    One of too few files is first written as more: each micro-batch reads whole files, so it needs one for every core.
    """
    rows = table(spark, sf_dir, name)
    # A glob, since a stream source takes a folder or a glob but no single file.
    path = f"{sf_dir}/[{name[0]}]{name[1:]}.parquet"
    files, spare = DELIVERIES * spark.sparkContext.defaultParallelism, 0
    if len(rows.inputFiles()) < files:
        path = fresh_path(spark, f"deliveries-{name}")
        rows.repartition(files).write.parquet(path)
        # Half a file on top, since files that differ by a few bytes would leave one to a fourth micro-batch.
        spare = size_of(spark, path) // (2 * files)
    each = max(1, -(-size_of(spark, path) // DELIVERIES) + spare)
    return table_stream(spark, path, rows.schema, min(PER_TRIGGER, each))


# ---- calls (events) and their codes (nation) ---------------------------------------

def call_messages(events: DataFrame) -> DataFrame:
    """Events as call messages; some are malformed and some have no disposition."""
    c = F.col
    record = emit_json(
        c("event_id").cast("string").alias("client_id"),
        c("event_type").alias("original_crime_type_name"),
        c("ts").cast("timestamp").alias("call_date_time"),
        F.when(c("user_id") % 30 != 7, _text("D", c("user_id") % 30)).alias("disposition"),
    )
    malformed = (c("event_type") == "error") & (c("value") < 5)
    return events.select(F.when(malformed, '{"bad').otherwise(record).cast("binary").alias("value"))


def shared_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of which several have one description."""
    return table(spark, sf_dir, "nation").select(
        _text("D", F.col("n_nationkey")).alias("disposition_code"),
        _text("region ", F.col("n_regionkey")).alias("description"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        _text("D", F.col("n_nationkey")).alias("disposition_code"),
        F.col("n_name").alias("description"))


CALLS_SQL = """calls AS (
  SELECT event_type AS original_crime_type_name, ts AS call_date_time,
    CASE WHEN user_id % 30 <> 7 THEN 'D' || (user_id % 30) END AS disposition
  FROM events WHERE NOT (event_type = 'error' AND value < 5)),
codes AS (SELECT 'D' || n_nationkey AS disposition, n_name AS description FROM nation)"""


# ---- customers (customer) and risk scores (orders) ---------------------------------

def _email(key: Column) -> Column:
    return _text("customer", key, "@test.com")


def customer_messages(customers: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Customers in a sorted-set envelope, base64 in JSON.

    Some envelopes have no entry, some an entry that does not decode, and some
    customers no birthday.
    """
    c = F.col
    record = emit_json(
        c("c_name").alias("customerName"), _email(c("c_custkey")).alias("email"),
        F.lit("8015551212").alias("phone"),
        F.when(c("c_acctbal") >= 0, F.concat((c("c_custkey") % 60 + 1940).cast("string"),
                                             F.lit("-01-03"))).alias("birthDay"),
    )
    element = F.when(c("c_nationkey") == 1, "not base64!").otherwise(F.base64(record.cast("binary")))
    entry = F.struct(element.alias("element"), F.lit("0.0").alias("score"))
    none = F.array().cast("array<struct<element:string,score:string>>")
    return customers.select(*keep, emit_json(
        F.base64(F.lit("Customer").cast("binary")).alias("key"),
        F.lit("NONE").alias("existType"), F.lit(False).alias("incr"),
        F.when(c("c_nationkey") == 0, none).otherwise(F.array(entry)).alias("zSetEntries"),
    ).cast("binary").alias("value"))


def risk_messages(orders: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    c = F.col
    return orders.select(*keep, emit_json(
        _email(c("o_custkey")).alias("customer"), c("o_totalprice").alias("score"),
        c("o_orderdate").cast("timestamp").alias("riskDate"),
    ).cast("binary").alias("value"))


CUSTOMERS_SQL = """customers AS (
  SELECT c_custkey, c_name AS "customerName", 'customer' || c_custkey || '@test.com' AS email,
    '8015551212' AS phone, (c_custkey % 60 + 1940) || '-01-03' AS "birthDay",
    CAST(c_custkey % 60 + 1940 AS VARCHAR) AS "birthYear"
  FROM customer WHERE c_nationkey NOT IN (0, 1) AND c_acctbal >= 0),
risks AS (
  SELECT 'customer' || o_custkey || '@test.com' AS customer, CAST(o_totalprice AS FLOAT) AS score
  FROM orders)"""


# ---- transit: stops (part), arrivals and entries (events) --------------------------

def stops(parts: DataFrame) -> DataFrame:
    """Parts as stops, two to a station."""
    c = F.col
    return parts.select(
        c("p_partkey").cast("int").alias("stop_id"),
        F.call_function("div", c("p_partkey"), F.lit(2)).cast("int").alias("station_id"),
        _text(c("p_name"), "/", c("p_brand")).alias("station_name"),
        c("p_size").alias("order"),
        (c("p_size") <= 15).alias("red"),
        c("p_size").between(10, 30).alias("blue"),
        c("p_size").between(31, 40).alias("green"),
    )


STOPS_SQL = """stops AS (
  SELECT CAST(p_partkey AS INTEGER) AS stop_id, CAST(p_partkey // 2 AS INTEGER) AS station_id,
    p_name || '/' || p_brand AS station_name, p_size AS "order",
    CASE WHEN p_size <= 15 THEN 'red' WHEN p_size BETWEEN 10 AND 30 THEN 'blue'
      WHEN p_size BETWEEN 31 AND 40 THEN 'green' ELSE 'N/A' END AS line
  FROM part),
members AS (
  SELECT line, station_id, arg_max(station_name, stop_id) AS station_name,
    arg_max("order", stop_id) AS "order"
  FROM stops WHERE line <> 'N/A' GROUP BY line, station_id)"""

_LINE_OF = ["red", "blue", "green"]


def _props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def board_messages(events: DataFrame) -> DataFrame:
    """Events as arrivals (user = station, ``props.k`` = train), errors as turnstile entries.

    Some arrivals are of no line, and some of a line that is not displayed.
    """
    c = F.col
    k = _props_k()
    return events.select(
        (c("event_type") == "error").alias("entry"),
        F.unix_millis(c("ts").cast("timestamp")).alias("timestamp"),
        c("event_id").alias("offset"),
        F.when(k % 11 == 5, None).when(k % 13 == 7, "pink")
        .otherwise(F.get(F.array(*[F.lit(n) for n in _LINE_OF]), k % 3)).alias("line"),
        c("user_id").cast("int").alias("station_id"),
        _text("T", k).alias("train_id"),
        F.when(c("event_type").isin("click", "view"), "a").otherwise("b").alias("direction"),
        F.when(c("value") < 50, "in_service").otherwise("out_of_service").alias("train_status"),
        F.when(c("value") >= 10, c("user_id") + 1).cast("int").alias("prev_station_id"),
        F.when(k % 7 == 0, None).when(k % 2 == 0, "a").otherwise("b").alias("prev_direction"),
    )


def transit_messages(events: DataFrame) -> DataFrame:
    """The same arrivals and entries as JSON messages of their topics."""
    rows = board_messages(events)
    arrival = [c for c in rows.columns if c not in ("entry", "timestamp", "offset")]
    return rows.select(
        emit_json("timestamp").cast("binary").alias("key"),
        F.when(F.col("entry"), emit_json("station_id")).otherwise(emit_json(*arrival)).cast("binary").alias("value"),
        F.when(F.col("entry"), "turnstiles").otherwise("station.arrivals.all").alias("topic"),
        F.lit(0).alias("partition"), F.col("offset").cast("bigint").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))


def turnstile_entries(events: DataFrame) -> DataFrame:
    """Error events as turnstile entries of the user's station."""
    return events.filter(F.col("event_type") == "error").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_id").alias("offset"), F.col("user_id").cast("int").alias("station_id"))


BOARD_SQL = """arrivals AS (
  SELECT epoch_ms(ts) AS t, event_id AS o, CASE WHEN k % 11 = 5 THEN NULL
      WHEN k % 13 = 7 THEN 'pink' ELSE ['red', 'blue', 'green'][k % 3 + 1] END AS line,
    user_id AS station_id, 'T' || k AS train_id,
    CASE WHEN event_type IN ('click', 'view') THEN 'a' ELSE 'b' END AS slot,
    CASE WHEN value < 50 THEN 'in service' ELSE 'out of service' END AS status,
    CASE WHEN value >= 10 THEN user_id + 1 END AS prev_station,
    CASE WHEN k % 7 = 0 THEN NULL WHEN k % 2 = 0 THEN 'a' ELSE 'b' END AS prev_slot
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
  WHERE event_type <> 'error'),
moves AS (
  SELECT line, prev_station AS station_id, prev_slot AS slot, t, o, 0 AS kind,
    NULL AS train_id, NULL AS status
  FROM arrivals WHERE prev_station IS NOT NULL AND prev_slot IS NOT NULL
  UNION ALL SELECT line, station_id, slot, t, o, 1, train_id, status FROM arrivals),
known AS (
  SELECT m.line, m.station_id, slot, t, o, kind, train_id, status
  FROM members m JOIN moves v ON m.line = v.line AND m.station_id = v.station_id
  UNION ALL SELECT m.line, m.station_id, NULL, epoch_ms(ts), event_id, 2, NULL, NULL
  FROM members m JOIN events e ON m.station_id = e.user_id WHERE e.event_type = 'error'),
board AS (
  SELECT line, station_id,
    arg_max({'train': train_id, 'status': status}, (t, o, kind)) FILTER (WHERE slot = 'a') AS a,
    arg_max({'train': train_id, 'status': status}, (t, o, kind)) FILTER (WHERE slot = 'b') AS b,
    count(*) FILTER (WHERE kind = 2) AS entries
  FROM known GROUP BY line, station_id)"""
