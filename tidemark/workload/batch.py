"""Batch operators over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (base64_text, category_colour, dense_key, emit_json, first_of, hash_key,
                         leading_part, line_of_flags, millis_to_second, millis_to_timestamp,
                         none_if_blank, parse_json, slug, spaced, sparse_key, text_of, to_second,
                         typed)
from ..operators import quality
from ..operators.keyed import count_per_key, distinct_in_order, last_per_key
from ..operators.staging import rejected
from ..plans import calls, demand, risk, transit
from ..schemas import Field, Table
from ..session import stage
from ..sources.files import as_messages
from ..sources.topics import on_topic
from . import inputs
from .registry import register, table


def _millis(name: str):
    return F.unix_millis(F.col(name).cast("timestamp"))


# ---- scalar functions -------------------------------------------------------------------

@register("epoch_millis", """
SELECT event_id, date_trunc('milliseconds', ts) AS start_time FROM events""")
def epoch_millis(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", millis_to_timestamp(_millis("ts")).cast("timestamp_ntz").alias("start_time"))


@register("epoch_seconds", """
SELECT event_id, date_trunc('second', ts) AS start_time FROM events""")
def epoch_seconds(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", millis_to_second(_millis("ts")).cast("timestamp_ntz").alias("start_time"))


@register("second_truncated", """
SELECT event_id, date_trunc('second', ts) AS start_time FROM events""")
def second_truncated(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", to_second(F.col("ts")).cast("timestamp_ntz").alias("start_time"))


@register("key_md5", """
SELECT event_id, md5(user_id || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS play_id FROM events""")
def key_md5(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        "event_id", hash_key(F.col("user_id"), stamp).alias("play_id"))


@register("key_dense", """
SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS key, event_id FROM events""")
def key_dense(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_id")
    return dense_key(events, ["ts", "event_id"], "key").select("key", "event_id")


@register("key_sparse", "SELECT count(*) AS rows, count(*) AS keys, 0 AS nulls FROM lineitem")
def key_sparse(spark, sf_dir):
    """Every row gets its own key."""
    keyed = table(spark, sf_dir, "lineitem").select(sparse_key().alias("key"))
    per_key = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                       F.count_if(F.col("key").isNull()).alias("nulls"))


_BLANKS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@register("stage_clean", f"""
SELECT doc_id, CASE WHEN trim(text, {_BLANKS}) <> '' THEN left(text, 256) END AS text,
  CASE WHEN trim(text, {_BLANKS}) <> '' THEN md5(text) END AS text_md5,
  CASE WHEN trim(lang, {_BLANKS}) <> '' THEN left(lang, 256) END AS lang
FROM documents""")
def stage_clean(spark, sf_dir):
    """Blank text to null and text cut to its declared width, beside the whole text's hash."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", typed(text, "string", "string", 256).alias("text"),
        F.md5(none_if_blank(text)).alias("text_md5"),
        typed(F.col("lang"), "string", "string", 256).alias("lang"))


def written_numbers(orders):
    """Order keys as people write numbers: whole, with a fraction, blank, or not a number."""
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 6
    return orders.select("o_orderkey", F.when(kind == 0, F.concat(key, F.lit(".0")))
                         .when(kind == 1, F.concat(key, F.lit(".5"))).when(kind == 2, F.concat(F.lit("x"), key))
                         .when(kind == 3, "  ").when(kind == 4, F.concat(F.lit(" "), key, F.lit(" ")))
                         .otherwise(key).alias("written"), F.col("o_totalprice").alias("price"))


@register("typed_casts", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 NOT IN (1, 2, 3) THEN CAST(o_orderkey AS BIGINT) END AS number,
  CAST(o_totalprice / 8.0 AS DECIMAL(18,0)) AS whole FROM orders""")
def typed_casts(spark, sf_dir):
    """Numbers of all kinds; one with a fraction is no whole number."""
    return written_numbers(table(spark, sf_dir, "orders")).select(
        "o_orderkey", typed(F.col("written"), "string", "bigint").alias("number"),
        typed(F.col("price") / 8.0, "double", "decimal(18,0)").alias("whole"))


@register("dq_rejected_numbers", """
SELECT 'written' AS field, count(*) FILTER (WHERE o_orderkey % 6 IN (1, 2)) AS rejected FROM orders""")
def dq_rejected_numbers(spark, sf_dir):
    """Written numbers that can't be read; blank ones are absent, not rejected."""
    return rejected(written_numbers(table(spark, sf_dir, "orders")).select("written"),
                    Table("numbers", (Field("written", "bigint"),)))


@register("json_parse", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_parse(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", parse_json(F.col("props"), "k int").alias("p")).select("event_id", "p.k")


@register("json_emit", """
SELECT event_id, CAST(to_json({'event_id': event_id, 'event_type': event_type,
  'user_id': user_id}) AS VARCHAR) AS value FROM events""")
def json_emit(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", emit_json("event_id", "event_type", "user_id").alias("value"))


@register("b64_round", """
SELECT doc_id, md5(CAST(from_base64(to_base64(encode(text))) AS BLOB)) AS text_md5
FROM documents""")
def b64_round(spark, sf_dir):
    decoded = base64_text(F.base64(F.col("text").cast("binary")))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(decoded).alias("text_md5"))


@register("array_first", """
SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS first,
  split_part(text, ' ', 1) AS word FROM conversations""")
def array_first(spark, sf_dir):
    entry = F.array(F.struct(F.col("text").alias("element")))
    none = F.array().cast("array<struct<element:string>>")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        first_of(F.when(F.col("role") == "user", entry).otherwise(none), "element").alias("first"),
        leading_part(F.col("text"), " ").alias("word"))


@register("flags_case", """
SELECT p_partkey, CASE WHEN p_size <= 15 THEN 'red' WHEN p_size BETWEEN 10 AND 30 THEN 'blue'
  WHEN p_size BETWEEN 31 AND 40 THEN 'green' ELSE 'N/A' END AS line,
  CASE WHEN p_size <= 15 THEN '#DC143C' WHEN p_size BETWEEN 10 AND 30 THEN '#1E90FF'
  WHEN p_size BETWEEN 31 AND 40 THEN '#32CD32' ELSE '0xFFFFFF' END AS colour
FROM part""")
def flags_case(spark, sf_dir):
    size = F.col("p_size")
    line = line_of_flags(size <= 15, size.between(10, 30), size.between(31, 40))
    return table(spark, sf_dir, "part").select(
        "p_partkey", line.alias("line"), category_colour(line).alias("colour"))


@register("slug", """
SELECT doc_id, md5(replace(replace(replace(replace(lower(text), '/', '_and_'), ' ', '_'),
  '-', '_'), '''', '')) AS slug_md5, md5(replace(text, '_', ' ')) AS spaced_md5
FROM documents""")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(slug(F.col("text"))).alias("slug_md5"),
        F.md5(spaced(F.col("text"))).alias("spaced_md5"))


# ---- keyed rows and counts ---------------------------------------------------------------

@register("dim_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def dim_distinct(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_type").distinct()


DIM_LATEST_SQL = """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id"""


@register("dim_latest", DIM_LATEST_SQL)
def dim_latest(spark, sf_dir):
    return last_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"],
                        ["event_type"])


@register("count_by_key", """
SELECT user_id, count(user_id) AS count FROM events WHERE user_id IS NOT NULL GROUP BY user_id""")
def count_by_key(spark, sf_dir):
    return count_per_key(table(spark, sf_dir, "events"), "user_id")


@register("count_latest_per_key", """
SELECT event_type, count(*) AS count FROM (
  SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id)
GROUP BY event_type""")
def count_latest_per_key(spark, sf_dir):
    return count_per_key(table(spark, sf_dir, "events"), "event_type", mode="latest_per_key",
                         message_key=["user_id"], order=["ts", "event_id"])


@register("distinct_in_order", 'SELECT p_brand, min(p_size) AS p_size FROM part GROUP BY p_brand')
def brands_in_order(spark, sf_dir):
    return distinct_in_order(table(spark, sf_dir, "part"), "p_brand", "p_size")


@register("lookup_two_key", """
SELECT event_id, ts, value FROM events
WHERE user_id = (SELECT max(user_id) FROM events) AND event_type = 'click'""")
def lookup_two_key(spark, sf_dir):
    """Two-key point lookup, in time order."""
    events = table(spark, sf_dir, "events")
    user = events.agg(F.max("user_id")).first()[0]
    return events.filter(
        (F.col("user_id") == user) & (F.col("event_type") == "click")
    ).select("event_id", "ts", "value").orderBy("ts")


@register("topic_routing", """
SELECT event_id, user_id, 'station.arrivals.' || event_type AS topic FROM events
WHERE event_type IN ('click', 'purchase')""")
def topic_routing(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select(
        "event_id", "user_id",
        F.concat(F.lit("station.arrivals."), "event_type").alias("topic"),
        F.when(F.col("event_type") == "click", "red").when(F.col("event_type") == "purchase",
                                                           "blue").otherwise("N/A").alias("line"))
    return transit.routed(on_topic(messages, pattern=r"station.arrivals.\w*"), "arrivals") \
        .drop("line")


@register("json_messages", """
SELECT 'events' AS topic, CAST(to_json({'event_id': event_id}) AS VARCHAR) AS key,
  CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS VARCHAR)
    AS value
FROM events""")
def json_messages(spark, sf_dir):
    """Rows as keyed JSON messages, shown as text."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    m = as_messages(rows, "events", ["event_id"])
    return m.select("topic", text_of(F.col("key")).alias("key"),
                    text_of(F.col("value")).alias("value"))


# ---- windows, calls and customers (batch) --------------------------------------------------

SLIDING_SQL = """
WITH starts AS (
  SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, event_type, user_id FROM events
  UNION ALL
  SELECT time_bucket(INTERVAL 5 MINUTES, ts) - INTERVAL 5 MINUTES, event_type, user_id
  FROM events)
SELECT window_start, window_start + INTERVAL 10 MINUTES AS window_end, event_type, count(*) AS count
FROM starts GROUP BY window_start, event_type"""


def flat_window(df):
    """The window struct as two columns without a time zone."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window.end").cast("timestamp_ntz").alias("window_end"), *rest)


def sliding(events):
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return timed.groupBy(F.window("ts", *calls.WINDOW), "event_type").count()


@register("sliding_count", SLIDING_SQL)
def sliding_count(spark, sf_dir):
    return flat_window(sliding(table(spark, sf_dir, "events")))


CALLS_STATISTICS_SQL = f"""
WITH {inputs.CALLS_SQL}, starts AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTES, call_date_time) AS window_start FROM calls
  UNION ALL
  SELECT *, time_bucket(INTERVAL 5 MINUTES, call_date_time) - INTERVAL 5 MINUTES FROM calls)
SELECT window_start, window_start + INTERVAL 10 MINUTES AS window_end, original_crime_type_name,
  disposition, description, count(*) AS count
FROM starts JOIN codes USING (disposition)
GROUP BY window_start, original_crime_type_name, disposition, description"""


@register("call_statistics", CALLS_STATISTICS_SQL)
def call_statistics(spark, sf_dir):
    messages = inputs.call_messages(table(spark, sf_dir, "events"))
    return flat_window(calls.call_statistics(messages, inputs.codes(spark, sf_dir), None))


@register("calls_by_type", f"""
WITH {inputs.CALLS_SQL}, all_calls AS (
  SELECT original_crime_type_name, disposition FROM calls
  UNION ALL SELECT NULL, NULL FROM events WHERE event_type = 'error' AND value < 5)
SELECT original_crime_type_name, disposition, count(*) AS count FROM all_calls
GROUP BY original_crime_type_name, disposition""")
def calls_by_type(spark, sf_dir):
    messages = inputs.call_messages(table(spark, sf_dir, "events"))
    return calls.count_by_type(calls.calls_from(messages), None)


CUSTOMERS_DECODED_SQL = f"""
WITH {inputs.CUSTOMERS_SQL}
SELECT "customerName", email, phone, "birthDay", "birthYear" FROM customers"""

RISK_SQL = f"""
WITH {inputs.CUSTOMERS_SQL}
SELECT customer, score, email, "birthYear" FROM risks JOIN customers ON customer = email"""


@register("customers_decoded", CUSTOMERS_DECODED_SQL)
def customers_decoded(spark, sf_dir):
    return risk.customers_from(inputs.customer_messages(table(spark, sf_dir, "customer")))


@register("customer_risk", RISK_SQL)
def customer_risk(spark, sf_dir):
    people = risk.customers_from(inputs.customer_messages(table(spark, sf_dir, "customer")))
    scores = risk.risks_from(inputs.risk_messages(table(spark, sf_dir, "orders")))
    return risk.customer_risk(people, scores)


# ---- transit (batch) -------------------------------------------------------------------------

STATION_TABLE_SQL = f"""
WITH {inputs.STOPS_SQL}
SELECT station_id, arg_max(station_name, stop_id) AS station_name,
  arg_max("order", stop_id) AS "order", arg_max(line, stop_id) AS line
FROM stops GROUP BY station_id"""


@register("station_table", STATION_TABLE_SQL)
def station_table(spark, sf_dir):
    return transit.station_table(inputs.stops(table(spark, sf_dir, "part")))


@register("line_stations", f"WITH {inputs.STOPS_SQL} SELECT * FROM members")
def line_stations(spark, sf_dir):
    return transit.line_stations(inputs.stops(table(spark, sf_dir, "part")))


@register("stops_on_line", f"""
WITH {inputs.STOPS_SQL}
SELECT stop_id, station_id, "order" FROM stops JOIN part ON stop_id = p_partkey
WHERE p_size BETWEEN 10 AND 30""")
def stops_on_line(spark, sf_dir):
    return transit.stops_on(inputs.stops(table(spark, sf_dir, "part")), "blue").select(
        "stop_id", "station_id", "order")


SLOT_BOARD_SQL = f"""
WITH {inputs.STOPS_SQL}, {inputs.BOARD_SQL}
SELECT line, station_id, a.train AS train_a, a.status AS status_a, b.train AS train_b,
  b.status AS status_b, entries FROM board"""


def board_events(events):
    return transit.board_events(inputs.board_messages(events), F.col("entry"))


def board_stations(spark, sf_dir):
    """The station dimension, written once so that no micro-batch computes it again."""
    return stage(transit.line_stations(inputs.stops(table(spark, sf_dir, "part"))), "stations")


@register("slot_board", SLOT_BOARD_SQL)
def slot_board(spark, sf_dir):
    return transit.board(board_events(table(spark, sf_dir, "events")),
                         board_stations(spark, sf_dir))


@register("board_view", f"""
WITH {inputs.STOPS_SQL}, {inputs.BOARD_SQL}
SELECT m.line, CASE m.line WHEN 'blue' THEN '#1E90FF' WHEN 'red' THEN '#DC143C'
    ELSE '#32CD32' END AS colour, m.station_id, m.station_name,
  replace(replace(replace(replace(lower(m.station_name), '/', '_and_'), ' ', '_'), '-', '_'),
    '''', '') AS station_slug, m."order",
  coalesce(a.train, '---') AS train_a, a.status AS status_a,
  coalesce(b.train, '---') AS train_b, b.status AS status_b, coalesce(entries, 0) AS entries
FROM members m LEFT JOIN board USING (line, station_id)""")
def board_view(spark, sf_dir):
    stations = board_stations(spark, sf_dir)
    state = transit.board(board_events(table(spark, sf_dir, "events")), stations)
    return transit.board_view(state, stations)


@register("current_weather", """
SELECT CAST(arg_max(CAST(floor(value) AS INTEGER), (ts, event_id)) AS DOUBLE) AS temperature,
  arg_max(event_type, (ts, event_id)) AS status FROM events""")
def current_weather(spark, sf_dir):
    reports = table(spark, sf_dir, "events").select(
        F.floor("value").cast("int").alias("temperature"), F.col("event_type").alias("status"),
        "ts", "event_id")
    return transit.current_weather(reports, ["ts", "event_id"])


@register("expected_entries", """
WITH curve AS (
  SELECT hour(ts) AS hour, count(*) / CAST((SELECT count(*) FROM events) AS DOUBLE) AS ratio
  FROM events GROUP BY hour(ts))
SELECT CAST(p_partkey AS INTEGER) AS station_id, CAST(hour AS INTEGER) AS hour,
  CAST(greatest(floor(round_even(p_retailprice, 0) * ratio / CAST(12 AS DOUBLE)), 0) AS BIGINT)
    AS entries
FROM part CROSS JOIN curve""")
def expected_entries(spark, sf_dir):
    """Daily totals from part prices, and the share of each hour from all events."""
    events = table(spark, sf_dir, "events")
    per_hour = events.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    total = events.select(F.count(F.lit(1)).cast("double")).scalar()
    curve = per_hour.select("hour", (F.col("n") / total).alias("ridership_ratio"))
    seed = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("station_id"),
        F.col("p_retailprice").alias("avg_weekday_rides"))
    return demand.expected_entries(seed, curve, "weekday", steps_per_hour=12)


# ---- data quality ------------------------------------------------------------------------------

@register("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_unique(spark, sf_dir):
    return quality.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_fk", """
SELECT o_custkey AS value, count(*) AS rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY o_custkey""")
def dq_fk(spark, sf_dir):
    """Orders of customers that are not among those in credit."""
    return quality.orphans(table(spark, sf_dir, "orders"), "o_custkey",
                           table(spark, sf_dir, "customer").filter("c_acctbal >= 0"), "c_custkey")


@register("dq_fk_unlabelled", """
SELECT doc_id AS value, count(*) AS rows FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""")
def dq_fk_unlabelled(spark, sf_dir):
    return quality.orphans(table(spark, sf_dir, "documents"), "doc_id",
                           table(spark, sf_dir, "labels"), "doc_id")


@register("dq_nulls", """
SELECT 'artist' AS "column", count(*) FILTER (WHERE l_returnflag = 'R') AS nulls FROM lineitem
UNION ALL SELECT 'length', count(*) FILTER (WHERE l_returnflag = 'R') FROM lineitem
UNION ALL SELECT 'level', count(*) FILTER (WHERE l_linenumber = 2) FROM lineitem
UNION ALL SELECT 'ts', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem""")
def dq_nulls(spark, sf_dir):
    planted = inputs.logs(spark, sf_dir).withColumn(
        "level", F.when(F.col("itemInSession") != 2, F.col("level")))
    return quality.null_counts(planted, ["artist", "length", "level", "ts"])


@register("dq_enum", """
SELECT 'event_type' AS "column",
  count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase')) AS violations FROM events
""")
def dq_enum(spark, sf_dir):
    return quality.outside_domain(table(spark, sf_dir, "events"),
                                  {"event_type": ("click", "view", "purchase")})


@register("dq_rules", """
SELECT 'not_null:event_id' AS rule, count(*) FILTER (WHERE event_id % 97 = 3) AS violations
FROM events UNION ALL
SELECT 'domain:event_type', count(*) FILTER (WHERE event_type IN ('signup', 'view')) FROM events""")
def dq_rules(spark, sf_dir):
    rules = Table("events", (
        Field("event_id", "bigint", required=True),
        Field("event_type", "string",
              allowed=("click", "error", "purchase")),
    ))
    events = table(spark, sf_dir, "events")
    with_gaps = events.withColumn("event_id", F.when(F.col("event_id") % 97 != 3, F.col("event_id")))
    return quality.check_table(with_gaps, rules)


@register("dq_rejected", """
SELECT 'text' AS field, 0 AS rejected UNION ALL
SELECT 'lang', count(*) FILTER (WHERE TRY_CAST(lang AS INTEGER) IS NULL AND trim(lang) <> '')
FROM documents""")
def dq_rejected(spark, sf_dir):
    return rejected(table(spark, sf_dir, "documents"),
                    Table("d", (Field("text", "string", 256), Field("lang", "int"))))


@register("dq_checks", """
SELECT 'SELECT count(*) FROM dq_users WHERE user_id IS NULL' AS query, '0' AS expected,
  CAST(count(*) FILTER (WHERE user_id IS NULL) AS VARCHAR) AS actual FROM events""")
def dq_checks(spark, sf_dir):
    """A gate of scalar queries; raises when one does not hold, as it must for false expectations."""
    table(spark, sf_dir, "events").createOrReplaceTempView("dq_users")
    query = "SELECT count(*) FROM dq_users WHERE user_id IS NULL"
    try:
        quality.run_checks(spark, ["SELECT count(*) FROM dq_users WHERE user_id IS NOT NULL"], [-1])
    except ValueError:
        return quality.run_checks(spark, [query], [0])
    raise AssertionError("a check that does not hold passed")
