"""The streaming jobs, run over all of a table and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text_of
from ..operators.joins import lookup_join
from ..operators.keyed import count_per_key, last_per_key
from ..plans import calls, risk, transit
from ..session import fresh_path
from .. import schemas
from ..sinks import tables
from ..sinks.versions import KeyedTable
from ..sources import topics
from ..streaming import jobs, sinks
from ..streaming.upserts import LatestCounts, to_latest_counts
from . import inputs
from .batch import (CALLS_STATISTICS_SQL, CUSTOMERS_DECODED_SQL, DIM_LATEST_SQL, RISK_SQL,
                    SLIDING_SQL, SLOT_BOARD_SQL, STATION_TABLE_SQL, board_events, board_stations,
                    flat_window, sliding)
from .files import MERGE_BUCKETS
from .inputs import stream
from .registry import register, table

@register("stream_dim_latest", DIM_LATEST_SQL)
def dim_latest(spark, sf_dir):
    last = last_per_key(stream(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"],
                        ["event_type"])
    return sinks.drain(last, "update", "dim-latest", ["user_id"])


@register("stream_sliding_count", SLIDING_SQL)
def sliding_count(spark, sf_dir):
    """Complete mode: every row counts, however late."""
    counts = sliding(stream(spark, sf_dir, "events"))
    return flat_window(sinks.drain(counts, "complete", "sliding"))


@register("stream_call_statistics", CALLS_STATISTICS_SQL)
def call_statistics(spark, sf_dir):
    messages = inputs.call_messages(stream(spark, sf_dir, "events"))
    described = calls.call_statistics(messages, inputs.codes(spark, sf_dir))
    return flat_window(sinks.drain(described, "complete", "calls"))


#: The split of the messages in two, and what the first half's latest call makes late.
_HALVES_SQL = """halves AS (
  SELECT *, event_id % 2 AS half FROM events WHERE NOT (event_type = 'error' AND value < 5)),
late AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 60 MINUTES AS upto FROM halves WHERE half = 0),
starts AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTES, ts) AS window_start FROM halves
  UNION ALL SELECT *, time_bucket(INTERVAL 5 MINUTES, ts) - INTERVAL 5 MINUTES FROM halves)"""


@register("stream_call_updates", f"""
WITH {_HALVES_SQL}
SELECT window_start, window_start + INTERVAL 10 MINUTES AS window_end,
  event_type AS original_crime_type_name, 'D' || n_nationkey AS disposition,
  'region ' || n_regionkey AS description, count(*) AS count
FROM starts JOIN nation ON user_id % 30 = n_nationkey AND user_id % 30 <> 7, late
WHERE half = 0 OR window_start + INTERVAL 10 MINUTES > upto
GROUP BY window_start, event_type, n_nationkey, n_regionkey""")
def call_updates(spark, sf_dir):
    """The call job in update mode over two deliveries and a restart; descriptions share codes.

    The second delivery meets the state of the first, and its late calls are dropped.
    """
    base, source = fresh_path(spark, "call-job"), fresh_path(spark, "call-topic")
    events = table(spark, sf_dir, "events")
    for half in (0, 1):
        calls_ = inputs.call_messages(events.filter(F.col("event_id") % 2 == half))
        as_topic(calls_, "calls").write.mode("append").parquet(source)
        jobs.call_statistics(topics.file_topics(spark, source, "calls"), inputs.shared_codes(spark, sf_dir),
                             base, "update", every=None).awaitTermination()
    return flat_window(sinks.read_updates(spark, f"{base}/calls", jobs.CALL_KEYS))


@register("stream_keyed_merge", """
SELECT user_id, max(event_id) AS event_id,
  arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def keyed_merge(spark, sf_dir):
    """Purchases and sign-ups as a keyed table; a stream merges the rest in two deliveries and a restart."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    first = F.col("event_type").isin("purchase", "signup")
    path, source = fresh_path(spark, "stream-merge"), fresh_path(spark, "merge-source")
    tables.write_mergeable(events.filter(first), path, ["user_id"], ["event_id"], MERGE_BUCKETS)
    for half in (0, 1):
        events.filter(~first & (F.col("event_id") % 2 == half)).write.mode("append").parquet(source)
        changes = topics.table_stream(spark, source, events.schema)
        sinks.to_merged(changes, path, f"{path}-checkpoint", ["user_id"], ["event_id"],
                        MERGE_BUCKETS).awaitTermination()
    return tables.read_mergeable(spark, path)


def as_topic(messages, topic: str):
    """Message values in the record shape of a topic."""
    return messages.select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))


@register("stream_lookup_join", f"""
WITH {inputs.CALLS_SQL}
SELECT original_crime_type_name, disposition, description, count(*) AS count
FROM calls JOIN codes USING (disposition)
GROUP BY original_crime_type_name, disposition, description""")
def lookup(spark, sf_dir):
    """Counts by type and disposition, joined to the codes, in update mode."""
    messages = inputs.call_messages(stream(spark, sf_dir, "events"))
    counts = calls.count_by_type(calls.calls_from(messages))
    named = inputs.codes(spark, sf_dir).withColumnRenamed("disposition_code", "disposition")
    joined = lookup_join(counts, named, ["disposition"]).select(
        "original_crime_type_name", "disposition", "description", "count")
    return sinks.drain(joined, "update", "call-types",
                       ["original_crime_type_name", "disposition"])


@register("stream_customers_decoded", CUSTOMERS_DECODED_SQL)
def customers_decoded(spark, sf_dir):
    messages = inputs.customer_messages(stream(spark, sf_dir, "customer"))
    return sinks.drain(risk.customers_from(messages), "append", "customers")


@register("stream_stream_join", RISK_SQL)
def stream_stream_join(spark, sf_dir):
    """Customers and scores joined as two streams."""
    people = risk.customers_from(inputs.customer_messages(stream(spark, sf_dir, "customer")))
    scores = risk.risks_from(inputs.risk_messages(stream(spark, sf_dir, "orders")))
    return sinks.drain(risk.customer_risk(people, scores), "append", "risk")


@register("stream_risk_latest", RISK_SQL)
def risk_latest(spark, sf_dir):
    """Scores as a stream against the last record of each customer: no state."""
    messages = inputs.customer_messages(table(spark, sf_dir, "customer"), ("c_custkey",))
    people = risk.customers_from(messages, ("c_custkey",))
    scores = risk.risks_from(inputs.risk_messages(stream(spark, sf_dir, "orders")))
    return sinks.drain(risk.customer_risk_latest(people, scores, ["c_custkey"]), "append",
                       "risk-latest")


@register("stream_risk_bounded", f"""
WITH {inputs.CUSTOMERS_SQL}
SELECT 'customer' || o_custkey || '@test.com' AS customer, CAST(o_totalprice AS FLOAT) AS score,
  email, "birthYear"
FROM orders JOIN customers ON 'customer' || o_custkey || '@test.com' = email
WHERE abs(epoch(CAST(o_orderdate AS TIMESTAMP)) - epoch(TIMESTAMP '1995-01-01')) <= 200 * 86400""")
def risk_bounded(spark, sf_dir):
    """Scores within 200 days of their customer's record, as two streams that forget."""
    people = risk.customers_from(inputs.customer_messages(
        stream(spark, sf_dir, "customer").withColumn("timestamp", F.lit("1995-01-01").cast("timestamp")),
        ("timestamp",)), ("timestamp",))
    scores = risk.risks_from(inputs.risk_messages(
        stream(spark, sf_dir, "orders").withColumn("timestamp", F.col("o_orderdate").cast("timestamp")),
        ("timestamp",)), ("timestamp",))
    # The table is in no order of time, so nothing may count as late.
    joined = risk.customer_risk_bounded(people, scores, "200 DAYS", lateness="36500 days")
    return sinks.drain(joined, "append", "risk-bounded")


@register("stream_risk_topic", f"""
WITH {inputs.CUSTOMERS_SQL}
SELECT email AS key, customer, score, "birthYear" FROM risks JOIN customers ON customer = email""")
def risk_topic(spark, sf_dir):
    """The customer-risk job to its end: JSON messages on a topic, read back."""
    people = risk.customers_from(inputs.customer_messages(stream(spark, sf_dir, "customer")))
    scores = risk.risks_from(inputs.risk_messages(stream(spark, sf_dir, "orders")))
    out = fresh_path(spark, "risk-topic")
    sinks.to_topic_files(risk.customer_risk(people, scores), "email", "customer-risk", out,
                         f"{out}-checkpoint").awaitTermination()
    messages = spark.read.schema("key string, value string, topic string").parquet(out)
    value = F.from_json("value", "customer string, score float, birthYear string").alias("v")
    return messages.select("key", value).select("key", "v.*")


@register("stream_count_by_key", """
SELECT user_id AS station_id, count(*) AS count FROM events WHERE event_type = 'error'
GROUP BY user_id""")
def count_by_key(spark, sf_dir):
    """Turnstile entries per station as a continuously updated table."""
    entries = inputs.turnstile_entries(stream(spark, sf_dir, "events"))
    counts = count_per_key(entries.withColumn("station_id", F.col("station_id").cast("bigint")),
                           "station_id")
    return sinks.drain(counts, "update", "entries", ["station_id"])


@register("stream_station_table", STATION_TABLE_SQL)
def station_table(spark, sf_dir):
    stations = transit.station_table(inputs.stops(stream(spark, sf_dir, "part")))
    return sinks.drain(stations, "update", "stations", ["station_id"])


@register("stream_station_changelog", f"""
WITH {inputs.STOPS_SQL}
SELECT CAST(station_id AS VARCHAR) AS key, arg_max(line, stop_id) AS line
FROM stops GROUP BY station_id""")
def station_changelog(spark, sf_dir):
    """The station table as a changelog topic, folded back to its last message per key."""
    stations = transit.station_table(inputs.stops(stream(spark, sf_dir, "part")))
    out = fresh_path(spark, "station-changelog")
    sinks.to_topic_files(stations, "station_id", "stations.table", out, f"{out}-checkpoint",
                         "update").awaitTermination()
    sinks.compact_updates(spark, out, ["key"])
    last = sinks.read_updates(spark, out, ["key"])
    return last.select("key", F.get_json_object(text_of(F.col("value")), "$.line").alias("line"))


@register("stream_slot_board", SLOT_BOARD_SQL)
def slot_board(spark, sf_dir):
    state = transit.board(board_events(stream(spark, sf_dir, "events")),
                          board_stations(spark, sf_dir))
    return sinks.drain(state, "update", "board", ["line", "station_id"])


@register("stream_progress", "SELECT count(*) AS input_rows FROM events")
def progress(spark, sf_dir):
    """Rows read by a stream of many micro-batches, from the reports of all of them.

    Spark itself keeps the last two here.
    """
    source, out = fresh_path(spark, "progress-in"), fresh_path(spark, "progress")
    events = table(spark, sf_dir, "events")
    events.repartition(6, "event_id").write.parquet(source)
    name = out.rsplit("/", 1)[1]
    log = sinks.ProgressLog(spark, f"{out}-reports", name)
    spark.streams.addListener(log)
    retained = "spark.sql.streaming.numRecentProgressUpdates"
    kept = spark.conf.get(retained)
    spark.conf.set(retained, "2")
    try:
        rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
        sinks.to_batches(rows, out, f"{out}-checkpoint", "append", name=name).awaitTermination()
        return log.read().agg(F.sum("input_rows").alias("input_rows"))
    finally:
        spark.conf.set(retained, kept)
        spark.streams.removeListener(log)


@register("stream_count_latest", """
SELECT event_type, count(*) AS count FROM (
  SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id)
GROUP BY event_type""")
def count_latest(spark, sf_dir):
    """The upsert table's counts, kept up by a stream over three deliveries with a restart after each.

    Users change their event type between deliveries, and some of the later messages are older than the known.
    """
    events = table(spark, sf_dir, "events")
    base, source = fresh_path(spark, "upsert-counts"), fresh_path(spark, "upsert-source")
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(source)
        counts = LatestCounts(spark, base, events.schema, "event_type", ["user_id"], ["ts", "event_id"])
        messages = topics.table_stream(spark, source, events.schema)
        to_latest_counts(messages, counts, f"{base}/checkpoint").awaitTermination()
    return counts.read()


#: Every fourth station appears only after the first half of the messages.
_LATE = "(m.station_id % 4 <> 0 OR {} % 2 = 1)"
_LATE_BOARD_SQL = inputs.BOARD_SQL.replace(
    "AND m.station_id = v.station_id", "AND m.station_id = v.station_id AND " + _LATE.format("o")).replace(
    "WHERE e.event_type = 'error'", "WHERE e.event_type = 'error' AND " + _LATE.format("event_id"))


@register("stream_transit_status", f"""
WITH {inputs.STOPS_SQL}, {_LATE_BOARD_SQL}
SELECT line, station_id, a.train AS train_a, a.status AS status_a, b.train AS train_b,
  b.status AS status_b, entries FROM board""")
def transit_status(spark, sf_dir):
    """The transit job over two deliveries, between which stations are added; they take part from then on."""
    base, source, stations = (fresh_path(spark, f"transit-{x}") for x in ("job", "messages", "stops"))
    events, stops = table(spark, sf_dir, "events"), inputs.stops(table(spark, sf_dir, "part"))
    late = F.col("station_id") % 4 == 0
    for part in range(2):
        stops.filter(late if part else ~late).write.mode("append").parquet(stations)
        messages = inputs.transit_messages(events.filter(F.col("event_id") % 2 == part))
        messages.write.mode("append").parquet(source)
        queries = jobs.transit_status(topics.file_topics(spark, source),
                                      lambda: spark.read.schema(stops.schema).parquet(stations), base)
        for query in queries.values():
            query.awaitTermination()
    return transit.board_rows(jobs.board_table(spark, base).read())


@register("stream_state", """
SELECT user_id AS station_id, count(*) AS count FROM events WHERE event_type = 'error'
GROUP BY user_id""")
def state(spark, sf_dir):
    """The same counts as ``stream_count_by_key``, read from the state of the stream that has ended."""
    entries = inputs.turnstile_entries(stream(spark, sf_dir, "events"))
    out = fresh_path(spark, "state")
    sinks.to_batches(count_per_key(entries, "station_id"), out, f"{out}-checkpoint", "update").awaitTermination()
    kept = sinks.state_rows(spark, f"{out}-checkpoint")
    return kept.select(F.col("key.station_id").cast("bigint").alias("station_id"), F.col("value.count").alias("count"))


#: Customers' records and scores by time, delivered before or after the turn of a year; every tenth comes late.
_FORGETFUL_SQL = f"""
WITH {inputs.CUSTOMERS_SQL},
people AS (
  SELECT email, "birthYear", TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 600 AS INTEGER)) AS t, c_custkey AS k
  FROM customers),
scores AS (
  SELECT 'customer' || o_custkey || '@test.com' AS customer, CAST(o_totalprice AS FLOAT) AS score,
    CAST(o_orderdate AS TIMESTAMP) AS t, o_orderkey AS k FROM orders),
upto AS (
  SELECT least((SELECT max(t) FROM people WHERE t < TIMESTAMP '1996-01-01' AND k % 10 <> 7),
    (SELECT max(t) FROM scores WHERE t < TIMESTAMP '1996-01-01' AND k % 10 <> 7)) - INTERVAL 30 DAYS AS w)
SELECT customer, score, email, "birthYear" FROM scores s JOIN people p ON customer = email, upto
WHERE abs(epoch(s.t) - epoch(p.t)) <= 200 * 86400
  AND (s.t > w OR (s.t < TIMESTAMP '1996-01-01' AND s.k % 10 <> 7))
  AND (p.t > w OR (p.t < TIMESTAMP '1996-01-01' AND p.k % 10 <> 7))"""


@register("stream_risk_forgets", _FORGETFUL_SQL)
def risk_forgets(spark, sf_dir):
    """Scores near their customer's record in time, over two deliveries and a restart. What comes after the watermark of
    the first delivery has passed it is lost, and the state forgets what can't match any more."""
    base = fresh_path(spark, "risk-forgets")
    customers = table(spark, sf_dir, "customer").withColumn(
        "timestamp", F.expr("timestamp'1995-01-01' + make_dt_interval(cast(c_custkey % 600 as int))"))
    orders = table(spark, sf_dir, "orders").withColumn("timestamp", F.col("o_orderdate").cast("timestamp"))
    sources = {"people": (customers, "c_custkey", inputs.customer_messages),
               "scores": (orders, "o_orderkey", inputs.risk_messages)}
    for part in range(2):
        streams = {}
        for name, (rows, key, messages) in sources.items():
            early = (F.col("timestamp") < "1996-01-01") & (F.col(key) % 10 != 7)
            sent = messages(rows.filter(~early if part else early), ("timestamp",))
            sent.write.mode("append").parquet(f"{base}/{name}")
            streams[name] = topics.table_stream(spark, f"{base}/{name}", sent.schema)
        joined = risk.customer_risk_bounded(
            risk.customers_from(streams["people"], ("timestamp",)), risk.risks_from(streams["scores"], ("timestamp",)),
            "200 DAYS", lateness="30 days")
        sinks.to_files(joined, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{base}/out")


@register("stream_keyed_versions", """
SELECT user_id, max(event_id) AS event_id,
  arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def keyed_versions(spark, sf_dir):
    """Events merged by a stream into a table of versions, in micro-batches of several deliveries."""
    events = stream(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    path = fresh_path(spark, "stream-versions")
    keyed = KeyedTable(spark, path, events.schema, ["user_id"], ["event_id"])
    sinks.to_keyed(events, keyed, f"{path}-checkpoint").awaitTermination()
    return keyed.read()


@register("stream_every", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'")
def every(spark, sf_dir):
    """Purchases appended by a stream that looks for new files at an interval, until it has taken all there are."""
    rows = stream(spark, sf_dir, "events").filter("event_type = 'purchase'").select("event_id", "user_id")
    out = fresh_path(spark, "every")
    query = sinks.to_files(rows, out, f"{out}-checkpoint", every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(rows.schema).parquet(out)


@register("src_decoded", """
SELECT epoch_us(ts) // 1000 AS timestamp, CAST(user_id AS INTEGER) AS station_id, event_id AS offset
FROM events WHERE event_type = 'error'""")
def decoded(spark, sf_dir):
    """Keys and values of a topic's messages decoded by their schemas (as JSON, for want of the Avro module)."""
    messages = inputs.transit_messages(table(spark, sf_dir, "events"))
    entries = topics.decoded(topics.on_topic(messages, "turnstiles"), schemas.TURNSTILE, schemas.MESSAGE_KEY,
                             keep=("offset",))
    return entries.select("timestamp", "station_id", "offset")
