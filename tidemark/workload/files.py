"""Sources and sinks over the given tables: write whole tables, read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar_parts
from ..plans import query_tables, star
from ..schemas import STAGED_LOGS, Field, Table
from ..session import fresh_path
from ..sinks import tables as sink
from ..sinks.versions import KeyedTable
from ..sources import files, incremental
from . import inputs
from .registry import register, table
from .star import _CLEAN_USER, _MS, _SQL, _naive, _rows, _last_sql, _ORDER

#: Folders of a table that changes are merged into.
MERGE_BUCKETS = 8
#: Keys of one JSON-array file.
ARRAY_KEYS = 1000

_LOG_COLUMNS = ("artist, length, level, \"sessionId\", \"itemInSession\", song, page, ts, "
                "\"userId\"")


@register("src_json_lines", f"WITH {inputs.LOGS_SQL} SELECT {_LOG_COLUMNS} FROM logs")
def json_lines(spark, sf_dir):
    """Activity logs written as nested folders of JSON lines and read from their root."""
    root = fresh_path(spark, "logs-json")
    logs = inputs.logs(spark, sf_dir).withColumn("day", F.dayofmonth(F.timestamp_millis("ts")))
    sink.write_lines(logs, root, ["level", "page"])
    # Partition columns are in the folder names here, not in the records.
    back = files.read_json_lines(
        spark, root, ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.logs(spark, sf_dir).schema))
    return back.select("artist", "length", "level", "sessionId", "itemInSession", "song", "page",
                       "ts", "userId")


@register("src_json_staged", f"""
WITH {inputs.LOGS_SQL}
SELECT artist, "firstName", CAST(length AS DOUBLE) AS length, level,
  NULLIF(trim(location), '') AS location, "sessionId", song, {_MS} AS ts,
  {_CLEAN_USER} AS "userId" FROM logs""")
def json_staged(spark, sf_dir):
    """Nested JSON records staged into a declared table by a path mapping."""
    path = fresh_path(spark, "staging-json")
    user = F.struct(F.col("firstName").alias("first"), F.col("userId").alias("id"))
    sink.write_lines(inputs.logs(spark, sf_dir).withColumn("user", user).drop("firstName", "userId"), path)
    staged = files.stage_json(spark, path, STAGED_LOGS,
                              {"firstName": "$.user.first", "userId": "$.user.id"})
    return _naive(staged.select("artist", "firstName", "length", "level", "location", "sessionId",
                                "song", "ts", "userId"))


@register("src_json_rejects", f"""
WITH {inputs.LOGS_SQL}, planted AS (
  SELECT *, '{{"artist": "cut off ' || "sessionId" || ' ' || "itemInSession" AS record FROM logs)
SELECT record, true AS rejected, true AS has_file FROM planted WHERE "itemInSession" = 3
UNION ALL SELECT "sessionId" || ' ' || "itemInSession", false, false FROM planted WHERE "itemInSession" <> 3""")
def json_rejects(spark, sf_dir):
    """Records of which some break off: these are kept with their file, the others staged."""
    path, rejects = fresh_path(spark, "rejects-json"), fresh_path(spark, "rejects")
    place = F.concat_ws(" ", "sessionId", "itemInSession")
    bad = F.concat(F.lit('{"artist": "cut off '), place)
    logs = inputs.logs(spark, sf_dir)
    sink.write_lines(logs.select(F.when(F.col("itemInSession") == 3, bad).otherwise(
        F.to_json(F.struct(*logs.columns))).alias("value")), path, file_format="text")
    rows = files.stage_json(spark, path, STAGED_LOGS, rejects=rejects)
    lost = files.read_rejects(spark, rejects).select(
        "record", F.lit(True).alias("rejected"), F.col("file").contains("rejects-json").alias("has_file"))
    return lost.union(rows.select(place, F.lit(False), F.lit(False)))


@register("src_csv_staged", """
SELECT o_orderkey, o_custkey, o_totalprice, left(o_orderpriority, 8) AS o_orderpriority
FROM orders""")
def csv_staged(spark, sf_dir):
    """Part files of comma-separated text, each with a header, staged as one table."""
    path = fresh_path(spark, "orders-csv")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    table(spark, sf_dir, "orders").select(*columns).write.option("header", True).csv(path)
    spec = Table("orders", (
        Field("o_orderkey", "bigint"), Field("o_custkey", "bigint"),
        Field("o_totalprice", "double"), Field("o_orderpriority", "string", 8)))
    return files.stage_csv(spark, path, spec)


@register("src_dated", """
SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def dated(spark, sf_dir):
    """All events in a folder per day, of which a back-fill run reads its own day's."""
    root = fresh_path(spark, "events-dated")
    events = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date").alias("day")
    sink.write_parquet(events.select("event_id", "user_id", day), root, ["day"])
    run_date = events.agg(F.max("ts")).first()[0].date()
    written = spark.read.schema("event_id bigint, user_id bigint, day date").parquet(root)
    return files.on_date(written, "day", run_date)


@register("src_lookup_json", "SELECT 'D' || n_nationkey AS disposition_code, n_name AS description FROM nation")
def lookup_json(spark, sf_dir):
    """A lookup kept as one JSON array."""
    path = fresh_path(spark, "codes-json")
    _as_array(inputs.codes(spark, sf_dir)).write.text(path)
    return files.read_lookup(spark, path, "disposition_code string, description string")


def _as_array(rows):
    """One line of text: the rows as a JSON array. For lookups, whose format takes one file."""
    return rows.agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))


@register("src_json_array", """
SELECT 'parts' AS topic, '{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}' AS value
FROM region""")
def json_array(spark, sf_dir):
    """The elements of a JSON-array file as messages."""
    path = fresh_path(spark, "regions-json")
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint"), "r_name")
    _as_array(regions).write.text(path)
    messages = files.explode_to_messages(spark, path, "r_regionkey bigint, r_name string", "parts")
    return messages.select("topic", F.col("value").cast("string").alias("value"))


@register("src_json_arrays", """
SELECT 'customers' AS topic, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS value
FROM customer""")
def json_arrays(spark, sf_dir):
    """The elements of many JSON-array files, as many as the table is large, as messages."""
    path = fresh_path(spark, "customers-json")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint"), "c_name")
    _as_arrays(customers, "c_custkey").hint("rebalance", "keys").write.partitionBy("keys").text(path)
    messages = files.explode_to_messages(spark, f"{path}/*", "c_custkey bigint, c_name string", "customers")
    return messages.select("topic", F.col("value").cast("string").alias("value"))


def _as_arrays(rows, key):
    """A JSON array for each stretch of ``ARRAY_KEYS`` keys."""
    return rows.groupBy(F.expr(f"{key} div {ARRAY_KEYS}").alias("keys")).agg(
        F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))


@register("src_many_files", """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nation FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer""")
def many_files(spark, sf_dir):
    """Files of one shape in several folders, read as one table."""
    root = fresh_path(spark, "parties")
    for name, key, title, nation in (("supplier", "s_suppkey", "s_name", "s_nationkey"),
                                     ("customer", "c_custkey", "c_name", "c_nationkey")):
        table(spark, sf_dir, name).select(
            F.col(key).alias("key"), F.col(title).alias("name"), F.col(nation).alias("nation")
        ).write.option("header", True).csv(f"{root}/{name}")
    return files.read_csv(spark, [f"{root}/supplier", f"{root}/customer"],
                          "key bigint, name string, nation int")


@register("src_incremental", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def incremental_polls(spark, sf_dir):
    """All orders taken in polls of a quarter of the key range, each above the last mark."""
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    low, high = source.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    state = incremental.HighWaterMark(spark, fresh_path(spark, "marks"), "orders")
    out = fresh_path(spark, "orders-landed")
    while incremental.poll(source, "o_orderkey", state, out, (high - low) // 4 + 1) is not None:
        pass
    return spark.read.schema(source.schema).option("recursiveFileLookup", True).parquet(out)


#: A key that is dense and repeated for half of the orders, and has wide gaps for the others.
_SKEWED = "CASE WHEN o_custkey % 2 = 0 THEN o_orderkey // 40 ELSE o_orderkey * 1000003 END"


@register("src_incremental_rows", f"SELECT {_SKEWED} AS key, o_orderkey, true AS bounded FROM orders")
def incremental_rows(spark, sf_dir):
    """All orders in polls of an eighth of the rows, by a key whose gaps say nothing about the rows between them."""
    source = table(spark, sf_dir, "orders").select(
        F.expr(_SKEWED.replace("//", "div")).cast("bigint").alias("key"), "o_orderkey")
    most = source.count() // 8 + 1
    state = incremental.HighWaterMark(spark, fresh_path(spark, "row-marks"), "orders")
    out = fresh_path(spark, "row-polls")
    while incremental.poll(source, "key", state, out, max_rows=most) is not None:
        pass
    landed = spark.read.schema("key bigint, o_orderkey bigint, above string").parquet(out)
    polls = landed.groupBy("above").agg(
        ((F.count(F.lit(1)) <= most) | (F.min("key") == F.max("key"))).alias("bounded"))
    return landed.join(polls, "above").select("key", "o_orderkey", "bounded")


@register("incremental", """
SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)""")
def rows_after(spark, sf_dir):
    """One incremental read, from a mark at half of the key range."""
    orders = table(spark, sf_dir, "orders")
    mark = orders.agg(F.max("o_orderkey")).first()[0] // 2
    return incremental.rows_after(orders, "o_orderkey", mark)


# ---- sinks -------------------------------------------------------------------------------------

@register("snk_partitioned", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""")
def partitioned(spark, sf_dir):
    path = fresh_path(spark, "orders-by-month")
    orders = table(spark, sf_dir, "orders")
    parts = [c for c in calendar_parts(F.col("o_orderdate"))]
    sink.write_parquet(orders.select("o_orderkey", *parts).select("o_orderkey", "year", "month"),
                       path, ["year", "month"])
    return spark.read.schema("o_orderkey bigint, year int, month int").parquet(path)


@register("snk_lake", _SQL["lake", "songplays"])
def lake(spark, sf_dir):
    """The lake job's fact, as written in folders by year and month."""
    path = fresh_path(spark, "lake")
    fact = star.build(inputs.logs(spark, sf_dir), inputs.songs(spark, sf_dir), "lake",
                      ("songplays",))["songplays"]
    sink.write_parquet(fact, path, star.LAKE_PARTITIONS["songplays"])
    back = spark.read.schema(star.VARIANTS["lake"].tables["songplays"].struct).parquet(path)
    return _naive(back.drop("songplay_id"))


@register("snk_lake_songs", f"""
WITH {inputs.SONGS_SQL}
SELECT DISTINCT song_id, title, artist_id, CAST(year AS INTEGER) AS year, duration FROM songs""")
def lake_songs(spark, sf_dir):
    """The lake job's songs: a folder per year, sorted by artist."""
    path = fresh_path(spark, "lake-songs")
    built = star.build(inputs.logs(spark, sf_dir), inputs.songs(spark, sf_dir), "lake", ("songs",))["songs"]
    sink.write_parquet(built, path, star.LAKE_PARTITIONS["songs"], sort=["artist_id"])
    return spark.read.schema(built.schema).parquet(path).select(*built.columns)


@register("snk_distributed", "SELECT o_orderkey, o_custkey FROM orders")
def distributed(spark, sf_dir):
    """Orders in a table gathered by its distribution key."""
    spec = Table("distributed_orders", (Field("o_orderkey", "bigint"), Field("o_custkey", "bigint")),
                 distribution=("o_custkey",))
    database = _own_database(spark, "distributed")
    sink.create_tables(spark, [spec], database)
    return sink.load_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), spec, database)


def _own_database(spark, label: str) -> str:
    """A new database in the scratch folder."""
    path = fresh_path(spark, label)
    name = "tidemark_" + path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


@register("snk_load_table", """
SELECT s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(18,0)) AS s_acctbal FROM supplier
UNION ALL SELECT s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(18,0)) FROM supplier""")
def load_table(spark, sf_dir):
    """Create, load, empty and load, then append: twice the suppliers remain."""
    spec = Table("load_supplier", (
        Field("s_suppkey", "bigint", required=True), Field("s_name", "string"),
        Field("s_acctbal", "decimal(18,0)")), key=("s_suppkey",))
    rows = table(spark, sf_dir, "supplier").select("s_acctbal", "s_name", "s_suppkey")
    database = _own_database(spark, "load")
    sink.drop_tables(spark, [spec], database)
    sink.create_tables(spark, [spec], database)
    sink.load_table(rows, spec, database, truncate=True)
    sink.load_table(rows, spec, database, truncate=True)
    return sink.load_table(rows, spec, database)


@register("snk_csv_quoted", """
SELECT doc_id, text, lang, source FROM documents""")
def csv_quoted(spark, sf_dir):
    """Whole texts, with line breaks and quotes, through quoted CSV."""
    path = fresh_path(spark, "documents-csv")
    sink.write_quoted_csv(table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source"), path)
    return files.read_csv(spark, path, "doc_id bigint, text string, lang string, source string",
                          multiLine=True, ignoreLeadingWhiteSpace=False,
                          ignoreTrailingWhiteSpace=False)


@register("snk_keyed", _last_sql("song, user_id"))
def keyed(spark, sf_dir):
    spec = query_tables.QUERY_TABLES["users_by_song"]
    written = sink.write_keyed(_rows(spark, sf_dir), fresh_path(spark, "keyed"),
                               list(spec.partition_key), list(spec.clustering_key), _ORDER)
    return written.drop("ts")


@register("snk_keyed_merge", """
SELECT user_id, max(event_id) AS event_id,
  arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def keyed_merge(spark, sf_dir):
    """Purchases and sign-ups as a keyed table, with all other events merged into it."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    first = F.col("event_type").isin("purchase", "signup")
    path = fresh_path(spark, "merge-base")
    sink.write_mergeable(events.filter(first), path, ["user_id"], ["event_id"], MERGE_BUCKETS)
    sink.merge_into(spark, path, events.filter(~first), ["user_id"], ["event_id"], MERGE_BUCKETS)
    return sink.read_mergeable(spark, path)


@register("snk_keyed_versions", """
SELECT user_id, max(event_id) AS event_id,
  arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def keyed_versions(spark, sf_dir):
    """The same merge in three deliveries into a table of versions, small buckets of which split on the way."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    users = events.select(F.count_distinct("user_id")).first()[0]
    keyed = KeyedTable(spark, fresh_path(spark, "versions"), events.schema, ["user_id"], ["event_id"],
                       bucket_rows=max(1, users // 6))
    for part in range(3):
        keyed.merge(events.filter(F.col("event_id") % 3 == part), batch=part)
    if len(keyed.version().buckets) < 4:
        raise AssertionError("no bucket split twice")
    return keyed.read()


@register("snk_sorted", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def sorted_layout(spark, sf_dir):
    path = fresh_path(spark, "lineitem-sorted")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    sink.write_sorted(rows, path, ["l_shipdate"])
    return spark.read.schema(rows.schema).parquet(path)


@register("snk_bucketed", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders""")
def bucketed(spark, sf_dir):
    """Orders as a table bucketed and sorted by their key."""
    database = _own_database(spark, "bucket")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    sink.write_bucketed(orders, f"{database}.orders", 8, ["o_orderkey"])
    return spark.table(f"{database}.orders")


@register("lookup_bloom", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey = (SELECT max(o_custkey) FROM orders)""")
def lookup_bloom(spark, sf_dir):
    """Orders of a customer, from a table sorted by order key with Bloom filters on the customer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = orders.agg(F.max("o_custkey")).first()[0]
    path = fresh_path(spark, "orders-bloom")
    sink.write_sorted(orders, path, ["o_orderkey"], blooms={"o_custkey": 100_000})
    return spark.read.schema(orders.schema).parquet(path).filter(F.col("o_custkey") == customer)


@register("dq_while_loading", """
SELECT 'not_null:event_id' AS rule, count(*) FILTER (WHERE event_id % 97 = 3) AS violations
FROM events UNION ALL
SELECT 'domain:event_type', count(*) FILTER (WHERE event_type IN ('signup', 'view')) FROM events""")
def dq_while_loading(spark, sf_dir):
    """Violations of a table's rules, counted while its rows are loaded and sorted."""
    spec = Table("checked_events", (
        Field("event_id", "bigint", required=True),
        Field("event_type", "string", allowed=("click", "error", "purchase"))), sort=("event_id",))
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 97 != 3, F.col("event_id")).alias("event_id"), "event_type")
    database, violations = _own_database(spark, "checked"), {}
    sink.create_tables(spark, [spec], database)
    sink.load_table(events, spec, database, violations=violations)
    return spark.createDataFrame(list(violations.items()), "rule string, violations bigint")
