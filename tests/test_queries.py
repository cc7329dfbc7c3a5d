"""Every registered query against its SQL twin in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.workload import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, plan, name):
    df = entry.queries()[name](spark, SF)
    for word in ("Python", "ArrowEval", "CartesianProduct", "NestedLoopJoin"):
        assert word not in plan(df)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert got == want


STREAMS = {
    "stream_dim_latest": "dim_latest", "stream_sliding_count": "sliding_count",
    "stream_call_statistics": "call_statistics", "stream_stream_join": "customer_risk",
    "stream_station_table": "station_table", "stream_slot_board": "slot_board",
    "stream_customers_decoded": "customers_decoded", "stream_risk_latest": "customer_risk",
}


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """The tables as folders of several files, in no order of time."""
    root = tmp_path_factory.mktemp("split")
    for name in ("events", "customer", "orders", "part", "nation"):
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(3).write.parquet(
            str(root / f"{name}.parquet"))
    return str(root)


@pytest.mark.parametrize("name", sorted(STREAMS))
def test_stream_of_many_batches_equals_batch(spark, split_tables, monkeypatch, rows, name):
    from tidemark.workload import inputs
    monkeypatch.setattr(inputs, "PER_TRIGGER", 1)      # one file at a time
    batch = entry.queries()[STREAMS[name]](spark, split_tables)
    stream = entry.queries()[name](spark, split_tables)
    assert rows(stream, *sorted(batch.columns)) == rows(batch, *sorted(batch.columns))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
