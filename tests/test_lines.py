"""Records written as compressed lines, and the queries that write them first."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest

from tidemark.sinks import tables
from tidemark.workload import QUERIES, inputs


@pytest.fixture
def sf(spark, tmp_path):
    day = dt.datetime(1996, 5, 1)
    lines = [(n // 7, n % 20, n % 3, n % 7 + 1, n % 50 + 1.0, 0.02, "RNA"[n % 3], "OF"[n % 2], day) for n in range(60)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp") \
        .selectExpr("* except (l_shipdate)", "CAST(l_shipdate AS timestamp_ntz) AS l_shipdate") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(n, n % 50, 10.0 + n, "brass") for n in range(20)],
                          "p_partkey bigint, p_size int, p_retailprice double, p_type string") \
        .write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def _records(spark) -> set[str]:
    """Files of records, by their names, below the scratch folder."""
    found = glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/**/part-*", recursive=True)
    return {f for f in found if ".json" in os.path.basename(f) or ".txt" in os.path.basename(f)}


@pytest.mark.parametrize("name", ["src_json_lines", "src_json_staged", "src_json_rejects", "star_pipeline_published"])
def test_records_are_written_compressed(spark, sf, name):
    before = _records(spark)
    rows = QUERIES[name].run(spark, sf).count()
    logs = inputs.logs(spark, sf)
    assert rows == (logs.filter("page = 'NextSong'") if "star" in name else logs).count()
    new = _records(spark) - before
    assert new and all(f.endswith(".gz") for f in new)


def test_published_tables_are_compressed_well(spark, sf):
    fact = QUERIES["star_pipeline_published"].run(spark, sf)
    for file in fact.inputFiles():
        assert pq.ParquetFile(file.removeprefix("file:")).metadata.row_group(0).column(0).compression == "ZSTD"


def test_lines_in_folders_are_not_sorted(spark, rows, tmp_path, monkeypatch):
    """Each folder's rows stay in their order, come in files of few records, and all come back."""
    monkeypatch.setattr(tables, "LINES_PER_FILE", 10)
    df = spark.range(0, 90, 1, 1).selectExpr("id", "CAST(id % 3 AS string) AS k")
    save = "spark.sql.maxConcurrentOutputFileWriters"
    kept = spark.conf.get(save)
    tables.write_lines(df, f"{tmp_path}/few", ["k"])
    tables.write_lines(df.selectExpr("id", "id AS k"), f"{tmp_path}/many", ["k"])
    assert spark.conf.get(save) == kept
    files = glob.glob(f"{tmp_path}/few/k=*/*.gz")
    assert len(files) == 9
    back = spark.read.schema("id bigint, k string")
    assert rows(back.json(f"{tmp_path}/few")) == rows(df)
    assert back.json(f"{tmp_path}/many").count() == 90
    seen = [[r["id"] for r in back.json(f).collect()] for f in files]
    assert all(len(s) == 10 and s == sorted(s) for s in seen)
