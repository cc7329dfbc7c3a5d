"""The corpus pipeline, stage by stage, over the small tables and over odd rows."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tidemark.llm.common import staged

SF = "/root/testdata/sf0.001"


def test_stages_over_odd_rows(spark, docs, nothing):
    for start in (docs, nothing):
        frame = start
        for name, stage in pipeline.STAGES:
            before = frame
            frame = staged(stage(spark, frame, ""), name)
            if name != "packing":
                assert frame.columns == docs.columns
            if name in ("exact_dedup", "near_dedup"):
                assert frame.exceptAll(before).count() == 0
        assert (frame.count() > 0) == (start is docs)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_run(spark):
    assert "pipeline" in entry.queries()
    rows = pipeline.run(spark, SF).collect()
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert rows and max(fill.values()) <= 1024 and len(fill) < 1.05 * sum(fill.values()) / 1024 + 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op")))
def test_queries_run(spark, name):
    frame = entry.queries()[name](spark, SF)
    number = name[2:].split("_")[0]
    table = spark.read.parquet(f"{SF}/{ {'3': 'pages', '10': 'embeddings', '11': 'conversations'}.get(number, 'documents') }.parquet")
    if number == "11":
        n = table.select("conv_id").distinct().count()
    elif number == "12":
        n = 600 * table.select("source").distinct().count()
    else:
        n = table.count()
    assert frame.count() == n or number == "8"
