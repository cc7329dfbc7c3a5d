"""Exact duplicates against a brute-force grouping."""

import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tidemark.llm import exact_dedup as ed
from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_groups_equal_brute_force(docs, corpus):
    groups = defaultdict(list)
    for doc_id, text, *_ in corpus:
        groups[norm(text)].append((-len(text or ""), doc_id is None, doc_id))
    rows = ed.duplicate_groups(docs, table_bytes=500).collect()
    want = Counter((d, min(groups[norm(t)])[2], len(groups[norm(t)])) for d, t, *_ in corpus)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_whole_rows_stay(docs, corpus):
    rows = ed.deduplicated(docs).collect()
    assert ed.deduplicated(docs).columns == docs.columns
    assert len(rows) == len({norm(r[1]) for r in corpus})
    assert {norm(r.text) for r in rows} == {norm(r[1]) for r in corpus}


def test_empty_table(nothing):
    assert ed.duplicate_groups(nothing).count() == 0
    assert ed.deduplicated(nothing).columns == nothing.columns


def test_spill_files_at_several_levels():
    rng = random.Random(1)
    contents = [bytes(rng.choices(b"ab", k=rng.randint(0, 9))) for _ in range(3000)]
    records = [(c, i, i, len(c), 1) for i, c in enumerate(contents)]
    found = list(ed.grace(iter(records), table_bytes=40))
    assert Counter({c: g.size for c, g in found}) == Counter(contents)
    for content, group in found:
        assert sorted(group.keys) == [i for i, c in enumerate(contents) if c == content]
        assert -group.best[3] == contents.index(content)


def test_table_compares_content_of_equal_hashes():
    table = ed.ContentTable()
    for i in range(200):
        at = table.find(7, b"%d" % i)
        assert at < 0
        table.insert(~at, 7, b"%d" % i, ed.Group((i,)))
    assert [table.groups[table.find(7, b"%d" % i)].best[0] for i in range(200)] == list(range(200))


def test_folding_in_several_rounds(spark, corpus, monkeypatch):
    monkeypatch.setattr(ed, "FOLD_BYTES", 300)
    frame = spark.createDataFrame([r[:2] for r in corpus] * 3, "doc_id long, text string").coalesce(1)
    rows = ed.duplicate_groups(frame).collect()
    assert sum(r.kept for r in rows) == len({norm(r[1]) for r in corpus})


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_equals_sql(spark):
    frame = QUERIES["op1_exact_dedup"](spark, SF)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = duck.execute(SQL["op1_exact_dedup"])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert Counter(map(tuple, frame.select(*names).collect())) == Counter(map(tuple, cursor.fetchall()))


def test_a_table_of_short_contents_keeps_its_bound():
    import tracemalloc
    rng = random.Random(2)
    records = [(b"%012d" % rng.randrange(10 ** 12), i, i, 12, 1) for i in range(60_000)]
    tracemalloc.start()
    seen = 0
    for _ in ed.grace(iter(records), table_bytes=4 << 20):
        seen += 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == len({r[0] for r in records}) and peak < 10 << 20
