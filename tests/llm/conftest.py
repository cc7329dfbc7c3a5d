import os
import random
from collections import Counter

import duckdb
import pytest

from tidemark.llm.queries import QUERIES, SQL

#: Columns whose names the operators use inside; they must pass through or be left alone.
EXTRA = ["key", "row", "rep", "size", "part", "bucket", "component", "n", "id", "_part", "tie", "place"]


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Documents as (doc_id, text, lang, source): copies, near copies, shared passages, odd cases."""
    rng = random.Random(3)
    base = [words(rng, rng.randint(1, 120)) for _ in range(25)]
    passage = words(rng, 60)
    texts = base + base[:4] + [" " + base[0].replace(" ", "  "), base[1].upper()]
    texts += [t.rsplit(" ", 2)[0] + " zz" for t in base[:8]] + [f"{t} {passage} {t[:50]}" for t in base[5:9]]
    texts += [None, "", "", " \t\n", "one", "one two", "12 34", "ß" * 300, "x" * 70_000 + " end", "a b " * 2000]
    rows = [(i, t, "ab"[i % 2], None if i % 7 == 0 else f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(3, texts[3], "a", "s0"), (3, texts[3], "a", "s0"), (4, words(rng, 30), None, "s1"),
             (None, texts[2], "b", "s1"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    frame = spark.createDataFrame(
        [(*r, *range(len(EXTRA))) for r in corpus],
        "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` long" for c in EXTRA))
    return frame.repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.filter("false")


@pytest.fixture
def equals_sql(spark):
    """Whether a query's rows over a small set of tables are those of its SQL."""
    sf_dir = "/root/testdata/sf0.01"

    def check(name, *tables):
        if not os.path.isdir(sf_dir):
            pytest.skip("no test tables")
        frame = QUERIES[name](spark, sf_dir)
        duck = duckdb.connect()
        for table in tables:
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        cursor = duck.execute(SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(frame.columns)
        assert Counter(map(tuple, frame.select(*names).collect())) == Counter(map(tuple, cursor.fetchall()))
    return check
