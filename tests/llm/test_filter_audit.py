"""The audit of filters against a replay of every order, with files that arrive in any order."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit

SCHEMA = "doc_id long, text string, source string, key long, mask long, part long, n long, `of` long, good long"


def failing(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {f for f, bad in zip("ABCD", (
        len(words) < 50, 100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search("[#$%&*|]", text)))) if bad}


def brute_force(rows, labels):
    good, toxic = ({d for d, *x in labels if d is not None and x[i] == 1} for i in (0, 1))
    low = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            low[text or ""] = min(doc_id, low.get(text or "", doc_id))
    docs = []
    for doc_id, text, source in rows:
        text = text or ""
        copy = doc_id is not None and low[text] < doc_id
        docs.append((source or "", failing(text) | ({"E"} if copy else set()), doc_id in good, doc_id in toxic))
    out, removed_by = {}, defaultdict(Counter)
    parts = {d[0] for d in docs}
    for order in map("".join, permutations("ABCDE")):
        left = docs
        for step, f in enumerate(order, 1):
            gone, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
            for part in parts:
                mine = [d for d in gone if d[0] == part]
                fails = [d for d in docs if d[0] == part and f in d[1]]
                removed_by[part][f] += len(mine)
                out[part, order, step] = [
                    sum(d[0] == part for d in left), len(mine), len(fails) - len(mine),
                    sum(d[1] == {f} for d in fails), sum(d[2] for d in mine), sum(d[3] for d in mine)]
    return Counter((*k, *v, removed_by[k[0]][k[1][k[2] - 1]]) for k, v in out.items())


def made_up(rng, n):
    texts = [None, "", " ", "a #", "Ab " * 60, " ".join(map(str, range(55))), " ".join(map(str, range(60))) + " $",
             "X" * 90_000, " ".join(f"Wo{i}rd" for i in range(70))] + [f"{i} and so on" for i in range(10)]
    rows = [(rng.choice([*range(n // 2), None]), rng.choice(texts), rng.choice(["s", "t", None, ""])) for _ in range(n)]
    return rows + [(900 - i, "copied " * 70, "s") for i in range(60)] + rows[:10]


@pytest.fixture
def stream(spark, tmp_path):
    def make(rows, files):
        folder = str(tmp_path / "docs")
        extra = len(SCHEMA.split(",")) - 3
        for at in range(0, max(1, len(rows)), max(1, -(-len(rows) // files))):
            spark.createDataFrame([(*r, *range(extra)) for r in rows[at:at + max(1, -(-len(rows) // files))]], SCHEMA).coalesce(1).write.mode(
                "append").parquet(folder)
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return make


@pytest.fixture
def labels(spark):
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 950, 2)] + [(2, 1, 0), (2, None, 1), (None, 1, 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_replay_of_all_orders(stream, labels, tmp_path, seed):
    rng = random.Random(seed)
    rows = made_up(rng, 150)
    rng.shuffle(rows)
    found = filter_audit.audit(stream(rows, 5), labels[1], str(tmp_path / "state")).collect()
    assert Counter(map(tuple, found)) == brute_force(rows, labels[0])


def test_smaller_ids_retract(spark, stream, labels, tmp_path):
    rows = [(i, "same text", f"s{i % 3}") for i in range(9, 0, -1)]
    folder = str(tmp_path / "state")
    found = filter_audit.count_masks(stream(rows, 9), labels[1], folder)
    short, copy = 1, filter_audit.DUPLICATE
    assert {(r["part"], r["mask"]): r["n"] for r in found.groupBy("part", "mask").agg(F.sum("n").alias("n")).collect()} == {
        ("s1", short): 1, ("s0", short | copy): 3, ("s1", short | copy): 2, ("s2", short | copy): 3}
    assert filter_audit.changes(spark, folder).filter("n < 0").count() == 8
    # What arrives later goes on from the state; nothing is counted twice.
    more = spark.createDataFrame([(0, "same text", "s2", *range(6))], SCHEMA).coalesce(1)
    more.write.mode("append").parquet(str(tmp_path / "docs"))
    again = filter_audit.count_masks(
        spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "docs")), labels[1], folder)
    assert {(r["part"], r["mask"]): r["n"] for r in again.groupBy("part", "mask").agg(F.sum("n").alias("n")).collect()} == {
        ("s2", short): 1, ("s0", short | copy): 3, ("s1", short | copy): 3, ("s2", short | copy): 3}


def test_large_ids_keep_all_digits(stream, labels, tmp_path):
    top = 2 ** 63 - 1
    rows = [(top, "big", "s"), (top - 1, "big", "s"), (None, "big", "s"), (top, "big", "s")]
    found = filter_audit.count_masks(stream(rows, 4), labels[1], str(tmp_path / "state")).collect()
    assert {r["mask"]: r["n"] for r in found} == {1: 2, 1 | filter_audit.DUPLICATE: 2}


def test_empty_table(stream, labels, tmp_path):
    assert filter_audit.audit(stream([], 1), labels[1], str(tmp_path / "state")).count() == 0


def test_query_equals_sql(equals_sql):
    equals_sql("op12_filter_audit", "documents", "labels")
