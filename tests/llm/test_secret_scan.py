"""Secret scans against plain searches with each pattern, and the conditions that patterns give."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import secret_scan as scan

PATTERNS = [
    ("assign", r"""(?a:(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]


def brute_force(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def made_up(n=400):
    rng = random.Random(4)
    bits = ["token", "TOKEN ", "apikey", "Api_Key", "PassWord", "passwd", "secret", ' : "', "=", "='", '"', " ", "ß𝒳",
            "İ", "K", "AKIA", "AKIAABCDEFGH1234", "AKIA12345678", "deadbeef" * 4, "deadbeef" * 3, "12345678", "abc.def-g",
            "hunter2!", "\n", "ſecret=abcdefgh1", "word"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(n)]
    texts += [None, "", "token=" + "a" * 200_000, "x" * 100_000 + " secret: 12345678", "token " * 30_000 + "= 'abcdefgh'",
              "f" * 31 + "g" + "f" * 33, "AKIA" * 5, "password=short", "𝒳" * 5 + "token=abcdefgh"]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(3, "token=abcdefgh"), (3, "none"), (3, "none")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [5, 4096])
def test_equals_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(scan, "BLOCK", block)
    rows = made_up()
    extra = ["row", "_id", "kinds", "trigram", "ids", "of", "met", "spans", "block"]
    frame = spark.createDataFrame([(*r, *range(len(extra))) for r in rows],
                                  "doc_id long, text string, " + ", ".join(f"`{c}` long" for c in extra)).repartition(3)
    found = scan.scanned(frame)
    assert sorted(found.columns) == sorted(frame.columns)
    got = found.select("doc_id", "text", scan.listed(F.col("spans")).alias("spans")).collect()
    assert Counter(map(tuple, got)) == Counter((d, t, brute_force(t)) for d, t in rows)
    assert scan.scanned(frame.filter("false")).count() == 0


def test_conditions():
    token = ("and", ("tok", "oke", "ken"))
    assert scan.trigram_condition("token[:=]+x?") == token
    assert scan.trigram_condition(f"({scan.either_case('token')})+") == token
    assert scan.trigram_condition("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert scan.trigram_condition("api_?key") == ("or", (
        ("and", ("api", "pi_", "i_k", "_ke", "key")), ("and", ("api", "pik", "ike", "key"))))
    assert scan.trigram_condition("(abcd|[0-9a-f]+)") is True
    assert scan.trigram_condition("[0-9a-f]{32,}") is True
    assert scan.trigram_condition("ab") is True
    assert scan.trigram_condition("(abc)*def") == "def"
    assert scan.trigram_condition(".abc.*xyz$") == ("and", ("abc", "xyz"))
    assert scan.trigram_condition("x[ab]yz") == ("or", (("and", ("xay", "ayz")), ("and", ("xby", "byz"))))


def test_only_candidates_are_searched(spark):
    rows = [(i, "no" * i) for i in range(50)] + [(50, "a token"), (51, "AKIA"), (52, "api_key passwd"), (53, "tok oke ken")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rules = scan.RULES[:2]
    index = scan.postings(docs, set().union(*(scan.trigrams_of(scan.trigram_condition(r.pattern)) for r in rules)))
    found = {r["_id"]: set(r["kinds"]) for r in scan.candidates(index, rules).collect()}
    # Trigrams may stand apart: a candidate is no match yet.
    assert found == {50: {"assign"}, 51: {"access"}, 52: {"assign"}, 53: {"assign"}}


def test_main_path_has_no_python(spark, plan):
    docs = spark.createDataFrame([(1, "token=abcdefgh")], "doc_id long, text string")
    assert not re.search("Python|Pandas|Arrow", plan(scan.scanned(docs)))


def test_query_equals_sql(equals_sql):
    equals_sql("op13_secret_scan", "documents")
