"""Near duplicates of texts and vectors, and components, against brute force."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import minhash, vectors
from tidemark.llm.components import components


def smallest(n, links):
    """Smallest member of each node's component."""
    label = dict.fromkeys(n)
    for x in label:
        label[x] = x
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= (label[a], label[b]) != (low, low)
            label[a] = label[b] = low
    return label


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def expected(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    links = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if a is not None and b is not None
             and s and t and 100 * len(s & t) >= 75 * len(s | t)]
    return smallest({d for d, _ in rows if d is not None}, links)


def test_components(spark):
    rng = random.Random(0)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in rows} == smallest({x for l in links for x in l}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("order", ["random", "worst"])
def test_rounds_on_a_path(spark, monkeypatch, order):
    """A path of 4,096 ids takes about as many rounds as it can be halved."""
    from tidemark.llm import components as module
    ids = list(range(2, 4096))
    if order == "random":
        random.Random(3).shuffle(ids)
    ids = [0] + ids[:2047] + [1] + ids[2047:]
    written = []

    def staged(frame, label, write=module.staged):
        written.append(label)
        return write(frame, label)

    monkeypatch.setattr(module, "staged", staged)
    rows = components(spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")).collect()
    assert {r.component for r in rows} == {0} and len(rows) == 4096
    assert len(written) < 20


def test_texts_equal_brute_force(docs, corpus, nothing):
    rows = minhash.near_duplicates(docs).collect()
    want = expected([r[:2] for r in corpus])
    assert len(rows) == len(corpus)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in rows) == sorted(
        (d is None, d or 0, len(shingles(t))) for d, t, *_ in corpus)
    for r in rows:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)
    assert minhash.near_duplicates(nothing).count() == 0
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, *want.values()}


@pytest.mark.parametrize("hub_rounds, block", [(0, 4096), (2, 5)])
def test_chains_and_large_groups(spark, monkeypatch, hub_rounds, block):
    """Drifting copies, whose ends don't link; sweeps must find what the hubs don't."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(1)
    rows, words = [], [f"w{rng.randint(0, 9999)}" for _ in range(60)]
    for i in range(60):
        words = list(words)
        words[rng.randrange(len(words))] = f"n{i}"
        rows.append((i * 7 % 61, " ".join(words)))
    other = [f"v{i}" for i in range(40)]
    for i in range(30):
        some = list(other)
        some[rng.randrange(40)] = f"m{i}"
        rows.append((100 + i, " ".join(some)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, hub_rounds=hub_rounds).collect()}
    assert got == expected(rows)


def test_units_of_a_large_bucket_are_bounded(spark, monkeypatch):
    """A bucket of unconnected members: no unit gets more than blocks, and all pairs meet."""
    monkeypatch.setattr(minhash, "BLOCK", 20)
    monkeypatch.setattr(minhash, "VISITORS", 40)
    shared = spark.createDataFrame([(i, 7, 100) for i in range(600)], "rep long, bucket long, n_shingles long")
    linker = minhash._Linker(shared, None, 75)
    units = defaultdict(list)
    for r in linker.units(0).collect():
        units[r.bucket, r.qb, r.mb].append(r)
    assert max(map(len, units.values())) < 2 * (20 + 40)
    met = {frozenset((a.rep, b.rep)) for rows in units.values() for a in rows if a.own for b in rows if b.asks}
    assert sum(len(pair) == 2 for pair in met) == 600 * 599 // 2


def test_blocks_follow_the_size_of_sets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 10_000)
    shared = spark.createDataFrame([(i, 7, 1000) for i in range(50)], "rep long, bucket long, n_shingles long")
    assert minhash._Linker(shared, None, 75).units(0).select("mb").distinct().count() == 5


def test_visitors_pass_by_a_block():
    """Links come out before all visitors are read, and as many as join components."""
    def rows(start, n, own):
        import pyarrow as pa
        ids = np.arange(start, start + n)
        same = pa.array([[5]] * n, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(n, np.int64) + x) for x in (7, 0, 0)] + [pa.array(ids), pa.array(ids)]
            + [pa.array([own] * n), pa.array([not own] * n), pa.array(np.full(n, 4)), same,
               pa.array([[7]] * n, pa.list_(pa.int64())), pa.array([[3, 9, 1, 6]] * n, pa.list_(pa.int64()))],
            ["bucket", "qb", "mb", "rep", "component", "own", "asks", "n_shingles", "sketch", "bands", "shingles"])

    read = []

    def batches():
        for i in range(6):
            read.append(i)
            yield rows(100 * i, 100, i == 0)

    found = minhash._swept(minhash._Judge(75))(batches())
    first = next(found)
    assert read == [0, 1]
    links = [tuple(x.values()) for batch in (first, *found) for x in batch.to_pylist()]
    # The first visitor joins the hundred members, each other one itself.
    assert len(links) == 599
    label = smallest(range(600), links)
    assert set(label.values()) == {0}


def test_templates_that_do_not_link(spark):
    """A group of which every pair must be judged by the full sets, and none links: no row for a pair."""
    rng = random.Random(5)
    common = " ".join(f"w{i}" for i in range(100))
    rows = [(i, common + " " + " ".join(f"u{rng.random()}" for _ in range(17))) for i in range(700)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(shingles(rows[0][1]) & shingles(rows[1][1])) / len(shingles(rows[0][1]) | shingles(rows[1][1])) > 0.69
    assert all(r.kept for r in found) and len(found) == 700


def test_one_text_alone_links_two_groups(spark):
    """A member of a large bucket that is near to others than its hub."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:-1 - i % 30] + [f"x{i}"])) for i in range(90)]
    rows += [(1000 + i, " ".join([f"y{j}" for j in range(i)] + words[i:])) for i in range(0, 45, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()}
    assert got == expected(rows)


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for similarity in (0.5, 0.75, 0.95):
        apart = []
        for _ in range(30):
            shared = rng.integers(0, 1 << 63, int(1000 * similarity), np.uint64)
            own = rng.integers(0, 1 << 63, 1000 - len(shared), np.uint64)
            half = len(own) // 2
            with np.errstate(over="ignore"):
                both = [minhash.samples_of(np.r_[shared, x]) for x in (own[:half], own[half:])]
                a, b = minhash.odd_sketches(np.stack(both))
            apart.append(int(np.bitwise_count((a ^ b).view(np.uint64)).sum()))
        assert abs(np.mean(apart) - minhash.differing_bits(similarity)) < 25


# ---- vectors -----------------------------------------------------------------------------

def vectors_of(seed, n=300, width=20):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    rows = [(i, (centres[rng.integers(12)] + rng.standard_normal(width) * rng.choice([0.05, 0.2, 0.25])).tolist())
            for i in range(n)]
    rows += [(n + i, rows[i % 3][1]) for i in range(20)]
    rows += [(n + 30, None), (n + 31, []), (n + 32, [0.0] * width), (n + 33, [float("nan")] * width),
             (n + 34, [1.0, None] * (width // 2)), (n + 35, [float("inf")] + [1.0] * (width - 1)),
             (n + 36, [1.0, 2.0]), (n + 37, [2.0, 4.0]), (n + 38, [1e200] * width), (n + 39, [1e-200] * width)]
    return rows


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"cells": 30, "block": 16}), (3, {"sample_rows": 40, "cells": 9})])
def test_vectors_equal_brute_force(spark, seed, options):
    rows = vectors_of(seed)
    random.Random(seed).shuffle(rows)
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.sqrt(v @ v)
    units = {i: unit(v) for i, v in rows}
    links = [(a, b) for a, x in units.items() for b, y in units.items()
             if a < b and x is not None and y is not None and len(x) == len(y) and x @ y >= 0.95]
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    label = smallest(units, links)
    frame = spark.createDataFrame([(i, v, 0, 1) for i, v in rows],
                                  "vec_id long, embedding array<double>, rep int, cell int").repartition(3)
    got = vectors.linked_vectors(frame, **options).collect()
    assert len(links) > 500 and len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], label[r.vec_id], label[r.vec_id] == r.vec_id)


@pytest.mark.parametrize("centres", [256, 4])
def test_recall_near_the_threshold(spark, monkeypatch, centres):
    """Pairs just above the threshold among scattered vectors, over one level of centres and over several."""
    monkeypatch.setattr(vectors, "CENTRES", centres)
    rng = np.random.default_rng(7)
    x = rng.standard_normal((6000, 64))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    side = rng.standard_normal((1500, 64))
    side -= (side * x[:1500]).sum(1, keepdims=True) * x[:1500]
    side /= np.sqrt((side * side).sum(1, keepdims=True))
    x[4500:] = 0.952 * x[:1500] + math.sqrt(1 - 0.952 ** 2) * side
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.linked_vectors(frame).collect()}
    true = ((x @ x.T) >= 0.95).sum(1) - 1
    found = np.array([got[i] for i in range(6000)])
    assert true.sum() >= 3000 and (found <= true).all() and found.sum() >= 0.9 * true.sum()
    # A link counts for both of its ends.
    assert (found[:1500] == found[4500:]).all()


def test_vectors_without_id_or_rows(spark):
    frame = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])],
                                  "vec_id long, embedding array<double>")
    rows = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vectors.linked_vectors(frame).collect()))
    assert rows == [(0, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert vectors.linked_vectors(frame.filter("false")).count() == 0
    assert vectors.linked_vectors(frame.filter("vec_id is null")).first().n_links == 0
