"""Sharding and mixing: their laws, brute force for what the draws take."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import mixing, sharding


def test_shards_are_even_and_whole(docs, corpus):
    rows = sharding.shuffled_shards(docs, 7, seed=1).collect()
    assert Counter((r.row.doc_id, r.row.text, r.row.key) for r in rows) == Counter((r[0], r[1], 0) for r in corpus)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(7))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_order_follows_seed_and_not_storage(docs, nothing):
    def order(frame, seed):
        rows = sharding.shuffled_shards(frame, 3, seed).collect()
        return [(r.row.doc_id, r.row.text) for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    first = order(docs, 1)
    assert order(docs.repartition(5), 1) == first != order(docs, 2)
    assert sharding.shuffled_shards(nothing, 3).count() == 0


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(0)
    seen = Counter(tuple(sharding.fisher_yates(3, rng)) for _ in range(6000))
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())
    assert sorted(sharding.fisher_yates(100, rng)) == list(range(100))


def test_targets_stop_at_twice_the_size():
    assert mixing.targets([100, 100, 100]) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([]) == [] and mixing.targets([0, 5]) == [0.0, 7.5]
    found = mixing.targets([10, 1000, 3, 400])
    assert sum(found) == pytest.approx(1.5 * 1413) and all(t <= 2 * s + 1e-9 for t, s in zip(found, [10, 1000, 3, 400]))


@pytest.mark.parametrize("shards", [1, 2, 5, 13])
def test_draws_add_up_and_agree(shards):
    totals = np.array([17, 0, 40, 3])
    per = -(-60 // shards)
    start = np.zeros(4, int)
    for shard in range(shards):
        here, before = mixing.draw(shard, shards, totals, per, seed=5)
        assert (before == start).all() and (here >= 0).all()
        assert here.sum() == min(per, max(0, 60 - shard * per))
        start += here
    assert (start == totals).all()


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 1000])
def test_permutations_are_whole_and_differ(n):
    first = mixing.permuted(np.arange(n), n, 1)
    assert sorted(first) == list(range(n))
    if n >= 10:
        assert (first != mixing.permuted(np.arange(n), n, 2)).any()


def sizes(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_large_counts_are_drawn():
    """Beyond numpy's sampler the draws have the law's mean and variance."""
    totals, n = np.array([3, 2, 1]) * 10 ** 9 + 7, 2 * 10 ** 9
    rng = np.random.default_rng(1)
    found = np.stack([mixing._split(rng, totals, n) for _ in range(1500)])
    assert (found.sum(1) == n).all() and (found >= 0).all() and (found <= totals).all()
    share, total = totals / totals.sum(), totals.sum()
    variance = n * share * (1 - share) * (total - n) / (total - 1)
    assert (abs(found.mean(0) - n * share) < 5 * np.sqrt(variance / 1500)).all()
    assert (abs(found.var(0) / variance - 1) < 0.2).all()


@pytest.mark.parametrize("singly", [0, 1, 64])
def test_thinning_has_the_exact_law(monkeypatch, singly):
    monkeypatch.setattr(mixing, "SAMPLER_LIMIT", 0)
    monkeypatch.setattr(mixing, "SINGLY", singly)
    totals, n, rounds = np.array([4, 3, 0, 2]), 4, 20_000
    rng = np.random.default_rng(2)
    found = Counter(tuple(mixing._split(rng, totals, n).tolist()) for _ in range(rounds))
    for a in range(5):
        for b in range(4):
            if 0 <= (c := n - a - b) <= 2:
                p = math.comb(4, a) * math.comb(3, b) * math.comb(2, c) / math.comb(9, n)
                assert abs(found.pop((a, b, 0, c), 0) / rounds - p) < 5 * math.sqrt(p / rounds)
    assert not found


def test_mix_of_documents(docs, corpus, nothing):
    options = dict(block=16, shard_blocks=32, seed=4)
    mixed = mixing.mix(docs, **options)
    rows = mixing.taken_words(mixed).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((r[0], sizes(r[1])) for r in corpus)
    names = sorted({r[3] for r in corpus if r[3]}) + [None]
    totals = [sum(sizes(r[1]) for r in corpus if r[3] == s) for s in names]
    wanted = dict(zip(totals, mixing.targets(totals)))
    taken = Counter()
    for r in rows:
        assert r.taken <= 2 * r["size"] and r.target == pytest.approx(wanted[r.source_size])
        taken[r.source_size] += r.taken
    assert all(abs(taken[s] - wanted[s]) <= 3 * 16 for s in totals)
    again = mixing.taken_words(mixing.mix(docs, **options)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    spans = mixed.spans.collect()
    least = [max(1, min(16, int(wanted[t]) // mixing.LEAST_BLOCKS)) for t in totals]
    assert len({(s.shard, s.slot) for s in spans}) <= sum(-(-2 * t // n) for t, n in zip(totals, least))
    assert all(abs(taken[t] - wanted[t]) <= max(1, 0.01 * wanted[t]) for t in totals)
    assert mixing.taken_words(mixing.mix(nothing)).count() == 0


def test_mixed_documents_hold_the_taken_words(docs, nothing):
    options = dict(block=16, seed=4)
    rows = mixing.mixed_documents(docs, **options).collect()
    assert mixing.mixed_documents(docs, **options).columns == docs.columns
    taken = mixing.taken_words(mixing.mix(docs, **options))
    assert sum(sizes(r.text) for r in rows) == taken.agg({"taken": "sum"}).first()[0]
    known = defaultdict(list)
    for r in docs.collect():
        known[r.doc_id].append((r.text or "").split())
    for r in rows:
        for stretch in r.text.split("\n"):
            part = stretch.split()
            assert any(part == t[i:i + len(part)] for t in known[r.doc_id] for i in range(len(t))), r.doc_id
    assert mixing.mixed_documents(nothing).count() == 0


def test_many_small_sources_meet_their_targets(spark):
    rows = [(i, " ".join(["w"] * (20 + i % 3)), f"s{i % 60:02d}") for i in range(300)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed=1)
    totals = defaultdict(int)
    for _, text, source in rows:
        totals[source] += sizes(text)
    names = sorted(totals)
    wanted = dict(zip(names, mixing.targets([totals[n] for n in names])))
    by_id, taken = {r[0]: r for r in rows}, Counter()
    found = mixing.taken_words(mixed).collect()
    for r in found:
        taken[by_id[r.doc_id][2]] += r.taken
    assert all(abs(taken[n] - wanted[n]) <= 1 for n in names)
    # What each document gives, from the spans by brute force; no word more than twice.
    words = defaultdict(Counter)
    for s in mixed.spans.join(mixed.documents.select("key", "doc_id"), "key").collect():
        words[s.doc_id].update(range(s["first"], s["first"] + s.words))
    assert {r.doc_id: r.taken for r in found} == {i: sum(words[i].values()) for i in by_id}
    assert all(n <= 2 and w < sizes(by_id[i][1]) for i, c in words.items() for w, n in c.items())
