"""Repeated passages against a brute-force search, and the parts of the merge."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import substrings as sub

LENGTH = 100


def brute_force(rows, length=LENGTH):
    """rows: (id, text) in order -> (n_bytes, n_removed, n_spans, sha of what is kept)."""
    seen, found = set(), []
    for _, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            if s in seen:
                gone[i:i + length] = True
            seen.add(s)
        edges = np.diff(np.r_[0, gone.astype(int), 0])
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        found.append((len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return found


def made(seed, n=60):
    rng = random.Random(seed)
    def prose(k):
        return "".join(rng.choices("abcdefgh ", k=k))
    passages = [prose(rng.randint(60, 400)) for _ in range(5)]
    hot, texts = prose(230), []
    for i in range(n):
        parts = [prose(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a:a + rng.randint(0, len(p))], prose(rng.randint(0, 120))]
        if i % 2:
            parts += [hot, prose(rng.randint(0, 150))]
        texts.append("".join(parts))
    return texts + ["aa" * 300, "ab" * 200, "a" * 250, "", None, texts[3], texts[3] + "ü" * 120, "x" * 99]


@pytest.mark.parametrize("seed, often, chunk_bytes", [(1, 10_000, 2000), (2, 8, 2000), (3, 8, 1 << 20), (4, 3, 300)])
def test_equals_brute_force(spark, seed, often, chunk_bytes):
    rows = list(enumerate(made(seed)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in sub.without_repeats(frame, often=often, chunk_bytes=chunk_bytes).collect()}
    for (doc_id, text), want in zip(rows, brute_force(rows)):
        r = got[doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, doc_id
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_removed


def test_odd_rows(docs, corpus, nothing):
    rows = sub.without_repeats(docs).collect()
    assert len(rows) == len(corpus)
    assert sorted(r.n_bytes for r in rows) == sorted(len((r[1] or "").encode()) for r in corpus)
    unique = [r for r in corpus if [x[0] for x in corpus].count(r[0]) == 1 and r[0] is not None]
    later = sorted((r for r in corpus if r[0] is not None), key=lambda r: r[0])
    # Three equal rows of one id: whichever comes first, two are cut away and the outcome is the same.
    assert {r.doc_id for r in rows} == {r[0] for r in corpus} and unique and later
    assert sub.without_repeats(nothing).count() == 0


def test_loser_tree_merges_and_tells_what_is_shared():
    rng = random.Random(2)
    for k in (1, 2, 3, 7):
        runs, every = [], []
        for c in range(k):
            suffixes = sorted({bytes(rng.choices(b"ab", k=12)) for _ in range(rng.randint(0, 40))})
            rows = np.array([list(s) for s in suffixes], np.uint8).reshape(-1, 12)
            data = sub.encode_run(rows, np.arange(len(rows)), np.arange(len(rows)))
            assert [s for _, s, _ in sub.decode_run(data, c)] == suffixes
            runs.append(sub.decode_run(data, c))
            every += [(s, (i, c, i)) for i, s in enumerate(suffixes)]
        out = list(sub.merged(runs))
        assert [(s, p) for _, s, p in out] == sorted(every)
        for (_, a, _), (shared, b, _) in zip(out, out[1:]):
            assert shared == next((i for i in range(12) if a[i] != b[i]), 12)


def test_merges_more_runs_than_one_tree_takes(monkeypatch):
    monkeypatch.setattr(sub, "FAN_IN", 3)
    runs = [iter([(0, b"%03d" % (i * 7 % 50), (i, 0, 0))]) for i in range(50)]
    assert [s for _, s, _ in sub.merged(runs)] == [b"%03d" % i for i in range(50)]


def test_no_known_byte_is_compared(monkeypatch):
    """Comparisons start where both entries' shared prefix ends."""
    looked = []
    class Spy(bytes):
        def __getitem__(self, at):
            if isinstance(at, slice) and at.start is not None:
                looked.append(at.start)
            return bytes.__getitem__(self, at)
    rows = [b"a" * 30 + bytes([65 + i]) for i in range(8)]
    runs = [iter([(0, Spy(rows[i]), (0, i, 0)), (30, Spy(rows[i + 4]), (0, i, 1))]) for i in range(4)]
    assert [bytes(s) for _, s, _ in sub.merged(runs)] == rows
    assert looked.count(0) <= 6 and all(x in (0, 30) for x in looked)


def test_blocks_give_the_same_anchors():
    rng = random.Random(6)
    data = np.frombuffer(bytes(rng.choices(b"abcd", k=3000)) + b"a" * 500, np.uint8)
    ends = np.array([700, 750, 2000, 3500])
    with np.errstate(over="ignore"):
        whole, *cut = (sub.anchors(data, ends, LENGTH, block) for block in (10_000, 64, 701, 3401))
    for other in cut:
        assert all((a == b).all() for a, b in zip(whole, other))


def test_equal_strings_name_the_same_place():
    rng = random.Random(4)
    passage = bytes(rng.choices(b"abc", k=300))
    found = []
    for before in (b"", b"xyz" * 20):
        data = np.frombuffer(before + passage + b"!" * 50, np.uint8)
        with np.errstate(over="ignore"):
            place, hashes, left, right = sub.anchors(data, np.array([len(data)]), LENGTH)
        found.append({int(p) - len(before): int(h) for p, h in zip(place, hashes) if 61 <= p - len(before) < 200})
    assert found[0] == found[1] and found[0]


def test_runs_merge_touching_stretches_within_a_document():
    spans = np.array([[0, 5], [5, 9], [12, 20], [3, 7], [20, 24], [30, 31]])
    found = sub._runs(spans[:, 0], spans[:, 1], np.array([0, 20, 20, 40]))
    assert [x.tolist() for x in found] == [[0, 0, 2, 2], [0, 12, 20, 30], [9, 20, 24, 31]]
    assert [x.tolist() for x in sub._runs(spans[:0, 0], spans[:0, 1], np.array([0, 3]))] == [[], [], []]
