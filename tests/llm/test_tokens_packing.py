"""Token counts, token ids and packing."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, tokens, wordpiece
from tidemark.llm.common import staged

SF = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def greedy(word, first, later):
    pieces, at, vocabulary = 0, 0, first
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 0
        pieces, at, vocabulary = pieces + 1, end, later
    return pieces


@pytest.mark.parametrize("seed", range(30))
def test_automaton_equals_greedy_search(seed):
    rng = random.Random(seed)
    def some(n):
        return {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(n)}
    first, later = some(rng.randint(1, 12)), some(rng.randint(0, 12))
    automaton = wordpiece.LongestMatch(first, later)
    for _ in range(300):
        word = bytes(rng.choices(b"abc", k=rng.randint(0, 12)))
        assert automaton.count(word) == greedy(word, first, later), (word, first, later)


def test_counts_of_documents(docs, corpus, nothing):
    pieces = wordpiece.ranked_pieces(RANKS)
    first, later = {p for p in pieces if p[:1] == b" "}, {p for p in pieces if p[:1] != b" "}
    def counts(text):
        found = [greedy(b" " + w, first, later) for w in (text or "").encode().split()]
        return len(found), sum(found), 0
    rows = wordpiece.token_counts(docs, RANKS).collect()
    short = [r for r in corpus if len(r[1] or "") < 5000]
    long_ids = {r[0] for r in corpus} - {r[0] for r in short}
    assert Counter((r.doc_id, r.n_words, r.n_tokens, r.n_unknown) for r in rows if r.doc_id not in long_ids) \
        == Counter((r[0], *counts(r[1])) for r in short)
    assert len(rows) == len(corpus) and wordpiece.token_counts(nothing, RANKS).count() == 0


def test_ids_equal_the_tokenizer_file():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = tokens.BytePairs(RANKS, public_tokenizers.PATTERN).encode
    rng = random.Random(5)
    texts = ["", " ", "It's we'll they'VE  two  spaces\n\n x\t\r\n", "é à ñ ß ſ ½ ² ª º × ÷ 中文 😀 \x1c \x85\xa0 a",
             "<|endoftext|> a<|endoftext|>b", "...!!?? 123abc 12.5 _x_ — “q” …", "x" * 500, "  y ​ z"]
    alphabet = "ab Z09'\n\t .,!éß—’st \x1d"
    texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)]
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == want, text


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_ids_equal_the_tokenizer_file_on_all_documents():
    import pyarrow.parquet as pq
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = tokens.BytePairs(RANKS, public_tokenizers.PATTERN).encode
    texts = [t or "" for t in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()]
    for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encode(text), "<u4").tolist() == found.ids


def test_pieces_and_places(docs, corpus, nothing):
    capacity = 64
    pieces = staged(packing.token_pieces(docs, RANKS, public_tokenizers.PATTERN, capacity), "t")
    rows = packing.packed(pieces.withColumnRenamed("ids", "id"), capacity, ("doc_id", "piece", "start")).collect()
    encode = tokens.BytePairs(RANKS, public_tokenizers.PATTERN).encode
    want = []
    for doc_id, text, *_ in corpus:
        ids = np.frombuffer(encode(text or ""), "<u4").tolist() + [2]
        head = len(ids) % capacity or capacity
        cut = [ids[:head], *[ids[i:i + capacity] for i in range(head, len(ids), capacity)]]
        start = 0
        for i, c in enumerate(cut):
            want.append((doc_id, i, start, len(c), np.array(c, "<u4").tobytes()))
            start += len(c)
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.id)) for r in rows) == Counter(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.02 * total / capacity + 2
    none = staged(packing.token_pieces(nothing, RANKS, public_tokenizers.PATTERN), "t")
    assert packing.packed(none).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_plan_equals_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.randint(5, 60)
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 300))]
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    groups = packing.best_fit(dict(Counter(lengths)), capacity)
    assert sum(many for many, _ in groups) == len(rooms)
    assert len(groups) <= 3 * capacity
    placed = Counter()
    for many, contents in groups:
        assert sum(n * c for n, c in contents) <= capacity
        placed.update({n: 0 for n, _ in contents})
        for n, c in contents:
            placed[n] += many * c
    assert placed == Counter(lengths)
    rows = packing.plan_rows(groups)
    for length, n in Counter(lengths).items():
        ranks = sorted((a, b) for l, a, b, *_ in rows if l == length)
        assert ranks[0][0] == 0 and ranks[-1][1] == n
        assert all(x[1] == y[0] for x, y in zip(ranks, ranks[1:]))


def test_a_billion_pieces_plan_as_fast():
    groups = packing.best_fit({n: 10 ** 9 + n for n in range(1, 1025)}, 1024)
    assert len(groups) < 3 * 1024
