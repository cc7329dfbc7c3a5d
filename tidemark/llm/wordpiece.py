"""Token counts by greedy longest match, in one pass over each word.

A trie of the pieces gets, for every node, a failure link and the number of pieces that are certain
once the next byte has no edge: taking the link and adding the number replaces going back over bytes
already read. So a word costs time linear in its length, and no piece is ever built.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker

REMEMBERED = 400_000
NONE = -1


class LongestMatch:
    """Counts of longest-match pieces. ``first`` pieces begin a word, ``later`` pieces go on.

    Nodes are numbers: 0 is the start of a word, 1 the start of any later piece.
    """

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes]):
        self.edges: dict[int, int] = {}          # node * 256 + byte -> node
        ends, parents = [False, False], [(NONE, 0), (NONE, 0)]
        for root, pieces in ((0, first), (1, later)):
            for piece in pieces:
                node = root
                for byte in piece:
                    step = node * 256 + byte
                    if step not in self.edges:
                        self.edges[step] = len(ends)
                        ends.append(False)
                        parents.append((node, byte))
                    node = self.edges[step]
                if node != root:
                    ends[node] = True
        children: list[list[int]] = [[] for _ in ends]
        for node, (parent, _) in enumerate(parents):
            if parent != NONE:
                children[parent].append(node)
        self.link, self.popped = [NONE] * len(ends), [0] * len(ends)
        queue = deque([*children[0], *children[1]])
        while queue:
            node = queue.popleft()
            queue.extend(children[node])
            parent, byte = parents[node]
            if ends[node]:                       # the whole string so far is one piece
                self.link[node], self.popped[node] = 1, 1
                continue
            z, popped = self.link[parent], self.popped[parent]
            while z != NONE and (to := self.edges.get(z * 256 + byte)) is None:
                popped += self.popped[z]
                z = self.link[z]
            if z != NONE:
                self.link[node], self.popped[node] = to, popped

    def count(self, word: bytes) -> int:
        """Pieces of the word, or 0 if some rest has no piece."""
        node, pieces, edges, link, popped = 0, 0, self.edges, self.link, self.popped
        for byte in word:
            while (to := edges.get(node * 256 + byte)) is None:
                if link[node] == NONE:
                    return 0
                pieces += popped[node]
                node = link[node]
            node = to
        while node > 1:
            if link[node] == NONE:
                return 0
            pieces += popped[node]
            node = link[node]
        return pieces


class WordCounts(dict):
    """Word -> number of pieces; frequent words are counted once."""

    def __init__(self, automaton: LongestMatch, before: bytes):
        self.automaton, self.before = automaton, before

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(self.before + word)
        if len(self) < REMEMBERED and len(word) < 64:
            self[word] = n
        return n


def ranked_pieces(ranks_path: str) -> list[bytes]:
    with open(ranks_path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file]


def _counter(ranks_path: str):
    def make() -> WordCounts:
        pieces = ranked_pieces(ranks_path)
        return WordCounts(LongestMatch([p for p in pieces if p[:1] == b" "],
                                       [p for p in pieces if p[:1] != b" "]), b" ")

    def count(batches):
        counts = per_worker(("word pieces", ranks_path), make)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch["text"]:
                found = [counts[w] for w in text.as_buffer().to_pybytes().split()]
                missed = found.count(0)
                words.append(len(found))
                tokens.append(sum(found) + missed)
                unknown.append(missed)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c, pa.int64()) for c in (words, tokens, unknown)]],
                ["doc_id", "n_words", "n_tokens", "n_unknown"])
    return count


def token_counts(docs: DataFrame, ranks_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_tokens, n_unknown.

    Words are what stands between white space; each is matched with a space before it, so pieces of
    the vocabulary that begin with a space begin words and the others go on. A word that
    can't be matched to its end counts as one token. Null and empty texts have no words. A text may be of any
    length: it passes word by word. Repeated rows, rows that share an id and rows without one are counted each for
    itself; other columns, whatever their names, are ignored. An empty table gives no rows.
    """
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")).mapInArrow(
        _counter(ranks_path), "doc_id long, n_words long, n_tokens long, n_unknown long")
