"""Language identification: held-out accuracy, odd texts, predictions by brute force."""

import os
import zlib

import numpy as np
import pytest

from tidemark.llm import language

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy(spark):
    from tidemark.llm.queries import QUERIES
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op5_language"](spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held_out) / len(held_out) > 0.97


def test_odd_rows(docs, corpus, nothing):
    net = language.fit(docs)
    assert net.languages == ["a", "b"]
    rows = docs.selectExpr("struct(doc_id, text) as row", "text")
    found = language.predicted(rows, net).collect()
    assert len(found) == len(corpus)
    for r in found:
        blank = not any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred == language.UNKNOWN) == blank and (r.score == 0) == blank
    kept = language.accepted(docs, net, 0.0)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in corpus)
    assert language.accepted(docs, net, 1.1).count() == 0
    assert language.fit(nothing) is None and language.predicted(rows, None).filter("score > 0").count() == 0
    assert language.accepted(nothing, net).count() == 0


@pytest.mark.parametrize("options", [{}, {"most_texts": 400}])
def test_every_label_is_learned(spark, monkeypatch, options):
    """More labels than 256; where few texts of each are taken, none is left out."""
    rows = [(10 * i + j, f"text {j} of l{i}", f"l{i}") for i in range(300) for j in range(4)]
    monkeypatch.setattr(language, "train", lambda texts, labels: labels)
    labels = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), **options)
    assert set(labels) == {r[2] for r in rows}
    assert len(labels) == 3 * len(rows) if not options else len(labels) < 3 * 2 * 400


def test_windows_cover_all_places():
    for n in (0, 1, 4, 255, 256, 257, 508, 509, 2000):
        data = np.random.default_rng(n).integers(1, 255, n).astype(np.uint8).tobytes()
        rows = language.windows(data)
        seen = {bytes(row[i:i + language.REACH]) for row in rows for i in range(len(row) - language.REACH + 1)}
        assert all(data[i:i + language.REACH] in seen for i in range(n - language.REACH + 1))
        assert rows[0].tobytes().rstrip(b"\0") == data[:language.WINDOW]


def test_training_is_repeatable():
    texts = [b"aaa bb a" * 9, b"zzz yy z" * 9] * 40
    first, second = (language.train(texts, ["p", "q"] * 40, epochs=6) for _ in range(2))
    assert (first.filters == second.filters).all() and (first.embedding == second.embedding).all()
    p = language.probabilities(first, np.concatenate([language.windows(t) for t in texts[:2]]))
    assert p[0, 0] > 0.8 and p[1, 1] > 0.8


def test_predictions_equal_brute_force(spark):
    """Every filter at every place of every window, one number at a time."""
    rng = np.random.default_rng(4)
    texts = ["kurz", "a" * 300 + "é" * 100 + "xyz " * 80, "".join(map(chr, rng.integers(97, 123, 700))), "12 ab"]
    net = language.train([t.encode() for t in texts] * 4, ["p", "q", "r", "q"] * 4, epochs=2)
    step = language.WINDOW - language.REACH + 1

    def score(data):
        total, weights = np.zeros(len(net.languages)), 0
        n = max(1, -(-(len(data) - language.REACH + 1) // step))
        for w in range(n):
            window = data[w * step:w * step + language.WINDOW].ljust(language.WINDOW, b"\0")
            pooled = []
            for f in range(net.filters.shape[1]):
                best = max(sum(float(net.embedding[window[place + i]] @ net.filters[i * language.EMBEDDING:(i + 1) * language.EMBEDDING, f])
                               for i in range(language.REACH)) for place in range(step))
                pooled.append(max(best + net.bias[f], 0))
            z = np.array(pooled) @ net.out + net.out_bias
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            weight = language.WINDOW if w < n - 1 else max(1, len(data) - (n - 1) * step)
            total, weights = total + weight * p, weights + weight
        return total / weights

    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row long, text string")
    for r in language.predicted(frame, net).collect():
        want = score(texts[r.row].encode())
        assert r.lang_pred == net.languages[want.argmax()] and abs(r.score - want.max()) < 1e-4
