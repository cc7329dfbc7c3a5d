"""Language identification by a small convolutional network over bytes.

Filters of several widths run over byte embeddings of fixed-length windows; each filter keeps its largest
response in the window, and a softmax over those responses names the language. The network
is trained here, in numpy, on a bounded sample of labelled text; a document's whole text is read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
WINDOW, EMBEDDING, WIDTHS, FILTERS = 256, 8, (2, 3, 4, 5), 16
REACH = max(WIDTHS)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray      # 256 x EMBEDDING; byte 0 fills windows up
    filters: np.ndarray        # REACH * EMBEDDING x filters, zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray            # filters x languages
    out_bias: np.ndarray


def windows(data: bytes) -> np.ndarray:
    """All of the bytes in rows of WINDOW; rows overlap so that no filter misses a place."""
    step = WINDOW - REACH + 1
    n = max(1, -(-(len(data) - REACH + 1) // step))
    flat = np.zeros((n - 1) * step + WINDOW, np.uint8)
    flat[:len(data)] = np.frombuffer(data, np.uint8)[:len(flat)]
    return np.lib.stride_tricks.as_strided(flat, (n, WINDOW), (step, 1))


def responses(net: Network, rows: np.ndarray):
    """Largest response of each filter in each window, where it was, and the bytes' vectors there."""
    n = len(rows)
    vectors = net.embedding[rows]
    places = WINDOW - REACH + 1
    a, b, c = vectors.strides
    seen = np.lib.stride_tricks.as_strided(
        vectors, (n, places, REACH * EMBEDDING), (a, b, c)).reshape(n * places, -1)
    response = (seen @ net.filters).reshape(n, places, -1)
    return response, seen.reshape(n, places, -1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def probabilities(net: Network, rows: np.ndarray) -> np.ndarray:
    found = []
    for at in range(0, len(rows), 64):
        response, _ = responses(net, rows[at:at + 64])
        pooled = np.maximum(response.max(1) + net.bias, 0)
        found.append(softmax(pooled @ net.out + net.out_bias))
    return np.concatenate(found)


def train(texts: list[bytes], labels: list[str], epochs: int = 8, batch: int = 64, rate: float = 4e-3,
          seed: int = 0) -> Network:
    """Adam on the cross entropy of single windows; languages weigh alike."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    rows = [windows(t)[0] for t in texts]
    number = {language: i for i, language in enumerate(languages)}
    x, y = np.stack(rows), np.array([number[label] for label in labels])
    weight = (len(y) / len(languages) / np.bincount(y))[y].astype(np.float32)
    n_filters = FILTERS * len(WIDTHS)
    mask = np.concatenate([np.repeat(np.arange(REACH * EMBEDDING)[:, None] < w * EMBEDDING, FILTERS, 1)
                           for w in WIDTHS], 1)

    def normal(scale, *shape):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    net = Network(languages, normal(0.5, 256, EMBEDDING),
                  normal(0.2, REACH * EMBEDDING, n_filters) * mask, np.zeros(n_filters, np.float32),
                  normal(0.1, n_filters, len(languages)), np.zeros(len(languages), np.float32))
    net.embedding[0] = 0
    names = ["embedding", "filters", "bias", "out", "out_bias"]
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            mine = order[at:at + batch]
            m = len(mine)
            response, seen = responses(net, x[mine])
            place = response.argmax(1)                                  # m x filters
            best = np.take_along_axis(response, place[:, None], 1)[:, 0] + net.bias
            pooled = np.maximum(best, 0)
            error = softmax(pooled @ net.out + net.out_bias)
            error[np.arange(m), y[mine]] -= 1
            error *= weight[mine, None] / m
            back = (error @ net.out.T) * (best > 0)                     # m x filters
            there = seen[np.arange(m)[:, None], place]                  # m x filters x taps
            d_vector = back[:, :, None] * net.filters.T[None]           # m x filters x taps
            d_embedding = np.zeros_like(net.embedding)
            at_byte = x[mine][np.arange(m)[:, None, None], place[:, :, None] + np.arange(REACH)]
            np.add.at(d_embedding, at_byte.ravel(), d_vector.reshape(-1, EMBEDDING))
            d_embedding[0] = 0
            grads = {"embedding": d_embedding, "filters": np.einsum("mft,mf->tf", there, back) * mask,
                     "bias": back.sum(0), "out": pooled.T @ error, "out_bias": error.sum(0)}
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - rate * move).astype(np.float32))
    return net


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id",
        per_language: int = 600, per_text: int = 3, most_texts: int = 256 * 600) -> Network | None:
    """A network trained on about ``per_language`` texts of each language, chosen by a hash of the id.

    From each text come ``per_text`` windows at places chosen by the hash. Every language is learned; where
    there are so many that this would be more than ``most_texts`` texts, each gives fewer, one at
    least. Rows without label, id or letters are not used; without any row there is no network. Rows that share
    an id are taken or left together. Of a very long text only its windows reach the driver; other columns,
    whatever their names, are not read. The driver and a broadcast hold a row for each label, as the network itself does.
    """
    known = labelled.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()
                            & has_letter(F.col(text))).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label"),
        F.col(doc_id).cast("string").alias("id"))
    counts = known.groupBy("label").count().collect()
    if not counts:
        return None
    spark = labelled.sparkSession
    wanted = max(1, min(per_language, most_texts // len(counts)))
    chances = spark.createDataFrame([(r["label"], wanted / r["count"]) for r in counts],
                                    "label string, chance double")
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    parts = [F.substring("text", F.pmod(F.xxhash64("id", F.lit(i)), F.length("text")).cast("int") + 1,
                         F.lit(WINDOW)) for i in range(per_text)]
    # The network has a row for each label, so the labels fit a task; texts are not shuffled by label.
    sample = (known.join(F.broadcast(chances), "label").filter(unit < F.col("chance"))
              .select("id", "label", F.explode(F.array(*parts)).alias("part")).collect())
    # With few texts wanted of each, the hash can leave out all of a language.
    missed = {r["label"] for r in counts} - {r["label"] for r in sample}
    if missed:
        names = spark.createDataFrame([(m,) for m in sorted(missed)], "label string")
        left = known.join(F.broadcast(names), "label")
        first = left.groupBy("label").agg(F.min(F.struct("id", F.array(*parts).alias("parts"))).alias("first"))
        sample += first.select("first.id", "label", F.explode("first.parts").alias("part")).collect()
    sample.sort(key=lambda r: (r["id"], r["part"], r["label"]))
    texts = [r["part"].encode() for r in sample]
    return train(texts, [r["label"] for r in sample]) if texts else None


def _predictor(net: Network | None):
    most = max(64, min(4096, (1 << 20) // len(net.languages))) if net else 0

    def flush(waiting, count):
        rows = np.concatenate([w for w, _ in waiting])
        weights = np.concatenate([s for _, s in waiting])
        p = probabilities(net, rows) * weights[:, None]
        starts = np.cumsum([0, *[len(w) for w, _ in waiting[:-1]]])
        p = np.add.reduceat(p, starts)
        p /= p.sum(1, keepdims=True)
        return p

    def predict(batches):
        for batch in batches:
            best = np.zeros(len(batch))
            names = np.full(len(batch), UNKNOWN, object)
            waiting, index, size = [], [], 0

            def settle():
                p = flush(waiting, size)
                best[index] = np.clip(p.max(1), 0, 1)
                names[index] = np.array(net.languages, object)[p.argmax(1)]

            if net is not None:
                texts, letters = batch["text"], batch["letters"].to_pylist()
                for i, letter in enumerate(letters):
                    if letter:
                        data = texts[i].as_buffer().to_pybytes()
                        rows = windows(data)
                        filled = np.full(len(rows), WINDOW, np.float32)
                        filled[-1] = max(1, len(data) - (len(rows) - 1) * (WINDOW - REACH + 1))
                        waiting.append((rows, filled))
                        index.append(i)
                        size += len(rows)
                        if size >= most:
                            settle()
                            waiting, index, size = [], [], 0
                if waiting:
                    settle()
            kept = [c for n, c in zip(batch.schema.names, batch.columns) if n not in ("text", "letters")]
            names_kept = [n for n in batch.schema.names if n not in ("text", "letters")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names.tolist(), pa.string()), pa.array(best, pa.float64())],
                [*names_kept, "lang_pred", "score"])
    return predict


def predicted(rows: DataFrame, net: Network | None, text: str = "text", keep: str = "row") -> DataFrame:
    """``keep`` (a column), lang_pred and score (the mean probability over the text's windows).

    A text that is null or has no letter is ``und`` with score 0, as is every text where there was
    nothing to learn from. Bytes weigh alike, however long the text is. Of equal scores the first label by
    code point is named. Repeated rows are predicted each for itself. ``keep`` may be a struct of all columns of a table, so
    that none of their names clashes. An empty table gives no rows.
    """
    source = rows.select(F.col(keep), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
                         has_letter(F.col(text)).alias("letters"))
    kind = source.schema[keep].dataType.simpleString()
    return source.mapInArrow(_predictor(net), f"`{keep}` {kind}, lang_pred string, score double")


def accepted(docs: DataFrame, net: Network | None, min_score: float = 0.4, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language the network names with at least this score."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    named = predicted(rows, net, keep="row")
    return named.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
