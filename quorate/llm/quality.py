"""Quality classifier: random-indexing word vectors, pooled, and a small net.

1. *Random indexing over the whole corpus.* A token has a sparse random index
   vector (a few entries of +1 or -1, given by its hash); its context vector
   is the sum of the index vectors of its neighbours everywhere in the corpus.
   Tokens share ``BUCKETS`` rows by hash, so that the table has a fixed size;
   every task adds up its own table and the tables are summed by Spark.
2. *Pooling.* A document is the mean and the spread of its tokens' context
   vectors, the mean and the spread of how alike neighbours are (the cosine of
   their vectors; 1 where a token is repeated), and its length.
3. *Two layers in numpy*, fitted on a bounded sample of labelled documents
   (``bound``), with a temperature and an offset from a part of it that was
   kept back.

A token is a run of letters, of digits, or of other characters; case counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import bounded_labels, id_type, map_rows, normal, one_text, portions

BUCKETS, DIM, WINDOW, NONZERO = 8192, 64, 2, 2
BLOCKS = 64  # parts in which the table of vectors is summed
PIECE = 50_000  # tokens handled at a time, which bounds memory for long texts
FEATURES = 2 * DIM + 4

_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")


class _Buckets(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        number = self[token] = xxhash.xxh3_64_intdigest(token) % BUCKETS
        return number


def token_buckets(text: str, bucket_of: _Buckets) -> np.ndarray:
    tokens = _TOKEN.findall(text.encode())
    return np.fromiter(map(bucket_of.__getitem__, tokens), "i4", len(tokens))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every bucket's index vector."""
    random = np.random.default_rng(20)
    places = np.stack([random.choice(DIM, NONZERO, replace=False) for _ in range(BUCKETS)])
    return places.astype("i4"), random.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def word_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Context vectors of all buckets, scaled to length one, from every text.
    What reaches the driver is one table of BUCKETS rows, whatever the input."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros(BUCKETS * DIM)
        held, size, bucket_of = [], 0, _Buckets()
        for batch in portions(batches):
            for text in batch.column("text").to_pylist():
                ids = token_buckets(text, bucket_of)
                for at in range(0, len(ids), PIECE):
                    piece = ids[at : at + PIECE]
                    if at:
                        _add_across(sums, ids, at, places, signs)
                    held.append(piece)
                    size += len(piece)
                    if size >= 4 * PIECE:
                        _add_documents(sums, held, places, signs)
                        held, size = [], 0
        if held:
            _add_documents(sums, held, places, signs)
        blocks = sums.reshape(BLOCKS, -1)
        used = np.flatnonzero(np.abs(blocks).sum(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([blocks[b] for b in used], pa.list_(pa.float64()))], names=["block", "sums"]
        )

    parts = map_rows(normal(docs, id_col, text_col).select("text"), work, "block INT, sums ARRAY<DOUBLE>")
    added = parts.groupBy("block").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    table = np.zeros((BLOCKS, BUCKETS * DIM // BLOCKS))
    for row in added.toLocalIterator():  # BLOCKS rows at most
        table[row["block"]] = row["sums"]
    table = table.reshape(BUCKETS, DIM)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(norm == 0, 1, norm)).astype("f4")


def _add_documents(sums, held, places, signs) -> None:
    """Contexts inside each of many pieces."""
    for step in range(1, WINDOW + 1):
        left = np.concatenate([p[:-step] for p in held])
        right = np.concatenate([p[step:] for p in held])
        for here, there in ((left, right), (right, left)):
            flat = here.astype("i8") * DIM
            for k in range(NONZERO):
                sums += np.bincount(flat + places[there, k], signs[there, k], BUCKETS * DIM)


def _add_across(sums, ids, at, places, signs) -> None:
    """Pairs of which one token lies before ``at`` and one behind it."""
    for step in range(1, WINDOW + 1):
        left, right = ids[at - step : at][: len(ids) - at], ids[at : at + step][: len(ids) - at]
        for here, there in ((left, right), (right, left)):
            for k in range(NONZERO):
                np.add.at(sums, here.astype("i8") * DIM + places[there, k], signs[there, k])


def pooled(texts: list[str], vectors: np.ndarray, bucket_of: _Buckets) -> np.ndarray:
    """Features of each text; an empty one has zeros."""
    out = np.zeros((len(texts), FEATURES), "f4")
    for row, text in zip(out, texts):
        ids = token_buckets(text, bucket_of)
        if not len(ids):
            continue
        total, squares, near = np.zeros(DIM), np.zeros(DIM), np.zeros(2)
        for at in range(0, len(ids), PIECE):
            part = vectors[ids[at : at + PIECE + 1]]  # and the first of the next piece
            alike = np.einsum("ij,ij->i", part[:-1], part[1:])
            near += alike.sum(), alike @ alike
            part = part[:PIECE]
            total += part.sum(0)
            squares += np.einsum("ij,ij->j", part, part)
        mean = total / len(ids)
        row[:DIM] = mean
        row[DIM : 2 * DIM] = np.sqrt(np.maximum(squares / len(ids) - mean**2, 0))
        near /= max(1, len(ids) - 1)
        spread = np.sqrt(max(0.0, near[1] - near[0] ** 2))
        row[2 * DIM :] = near[0], spread, np.log1p(len(ids)), len(text.encode()) / len(ids) / 10
    return out


@dataclass
class Net:
    """tanh layer and logistic layer over standardised features; logits are
    divided by the temperature and moved by the offset."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    offset: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature + self.offset, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, seed: int = 7) -> Net:
    """Adam on log loss; then temperature and offset from a fifth of the rows
    that was kept back. One class, or no rows: a constant."""
    x, y = x.astype("f8"), y.astype("f8")
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        zero = np.zeros(x.shape[1])
        return Net(zero, zero + 1, np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros(1), float(np.log(rate / (1 - rate))))
    random = np.random.default_rng(seed)
    order = random.permutation(len(y))
    back = len(y) // 5 if len(y) >= 20 else 0
    late, early = order[:back], order[back:]
    mean, scale = x[early].mean(0), x[early].std(0) + 1e-6
    net = Net(mean, scale, random.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), np.zeros(hidden), 0.0)
    z = (x - mean) / scale
    values = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, t = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        shuffled = random.permutation(early)
        for at in range(0, len(shuffled), 256):
            rows = shuffled[at : at + 256]
            h = np.tanh(z[rows] @ values[0] + values[1])
            p = 1 / (1 + np.exp(-np.clip(h @ values[2] + values[3], -30, 30)))
            d = (p - y[rows]) / len(rows)
            dh = np.outer(d, values[2]) * (1 - h * h)
            slopes = [z[rows].T @ dh + 1e-4 * values[0], dh.sum(0), h.T @ d + 1e-4 * values[2], np.array([d.sum()])]
            t += 1
            for v, g, m, s in zip(values, slopes, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    if back:
        net.temperature, net.offset = calibrate(net.logits(x[late]), y[late])
    return net


def calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Temperature and offset that minimise the log loss. Both classes weigh
    alike in the offset, so that a rare class is not called less likely than
    its texts show."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    best = (np.inf, 1.0, 0.0)
    for temperature in np.exp(np.linspace(np.log(0.25), np.log(8), 30)):
        for offset in np.linspace(-4, 4, 41):
            z = logits / temperature + offset
            loss = float(weight @ (np.logaddexp(0, z) - y * z)) + 1e-4 * offset**2
            best = min(best, (loss, float(temperature), float(offset)))
    return best[1], best[2]


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, bound: int = 20_000, column: str = "quality") -> Net:
    """Fit on at most ``bound`` labelled documents that are not held out."""
    chosen = F.broadcast(bounded_labels(labels, column, bound))
    # One row of each id, so that what reaches the driver is bounded.
    rows = one_text(normal(docs).join(chosen, "doc_id"), "label")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = _Buckets()
        for batch in portions(batches):
            features = pooled(batch.column("text").to_pylist(), vectors, bucket_of)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(list(features), pa.list_(pa.float32()))], names=["label", "features"]
            )

    sample = map_rows(rows, work, "label INT, features ARRAY<FLOAT>").toArrow()
    x = np.array(sample.column("features").to_pylist(), "f4").reshape(-1, FEATURES)
    y = np.array(sample.column("label").to_pylist(), "f8")
    order = np.lexsort([*x.T[::-1], y])  # the same model whatever order the rows came in
    return fit(x[order], y[order])


def score_quality(docs: DataFrame, labels: DataFrame, bound: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs``.

    Only texts are scored: no other column is looked at. A null text is empty;
    an empty text gets the score of zero features. Null ids and repeated rows
    are scored as they come; labels with a null, of unknown documents or of
    held-out ones are not used; without usable labels the score is a constant.
    An empty table gives no rows.
    """
    vectors = word_vectors(docs)
    net = train(docs, labels, vectors, bound)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = _Buckets()
        for batch in portions(batches):
            scores = net.probabilities(pooled(batch.column("text").to_pylist(), vectors, bucket_of))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = normal(docs)
    scored = map_rows(rows, work, f"doc_id {id_type(rows)}, score DOUBLE")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, bound: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, all columns
    as they were, whatever their names. Every row is judged in place, so null
    ids and repeated rows need no key. A null text is empty; an empty text has
    the score of zero features; an empty table gives an empty one."""
    vectors = word_vectors(docs)
    net = train(docs, labels, vectors, bound)
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = _Buckets()
        for batch in portions(batches):
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(net.probabilities(pooled(texts, vectors, bucket_of)) >= threshold))

    return map_rows(docs, work, schema)
