"""Toxicity: non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other text, labelled clean or
not, is unlabelled. With the class prior pi the risk of a classifier is

    pi * E_pos[loss(+)] + max(0, E_unl[loss(-)] - pi * E_pos[loss(-)])

and when the second term falls below zero, the step is taken the other way, so
that the classifier can't explain positives away as noise. Three linear
classifiers over words and word prefixes are fitted in numpy, each on its own
resampling of a bounded sample, and their probabilities averaged. A prefix
counts by how many words of the text have it, so that a stem with many endings
is found although each of its words is rare.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import bounded_labels, held_out, id_type, map_rows, normal, one_text, portions

SEEDS = (11, 23, 47)
LEAST = 3.0  # standard deviations (1 at least) by which the confirmed texts with a feature exceed what is usual
DECAY = 1e-3  # of the weights
LIFT = 2.5  # and by how much its share of the confirmed texts must exceed its share of all texts
PREFIXES = (4, 5, 6, 7, 8)  # bytes
LEVELS = 8  # a prefix has one feature for each of 1, 2, 4 .. 128 words with it
_WORD = re.compile(rb"[a-z\x80-\xff]+|[0-9]+|[^\sa-z0-9\x80-\xff]+")


def _hash(piece: bytes) -> int:
    return xxhash.xxh3_64_intdigest(piece) >> 1


class Pieces(dict):
    """Hashes of a word and its prefixes, all or those in ``wanted``; the low
    bits are free for the level."""

    def __init__(self, wanted: frozenset[int] | None = None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        parts = [word + b" "]
        if word[0] >= 97:  # a letter or a byte of one
            parts += [word[:n] for n in PREFIXES if n <= len(word)]
        hashes = [_hash(p) & ~(LEVELS - 1) for p in parts]
        if self.wanted is not None:
            hashes = [h for h in hashes if h in self.wanted]
        found = self[word] = tuple(hashes)
        return found


def features_of(text: str, pieces: Pieces) -> np.ndarray:
    """Sorted hashes of the distinct words and of the prefixes with levels."""
    words = set(_WORD.findall(text.encode().lower()))
    hashes = np.fromiter(chain.from_iterable(map(pieces.__getitem__, words)), "i8")
    found, times = np.unique(hashes, return_counts=True)
    return np.sort(np.concatenate([found[times >= 1 << level] + level for level in range(LEVELS)]))


def choose_features(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Sorted hashes of the features that classifiers look at: those in more
    confirmed texts than chance explains, three at least, whatever their share
    of them. No feature can be more than 1 / prior times as frequent in
    positives as in all text, so a large prior asks for less lift."""
    found, seen = np.unique(np.concatenate([np.zeros(0, "i8"), *positive]), return_counts=True)
    if not len(found):
        return found
    other = np.concatenate([np.zeros(0, "i8"), *unlabelled])
    usual = np.bincount(columns(other, found), minlength=len(found) + 1)[:-1]
    expected = usual * (len(positive) / max(1, len(unlabelled)))
    lift = min(LIFT, 0.5 + 0.5 / prior)
    return found[(seen - expected >= LEAST * np.sqrt(np.maximum(expected, 1))) & (seen >= lift * expected)]


def columns(hashes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Place of each hash among the chosen ones; their number for others."""
    if not len(chosen):
        return np.zeros(len(hashes), "i8")
    at = np.searchsorted(chosen, hashes)
    at[at == len(chosen)] = 0
    return np.where(chosen[at] == hashes, at, len(chosen))


class Linear:
    """Logistic classifier over presence of features. The score is a sum over
    them, not a mean: a few telling words count alike in a long text."""

    def __init__(self, chosen: np.ndarray):
        self.chosen, self.weights, self.bias = chosen, np.zeros(len(chosen) + 1), 0.0

    def logits(self, hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """``firsts`` are the places of each document's first feature and the end."""
        picked = np.concatenate([[0.0], np.cumsum(self.weights[columns(hashes, self.chosen)])])
        return picked[firsts[1:]] - picked[firsts[:-1]] + self.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Sparse 0/1 rows of the places of their ones, and a last column of ones."""

    def __init__(self, ones: list[np.ndarray], width: int):
        self.n, self.width = len(ones), width
        self.row = np.repeat(np.arange(self.n), [len(o) for o in ones])
        self.column = np.concatenate([np.zeros(0, "i8"), *ones])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.n) + w[-1]

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.column, v[self.row], self.width), v.sum())


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int, steps: int = 800) -> Linear:
    """Minimise the non-negative risk with logistic loss by Adam, on resampled
    rows. Without positives or unlabelled texts the model is the prior."""
    prior = min(max(prior, 1e-3), 0.999)
    model = Linear(choose_features(positive, unlabelled, prior))
    model.bias = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return model
    random = np.random.default_rng(seed)

    def design(rows: list[np.ndarray]) -> Rows:
        places = [columns(row, model.chosen) for row in rows]
        kept = [p[p < len(model.chosen)] for p in places]
        return Rows([kept[i] for i in random.integers(0, len(rows), len(rows))], len(model.chosen))

    x_pos, x_unl = design(positive), design(unlabelled)
    w = np.zeros(len(model.chosen) + 1)
    w[-1] = model.bias
    m, s = np.zeros_like(w), np.zeros_like(w)
    for step in range(steps):
        rate = 0.05 * (1 - step / steps) + 0.002
        zp, zu = x_pos.times(w), x_unl.times(w)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # Slopes of the mean losses with regard to the scores.
        down_u, down_p = _sigmoid(zu) / len(zu), _sigmoid(zp) / len(zp)
        if negative >= 0:
            slope = x_pos.back(-prior * _sigmoid(-zp) / len(zp) - prior * down_p) + x_unl.back(down_u)
        else:
            slope = x_pos.back(prior * down_p) - x_unl.back(down_u)
        slope[:-1] += DECAY * w[:-1]
        m += 0.1 * (slope - m)
        s += 0.01 * (slope * slope - s)
        w -= rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(s / (1 - 0.99 ** (step + 1))) + 1e-6)
    model.weights[:-1], model.bias = w[:-1], float(w[-1])
    return model


def _sample_features(rows: DataFrame) -> list[np.ndarray]:
    """Feature hashes of a bounded set of documents, ordered by content."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces()
        for batch in portions(batches):
            hashes = [features_of(t, pieces) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.list_(pa.int64()))], names=["features"])

    found = map_rows(rows.select("text"), work, "features ARRAY<BIGINT>").toArrow().column("features").combine_chunks()
    arrays = [np.asarray(a.values) for a in found]
    return sorted(arrays, key=lambda a: a.tobytes())


def train(docs: DataFrame, labels: DataFrame, bound: int = 4_000, column: str = "toxic") -> list[Linear]:
    """Fit on at most ``bound`` confirmed positives and ``bound`` unlabelled
    documents, both chosen by a hash of the id among those not held out. The
    class prior is the share of positives among all usable labels."""
    toxic = labels.where(F.col(column) == 1)
    known = labels.where(F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
    prior = known.agg(F.avg(F.col(column).cast("double"))).first()[0] or 0.01
    texts = normal(docs)
    positive = texts.join(F.broadcast(bounded_labels(toxic, column, bound)), "doc_id")
    free = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    drawn = free.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(bound)
    unlabelled = texts.join(F.broadcast(drawn), "doc_id")
    # One row of each id, so that what reaches the driver is bounded.
    p, u = _sample_features(one_text(positive)), _sample_features(one_text(unlabelled))
    return [fit_nnpu(p, u, prior, seed) for seed in SEEDS]


def score_toxicity(docs: DataFrame, labels: DataFrame, bound: int = 4_000, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs``.

    Only texts are scored: no other column is looked at. A null text is empty
    and has no words; null ids and repeated rows are scored as they come.
    Without positives the score is the class prior, or 0.01 without labels.
    An empty table gives no rows.
    """
    models = train(docs, labels, bound)
    wanted = frozenset((np.concatenate([m.chosen for m in models]) // LEVELS * LEVELS).tolist())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(wanted)
        for batch in portions(batches):
            found = [features_of(t, pieces) for t in batch.column("text").to_pylist()]
            firsts = np.concatenate([[0], np.cumsum([len(d) for d in found])]).astype("i8")
            hashes = np.concatenate([np.zeros(0, "i8"), *found])
            scores = np.mean([_sigmoid(model.logits(hashes, firsts)) for model in models], axis=0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = normal(docs)
    scored = map_rows(rows, work, f"doc_id {id_type(rows)}, score DOUBLE")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
