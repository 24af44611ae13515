"""Personal data: generators, boosted trees, calibrated thresholds.

Generators of high recall propose spans that may overlap: the four base kinds,
and looser shapes (addresses written out, groups of digits, dotted numbers).
Boosted trees in numpy judge a span by its format and by the words before it;
they learn from accepted base spans of all documents, rewritten in their place
to the looser shapes, against made-up versions, prices, dates and numbers in
the same place and spans that the base rules reject. Loose candidates of the
texts themselves have no label and are not taught as wrong. Each label is
bounded by a hash of the span; a part that was kept back gives each generator
the threshold at which ``PRECISION`` of what is selected is right. Base spans
stay in any case; the trees add spans that overlap none of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Stage, id_type, map_rows, normal, portions

BASE = ("email", "ip", "card", "phone")
LOOSE = ("address", "digits", "dotted")
NAMES = (*BASE, *LOOSE)  # by the number of the generator
PRECISION = 0.95

# The base patterns, written so that no start is tried twice in
# a run; the matches are the same.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_ADDRESS = re.compile(r"[\w.+-]{1,64}+(?:@| ?[(\[]at[)\]] ?| at )[\w-]{1,63}+(?:(?:\.| ?[(\[]dot[)\]] ?| dot )[\w-]{1,63}+){1,8}")
_DIGITS = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().-]{0,3}[0-9]){6,}+")
_DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,}+")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: for each @, the local part reaches back over its
    characters, at most to the end of the match before."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
        done = domain.end() if domain else at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, accepted) of all matches of the base patterns."""
    out = [(a, 0, b, True) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        out.append((m.start(), 1, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        out.append((m.start(), 2, m.end(), len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for m in _PHONE.finditer(text):
            out.append((m.start(), 3, m.end(), 9 <= sum(c.isdigit() for c in m[0]) <= 15))
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, generator, end) of all generators; spans may overlap."""
    out = [(a, k, b) for a, k, b, _ in base_spans(text)]
    if "@" in text or " at " in text or "at)" in text or "at]" in text:
        out += [(m.start(), 4, m.end()) for m in _ADDRESS.finditer(text)]
    out += [(m.start(), 5, m.end()) for m in _DIGITS.finditer(text)]
    return out + [(m.start(), 6, m.end()) for m in _DOTTED.finditer(text)]


CUES = ("mail", "contact", "tel", "phone", "call", "card", "visa", "pay", "ip", "host", "server", "version", "order", "id")


def features(text: str, start: int, generator: int, end: int) -> list[float]:
    """Format of the span (its generator is left out) and its context."""
    span = text[start:end]
    digits = [c for c in span if "0" <= c <= "9"]
    groups = [g for g in re.split(r"[^0-9]+", span) if g][:32]
    before, after = text[max(0, start - 24) : start].lower(), text[end : end + 1]
    cue = next((i for i, w in enumerate(CUES) if w in before), len(CUES))
    return [
        len(span), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        max((int(g[:9]) for g in groups), default=0), span.count("."), span.count(" "), span.count("-"), span.count("@"),
        sum(c.isalpha() for c in span), float(span[:1] == "+"), float("(" in span),
        float(12 <= len(digits) <= 19 and luhn("".join(digits))), cue, float(before[-1:].isalnum()), float(after.isalnum()),
        float("." in span[span.find("@") + 1 :]) if "@" in span else -1.0,
        float(" dot " in span or "dot)" in span or "dot]" in span), float("at)" in span or "at]" in span), span.count(":"), span.count(","),
    ]


@dataclass
class Trees:
    """Boosted trees on log loss; a tree is (feature, limit, left, right)."""

    start: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += _walk(tree, x)
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _walk(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    column, limit, left, right = tree
    down = x[:, column] <= limit
    out = np.empty(len(x))
    out[down], out[~down] = _walk(left, x[down]), _walk(right, x[~down])
    return out


def _grow(x: np.ndarray, slope: np.ndarray, bend: np.ndarray, depth: int, rate: float):
    """Best split by the gain of a second-order step, over quantiles."""
    leaf = lambda g, h: -rate * g / (h + 1.0)
    total_g, total_h = slope.sum(), bend.sum()
    best = (1e-6, None, None)
    if depth and len(x) >= 10:
        for column in range(x.shape[1]):
            for limit in np.unique(np.quantile(x[:, column], np.linspace(0.05, 0.95, 12), method="lower")):
                down = x[:, column] <= limit
                if down.all() or not down.any():
                    continue
                g, h = slope[down].sum(), bend[down].sum()
                gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                if gain > best[0]:
                    best = (gain, column, limit)
    if best[1] is None:
        return float(leaf(total_g, total_h))
    down = x[:, best[1]] <= best[2]
    return (
        best[1], float(best[2]),
        _grow(x[down], slope[down], bend[down], depth - 1, rate), _grow(x[~down], slope[~down], bend[~down], depth - 1, rate),
    )


def fit(x: np.ndarray, y: np.ndarray, generators: np.ndarray, rounds: int = 30, depth: int = 3, rate: float = 0.3) -> Trees:
    """Trees on four fifths of the rows; thresholds by generator on the rest.
    A generator with no right span there selects nothing."""
    model = Trees()
    if len(y) < 20 or y.min() == y.max():
        return model
    late = np.arange(len(y)) % 5 == 0
    xe, ye = x[~late], y[~late]
    rate_of = np.clip(ye.mean(), 1e-3, 1 - 1e-3)
    model.start = float(np.log(rate_of / (1 - rate_of)))
    raw = np.full(len(ye), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        tree = _grow(xe, p - ye, p * (1 - p), depth, rate)
        model.trees.append(tree)
        raw += _walk(tree, xe)
    scores = model.probabilities(x[late])
    for g in np.unique(generators[late]):
        own, right = scores[generators[late] == g], y[late][generators[late] == g]
        order = np.argsort(-own, kind="stable")
        precision = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(precision >= PRECISION)
        if len(good):
            model.thresholds[int(g)] = float(max(own[order][good[-1]], 0.5))
    return model


def _loose_shape(span: str, kind: int, pick: int) -> str | None:
    """An accepted e-mail address or phone number without its surface cue."""
    if kind == 0:
        at, dot = ((" (at) ", " dot "), (" at ", " dot "), ("[at]", "[dot]"), (" (at) ", "."))[pick % 4]
        local, domain = span.split("@", 1)
        return local + at + domain.replace(".", dot)
    if kind == 3:
        groups = re.findall("[0-9]+", span)
        if len(groups) < 3:
            return span[1:]
        return (span[1:], " ".join(groups), " ".join(groups[1:]), "-".join(groups[1:]), f"({groups[1]}) " + "-".join(groups[2:]))[pick % 5]
    return None


def _no_person(kind: int, pick: int) -> str:
    """A version, date, price or number; for addresses a place."""
    if kind == 0:
        return ("seen at example.com", "look at page.html", f"open at {pick % 12 + 1}.30")[pick % 3]
    n = pick // 8
    return (
        f"{n % 9 + 1}.{n % 23}.{n % 17}.{n % 700 + 300}", f"{n % 9 + 1}.{n % 23}.{n % 1000}",
        f"{1950 + n % 90}-{n % 12 + 1:02}-{n % 28 + 1:02} {n % 24:02}", f"{n % 28 + 1:02}.{n % 12 + 1:02}.{1950 + n % 90}",
        f"{n % 900 + 1}.{n % 1000:03}.{n // 7 % 1000:03}", f"{n % 10**8 + 10**8}", f"{n % 10**11 + 10**11}", f"{1950 + n % 90}-{n % 10**6:06}",
    )[pick % 8]


def labelled(text: str) -> list[tuple[list[float], int, int]]:
    """(features, label, generator) of the candidates that have a label."""
    out = []
    base = base_spans(text)
    for a, kind, b, ok in base:
        before, after = text[max(0, a - 64) : a], text[b : b + 32]
        if not ok:
            if not any(c < b and a < d for c, _, d, good in base if good):
                out += [(features(text, a, g, b), 0, g) for g in (kind, 5)]
            continue
        pick = xxhash.xxh3_64_intdigest(text[max(0, a - 8) : b].encode(errors="replace"))
        for span, right in ((_loose_shape(text[a:b], kind, pick), 1), (_no_person(kind, pick), 0)):
            if span is None:
                continue
            start, end, made = len(before), len(before) + len(span), before + span + after
            for c in candidates(made):
                # What overlaps the span without being it has wrong bounds.
                if c[1] >= len(BASE) and c[0] < end and start < c[2]:
                    out.append((features(made, *c), int(right and (c[0], c[2]) == (start, end)), c[1]))
    return out


def train(docs: DataFrame, most_spans: int = 40_000) -> Trees:
    """Fit on labelled spans of all documents, of each label at most half of
    ``most_spans``, chosen by a hash of the span."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [r for t in batch.column("text").to_pylist() for r in labelled(t)]
            columns = [
                pa.array([f for f, _, _ in found], pa.list_(pa.float64())),
                pa.array([y for _, y, _ in found], pa.int32()), pa.array([g for _, _, g in found], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "generator"])

    spans = Stage(docs.sparkSession, "pii")(map_rows(docs.select("text"), work, "x ARRAY<DOUBLE>, y INT, generator INT"), "spans")
    # Of each label: one that is common does not crowd the other out.
    order = (F.xxhash64("x", "y"), "x", "y", "generator")
    sides = [spans.where(F.col("y") == y).orderBy(*order).limit(most_spans // 2) for y in (0, 1)]
    sample = sides[0].union(sides[1]).orderBy(*order).toArrow()
    if not sample.num_rows:
        return Trees()
    x = np.array(sample.column("x").to_pylist())
    return fit(x, np.array(sample.column("y").to_pylist(), "f8"), np.array(sample.column("generator").to_pylist()))


def spans_of(text: str, model: Trees) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added ones, each (start, kind, end) in order."""
    base = sorted((a, k, b) for a, k, b, ok in base_spans(text) if ok)
    if not model.thresholds:
        return base, []
    found = candidates(text)
    if not found:
        return base, []
    scores = model.probabilities(np.array([features(text, *c) for c in found]))
    chosen = sorted((-s, c) for s, c in zip(scores.tolist(), found) if s >= model.thresholds.get(c[1], 2.0))
    # The best first; what is added overlaps nothing that stands. Taken spans
    # are kept sorted and apart, so that one look to each side is enough.
    added: list[tuple[int, int, int]] = []
    merged: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for a, _, b in base):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    for _, (a, g, b) in chosen:
        at = bisect_left(merged, (b, -1))
        if at and merged[at - 1][1] > a:
            continue
        insort(merged, (a, b))
        added.append((a, g, b))
    return base, sorted(added)


def find_personal_data(docs: DataFrame, most_spans: int = 40_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone,
    base_text and spans (kind:start:end by start, comma-joined).

    Places are code points, the end exclusive. A null or empty text has no
    spans. Null ids and repeated rows stay. Without base spans
    the trees add nothing. An empty table gives no rows. Other columns are not
    looked at.
    """
    rows = normal(docs, id_col, text_col)
    model = train(rows, most_spans)

    def line(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in spans)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [spans_of(t, model) for t in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(4)]
            texts = [pa.array([line(b) for b, _ in found]), pa.array([line(sorted(b + a)) for b, a in found])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, *texts], names=["doc_id", *(f"n_{k}" for k in BASE), "base_text", "spans"]
            )

    fields = ", ".join(f"n_{k} BIGINT" for k in BASE)
    return map_rows(rows, work, f"doc_id {id_type(rows)}, {fields}, base_text STRING, spans STRING")
