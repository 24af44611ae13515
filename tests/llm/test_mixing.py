"""Mixing sources: targets against a plain loop, and what the rounding keeps."""

from __future__ import annotations

import collections
import random
import re

import pytest

from quorate.llm import mixing

SCHEMA = "doc_id BIGINT, text STRING, source STRING, words INT, size STRING, `open` INT"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", 2) for i, t, s in rows], SCHEMA)


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share, cut what is above, share the rest among the others, again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: cap * sizes[s] for s in above})


def made(n=3000, seed=3):
    rng = random.Random(seed)
    sources = ["hot"] * 30 + ["a", "b", "É", "\U0001f642", "z", "", None]
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 10, 40])), rng.choice(sources)) for i in range(n)]
    rows += [(i, "tiny", "tiny source") for i in range(n, n + 3)]
    rows += [(None, "no id", "a"), (None, None, "b"), (n + 9, None, "empty source"), (n + 10, "long " * 3000, "z")]
    return rows + [(77, "the same row", "b")] * 20


def by_source(rows):
    taken, sizes = collections.Counter(), collections.Counter()
    for r in rows:
        taken[r.source] += r.taken
        sizes[r.source] += r.size
    return taken, sizes


def test_targets_and_sums(spark):
    rows = made()
    got = mixing.mix_sources(table(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (i is None, i or 0, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _ in rows
    )
    taken, sizes = by_source(got)
    want = plain_targets(sizes)
    longest = collections.defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size
        rate = r.target / r.source_size if r.source_size else 0
        assert not r.size or rate - 1 < r.copies < rate + 1
        longest[r.source] = max(longest[r.source], r.size)
    assert any(want[s] == pytest.approx(3 * sizes[s]) and sizes[s] for s in sizes)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
    assert abs(taken["hot"] - want["hot"]) < 40


def test_same_rows_give_the_same_mix(spark, monkeypatch):
    docs = table(spark, made(800))

    def run(d, **more):
        return sorted(map(repr, mixing.mix_sources(d, **more).collect()))

    first = run(docs)
    assert first == run(docs.repartition(7)) == run(docs.coalesce(1))
    monkeypatch.setattr(mixing, "FEW", 0)  # the sources' table under salts
    monkeypatch.setattr(mixing, "BLOCK", 3)  # repeated rows in blocks
    assert first == run(docs.repartition(4))
    assert first != run(docs, seed=14)


def test_expected_copies_stay(spark):
    """Over seeds, a document is taken as often as its source's rate says,
    whatever its length."""
    rows = [(i, "w " * (1 if i % 2 else 5), "a" if i < 60 else "b") for i in range(120)]
    docs, times, rate = table(spark, rows), collections.Counter(), {}
    for seed in range(6):
        for r in mixing.mix_sources(docs, weights=(3, 1), seed=seed).collect():
            times[r.source, r.size] += r.copies / 6 / 30
            rate[r.source] = r.target / r.source_size
    assert rate == {"a": pytest.approx(1.5), "b": pytest.approx(0.5)}
    assert all(abs(n - rate[s]) < 0.2 for (s, _), n in times.items())


def test_odd_tables(spark):
    assert mixing.mix_sources(table(spark, made(5)).limit(0)).count() == 0
    nothing = mixing.mix_sources(table(spark, [(1, None, None), (2, " ", None)])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in nothing] == [(0, 0, 0.0, 0)] * 2
    single = mixing.mix_sources(table(spark, [(1, "one two", None)])).collect()[0]
    assert (single.target, single.taken) == (2.0, 2)
    text_ids = mixing.mix_sources(spark.createDataFrame([("k", "a b", "s")], "doc_id STRING, text STRING, source STRING"))
    assert text_ids.first()["doc_id"] == "k"
    with pytest.raises(ValueError):
        mixing.mix_sources(table(spark, []), weights=())
