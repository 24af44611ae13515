"""Piece tables and the fill-in-middle operator."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quorate.llm import fill_in_middle as fim

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def plainly(doc_id, text, seed=1):
    """The same by lists of units and joined strings."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows():
    rng = random.Random(8)
    made = ["".join(rng.choice("aZé 1\n<P>SM\U0001f642ﬁ\x00") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    odd = [(None, "no id"), (None, None), (1, None), (2, ""), (3, "<"), (3, "<"), (4, "x" * 300_000), (5, "é" * 200_000), (6, "a<P>b"), (7, "<P"), (8, "a b " * 50_000)]
    return [*odd, *((100 + i, t) for i, t in enumerate(made))]


def test_equals_the_plain_way(spark):
    # Columns whose names the operator uses inside are left alone.
    docs = spark.createDataFrame([(i, t, "h", 3) for i, t in rows()], "doc_id BIGINT, text STRING, hash STRING, n INT").repartition(3)
    got = fim.fill_in_middle(docs).collect()
    want = sorted(map(repr, (plainly(i, t) for i, t in rows())))
    assert sorted(repr((r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got) == want
    assert all(r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() for r in got)
    assert sorted(r.restored_sha256 for r in got) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows())
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert "output" not in fim.fill_in_middle(docs, with_output=False).columns


def test_empty_table_and_text_ids(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, "x")], "k STRING, body STRING")
    got = fim.fill_in_middle(docs, "k", "body")
    assert got.schema["doc_id"].dataType.simpleString() == "string" and got.count() == 2
    assert fim.fill_in_middle(docs.limit(0), "k", "body").count() == 0


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=30), st.integers(0, 30), st.integers(0, 30), st.sampled_from(["psm", "spm"]))
def test_tables_are_cut_and_restored(text, a, b, form):
    text = text.replace(b"<", b"")
    first, second = sorted((min(a, len(text)), min(b, len(text))))
    parts = fim.cut(fim.whole(text), first, second)
    assert [b"".join(fim.stream(parts[n])) for n in "PMS"] == [text[:first], text[first:second], text[second:]]
    table = fim.arrange(parts, form)
    output = b"".join(fim.stream(table))
    assert fim.digest(table) == hashlib.sha256(output).hexdigest()
    assert b"".join(fim.stream(fim.restore(output, form))) == text


@pytest.mark.parametrize("at, left, right", [(0, b"", b"abcdef"), (2, b"ab", b"cdef"), (3, b"abc", b"def"), (6, b"abcdef", b""), (9, b"abcdef", b"")])
def test_split_inside_and_between_descriptors(at, left, right):
    table = [(b"xabc", 1, 4), (b"def", 0, 3)]
    assert [b"".join(fim.stream(t)) for t in fim.split(table, at)] == [left, right]
