"""Conversation repair against plain searches."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from quorate.llm import repair

BARE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        space = [" " if v is None else v for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{space[0]}:{space[1]}".encode()) % 20
        role, text = space[2], space[3]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = BARE.findall(text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired rows) by a table of whole strings."""
    best = {"": (0, "", ())}

    def better(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def after(state, initial):
        good = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        return good.get((state, initial))

    def insert(table):
        for _ in range(4):
            for state, (cost, audit, made) in list(table.items()):
                for role in ("user", "assistant"):
                    if to := after(state, role[0]):
                        better(table, to, (cost + 5, audit + "I", (*made, (role, ""))))
        return table

    for (role, text), fault in zip(rows, faults):
        table = {}
        for state, (cost, audit, made) in insert(best).items():
            better(table, state, (cost + 2, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            if to := after(state, role[:1]):
                better(table, to, (cost + extra, audit + "K", (*made, (role, text))))
            for new in ("user", "assistant"):
                if to := after(state, new[0]):
                    better(table, to, (cost + extra + 1, audit + "R", (*made, (new, text))))
        best = table
    return min(entry for state, entry in insert(best).items() if state in ("", "a"))


def plainly(rows):
    """Expected report of each conversation, from (conv, turn, role, text)."""
    talks = {}
    for conv, *_ in rows:
        talks.setdefault(conv, [])
    for conv, turn, role, text in damaged(rows):
        talks[conv].append((turn, role, text))
    out = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        pairs = [(role, text) for _, role, text in talk]
        faults = faults_of(pairs)
        cost, audit, made = cheapest(pairs, faults)
        turns = [t for t, _, _ in talk if t is not None]
        steps = [a[0][:1] + b[0][:1] for a, b in zip(pairs, pairs[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(s not in ("su", "ua", "au") for s in steps), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        )
    return out


def made(rng, convs=150, hot=0):
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randint(1, 9) if conv else hot or 3):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "assist", "ursa"])
            text = rng.choice(["Yes.", "no", "Well!", " ", "", "A\n?", "ü.", None, f"{turn}.", f"{turn}. ", f"é {turn}"])
            rows.append((conv, rng.choice([turn, turn, turn * 2, None if rng.random() < 0.2 else turn]), role, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, 1) for r in rows], "conv_id BIGINT, turn BIGINT, role STRING, text STRING, mark STRING, part INT, pos INT")


def reported(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_equals_a_plain_search(spark):
    rows = made(random.Random(2))
    got = repair.repair_conversations(repair.damage(table(spark, rows)), times_col="times")
    assert reported(got) == plainly(rows)


def test_open_conversations(spark, monkeypatch):
    """Cut by borders and into segments, a hot one among them (id 0)."""
    rows = made(random.Random(5), convs=40, hot=900)
    monkeypatch.setattr(repair, "HELD", 40)
    monkeypatch.setattr(repair, "SEGMENT", 16)
    damage = repair.damage(table(spark, rows)).repartition(5)
    got = reported(repair.repair_conversations(damage, times_col="times"))
    want = plainly(rows)
    assert got == want
    # The repaired rows are those of the digest.
    texts = {conv: [] for conv in want}
    order = repair.repaired_rows(damage, times_col="times").collect()
    for r in sorted(order, key=lambda r: (r.part, r.pos, r.edit != "I")):
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == {c: v[-1] for c, v in want.items()}


def test_conversation_of_one_turn_and_text(spark, monkeypatch):
    monkeypatch.setattr(repair, "HELD", 10)
    rows = [(1, None, "user", "Same.")] * 300 + [(2, 1, "user", "Hi."), (2, 2, "assistant", "Ho.")]
    got = reported(repair.repair_conversations(table(spark, rows)))
    assert got[1][:6] == (0, 0, 299, 0, 299, 2 * 300) and got[1][6] == "D" * 300
    assert got[2][5:7] == (0, "KK")


def test_all_ways_of_short_talks():
    """Every sequence of edits, tried one by one."""
    def ways(n):
        for gaps in itertools.product(("", "I", "II"), repeat=n + 1):
            for ops in itertools.product("DKR", repeat=n):
                yield gaps[0] + "".join(o + g for o, g in zip(ops, gaps[1:]))

    cost = {"D": 2, "K": 0, "R": 1, "I": 5}
    symbols = [i + s for i in "sua-" for s in ".tx"]
    for n in (0, 1, 2, 3):
        for talk in itertools.product(symbols, repeat=n) if n < 3 else random.Random(1).sample(list(itertools.product(symbols, repeat=3)), 60):
            parser = repair.Parser({})
            for symbol in talk:
                parser.read(symbol)
            last_cost, last, closing = repair.end(parser.frontier)
            best = None
            for audit in ways(n):
                at, options, total = 0, {""}, 0
                for edit in audit:
                    total += cost[edit]
                    if edit == "I":
                        options = {o + r for o in options for r in "ua"}
                        continue
                    initial, state = talk[at]
                    at += 1
                    if edit == "D":
                        continue
                    total += 5 * (state == "t")
                    options = set() if state == "x" else {o + r for o in options for r in (initial if edit == "K" else "ua")}
                if any(re.fullmatch("(s?(ua)+)?", o) for o in options):
                    best = min(best or (total, audit), (total, audit))
            assert (parser.cost + last_cost, "".join(parser.edits(last)) + closing) == best


def test_odd_tables(spark):
    nothing = table(spark, [(1, 1, "user", "x")]).limit(0)
    assert repair.repair_conversations(nothing).count() == 0 and repair.repaired_rows(nothing).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = reported(repair.repair_conversations(repair.damage(table(spark, [(gone, 0, "user", "x.")])), times_col="times"))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    ids = spark.createDataFrame([("a", 1, "user", "A."), ("a", 2, "assistant", "B.")], "conv_id STRING, turn INT, role STRING, text STRING")
    assert repair.repair_conversations(ids).first()["conv_id"] == "a"


def test_long_texts(spark, monkeypatch):
    rows = [(1, i, ("user", "assistant")[i % 2], "long " * 20_000 + f"{i}.") for i in range(6)]
    want = plainly(rows)
    assert reported(repair.repair_conversations(repair.damage(table(spark, rows)), times_col="times")) == want
    monkeypatch.setattr(repair, "HELD_BYTES", 150_000)
    assert reported(repair.repair_conversations(repair.damage(table(spark, rows)), times_col="times")) == want
