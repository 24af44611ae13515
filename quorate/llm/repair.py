"""Conversation repair by a generalised LR parser with edits.

The rows of a conversation are read by an LR parser of the role grammar that
follows all stacks at once: a graph-structured stack, in which stacks share
what lies below their tops. Before each row any number of rows may be inserted
(shift without reading); then the row is kept or given another role (shift) or
deleted (read without shift). Stacks that come out equal are merged, and the
least (cost, audit) stays. Audits are never compared as strings: after a row
is read all of them end with that row's edit, so none begins another, and the
order of two is that of the stacks they came from, or of the last few edits.

What one row does to a set of stacks depends only on their costs and order and
on the row's symbol, and there are few of these, so each such step is worked
out once per task.

Conversations are dealt in ranges over the partitions and read in order. One
that lies inside a partition is repaired at once. One that is cut by a border,
or is larger than ``HELD``, goes on as *open*: its rows are cut into segments
of ``SEGMENT`` rows, each segment tells for every stack it may begin with what
it costs to end with every other one, those tables are joined along the
conversation, and each segment is then repaired from the stack it turned out
to begin with. Only the digest of the repaired text needs the rows of a
conversation in one stream; it is never held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.llm.common import Stage, map_rows, portions

# Costs of edits, and the roles by initial.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
ROLES = {"s": "system", "u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"

SEGMENT = 4096  # rows of an open conversation that one task repairs
HELD = 4096  # rows of a conversation up to which it is repaired at once
HELD_BYTES = 8_000_000  # and bytes

# The LR automaton of   talk -> (nothing) | turns | s turns
#                       turns -> u a | turns u a
SHIFT = {0: {"s": 2, "u": 4}, 2: {"u": 4}, 3: {"u": 6}, 4: {"a": 7}, 5: {"u": 6}, 6: {"a": 8}}
REDUCE = {7: 2, 8: 3}  # length of the right side of "turns"
GOTO = {0: 3, 2: 5}  # behind "turns"
ACCEPT = (0, 3, 5)  # tops at which the talk may end

Stack = tuple  # (state, the stack below or None)
START: Stack = (0, None)


def shift(stack: Stack, role: str) -> Stack | None:
    """The stack behind one more row of this role, reduced as far as it goes."""
    state = SHIFT.get(stack[0], {}).get(role)
    if state is None:
        return None
    stack = (state, stack)
    if state in REDUCE:
        for _ in range(REDUCE[state]):
            stack = stack[1]
        stack = (GOTO[stack[0]], stack)
    return stack


def _all_stacks() -> list[Stack]:
    """Every stack of the grammar, in the order in which they are found."""
    found = [START]
    for stack in found:
        found += [new for role in ROLES if (new := shift(stack, role)) and new not in found]
    return found


STACKS = _all_stacks()
NUMBER = {stack: i for i, stack in enumerate(STACKS)}

# A symbol: the initial of the role ("-" for others), then "x" for a row that
# has to go, "t" for a truncated one, "." for a good one.
# A frontier: for each live stack (number, cost, rank), ranks in the order of
# audits. A step back: for each stack (number before, edits since).
Frontier = tuple[tuple[int, int, int], ...]


def _inserted(frontier: Frontier) -> dict[int, tuple[int, int, str, int]]:
    """Each stack that insertions reach: (cost, rank, edits, stack before).
    Inserted rows are users and assistants."""
    best = {n: (cost, rank, "", n) for n, cost, rank in frontier}
    fresh = dict(best)
    while fresh:
        reached: dict[int, tuple[int, int, str, int]] = {}
        for n, (cost, rank, edits, origin) in fresh.items():
            for role in "ua":
                stack = shift(STACKS[n], role)
                if stack is None:
                    continue
                entry = (cost + INSERT, rank, edits + "I", origin)
                to = NUMBER[stack]
                if to not in best or entry < best[to]:
                    best[to] = reached[to] = entry
        fresh = reached
    return best


def read_row(frontier: Frontier, symbol: str) -> tuple[int, Frontier, dict[int, tuple[int, str]]]:
    """(what the cheapest stack got dearer, the frontier behind the row with
    costs above that, how each of its stacks came about)."""
    initial, state = symbol
    found: dict[int, tuple[int, int, str, int]] = {}

    def offer(stack: Stack | None, entry: tuple[int, int, str, int]) -> None:
        if stack is not None and (NUMBER[stack] not in found or entry < found[NUMBER[stack]]):
            found[NUMBER[stack]] = entry

    for n, (cost, rank, edits, origin) in _inserted(frontier).items():
        offer(STACKS[n], (cost + DELETE, rank, edits + "D", origin))
        if state == "x":
            continue
        extra = cost + (TRUNCATED if state == "t" else 0)
        if initial in ROLES:
            offer(shift(STACKS[n], initial), (extra, rank, edits + "K", origin))
        for role in "ua":
            offer(shift(STACKS[n], role), (extra + REROLE, rank, edits + "R", origin))
    least = min(entry[0] for entry in found.values())
    by_audit = sorted(found, key=lambda n: found[n][1:3])
    new = tuple((n, found[n][0] - least, by_audit.index(n)) for n in sorted(found))
    return least, new, {n: (found[n][3], found[n][2]) for n in found}


def end(frontier: Frontier) -> tuple[int, int, str]:
    """(cost, stack before, edits) of the cheapest way to end the talk."""
    ways = [(cost, rank, edits, origin) for n, (cost, rank, edits, origin) in _inserted(frontier).items() if STACKS[n][0] in ACCEPT]
    cost, _, edits, origin = min(ways)
    return cost, origin, edits


class Parser:
    """Reads rows from one stack; remembers steps, not texts."""

    def __init__(self, memory: dict, first: int = 0):
        self.memory, self.cost, self.back = memory, 0, []
        self.frontier: Frontier = ((first, 0, 0),)

    def read(self, symbol: str) -> None:
        key = self.frontier, symbol
        step = self.memory.get(key)
        if step is None:
            step = self.memory[key] = read_row(*key)
        least, self.frontier, origins = step
        self.cost += least
        self.back.append(origins)

    def edits(self, last: int) -> list[str]:
        """The edits of each row, insertions before it included, of the way
        that ends in stack ``last``."""
        out = []
        for origins in reversed(self.back):
            last, edit = origins[last]
            out.append(edit)
        return out[::-1]


def apply(edits: Iterator[tuple[str, str, str]], stack: int = 0) -> Iterator[tuple[str, str, str]]:
    """From (edits, role, text) of rows: (edit, role, text) of the rows that
    the talk has then, deleted ones left out. Which role an insertion or a new
    role gives is told by the stack."""
    now = STACKS[stack]
    for some, role, text in edits:
        for edit in some:
            if edit == "D":
                continue
            initial = role[0] if edit == "K" else next(r for r in "ua" if shift(now, r))
            now = shift(now, initial)
            yield edit, role if edit == "K" else ROLES[initial], "" if edit == "I" else text


def symbol_of(role: str, text: str, seen: bool) -> tuple[str, str]:
    """(symbol, fault) of a row; ``seen``: role and text stood earlier."""
    bare = text.rstrip(WHITE)
    fault = "blank" if not bare else "duplicate" if seen else "" if bare[-1] in ".!?" else "truncated"
    return (role[0] if role[:1] in ROLES else "-") + {"": ".", "truncated": "t"}.get(fault, "x"), fault


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


@dataclass
class Talk:
    """One conversation, or as much of it as was read."""

    rows: list[tuple[int | None, str, str]] = field(default_factory=list)
    size: int = 0

    def report(self, memory: dict) -> tuple[dict, list[str]]:
        """Counts and costs, and the edits of all rows and of the end."""
        parser, seen, faults = Parser(memory), set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in self.rows:
            key = role, text
            symbol, fault = symbol_of(role, text, key in seen)
            seen.add(key)
            if fault:
                faults[fault] += 1
            parser.read(symbol)
        cost, last, closing = end(parser.frontier)
        edits = [*parser.edits(last), closing]
        turns = [turn for turn, _, _ in self.rows if turn is not None]
        initials = [role[:1] for _, role, _ in self.rows]
        return {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **faults,
            "illegal": sum(not legal(a, b) for a, b in zip(initials, initials[1:])),
            "cost": parser.cost + cost,
            "audit": "".join(edits),
        }, edits

    def repaired(self, edits: list[str]) -> Iterator[tuple[str, str, str]]:
        return apply((e, role, text) for e, (_, role, text) in zip(edits, [*self.rows, (None, "", "")]))


def _tell(rows: Iterator[tuple[str, str]], digest, begun: bool = False) -> bool:
    """Feed ``role:text`` lines to a digest; true when there was a line."""
    for role, text in rows:
        digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
        begun = True
    return begun


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, times: the conversations with faults put in,
    chosen by a checksum of conversation and turn. ``times`` is how often a
    row stands: 0 for a dropped one, 2 for a repeated one. A null role or text
    is one space, and so is a null conversation or turn in the checksum."""
    conv, turn = F.col(conv_col), F.col(turn_col)
    told = F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)))
    kind = F.crc32(told.cast("binary")) % 20
    text = F.coalesce(F.col(text_col), F.lit(" "))
    return conversations.select(
        conv.alias("conv_id"),
        turn.cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role_col), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Ranges of conversations and turns, in order. Rows of one turn come in
    order of role, the first characters of the text and its hash; rows equal
    in all of these are alike, and a conversation of such rows only is still
    dealt over several ranges."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "head", "h", "place")]
    named = rows.withColumns({"head": F.substring("text", 1, 64), "h": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    return named.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "times")


_NUMBERS = ("part", "pos", *COUNTS, "turn")


class _Sink:
    """Output rows of a mapper, in batches of some megabytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, size: int = 0, **row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= 5000 or self.size >= HELD_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0


def _read(staged: Stage, rows: DataFrame, messages: bool) -> DataFrame:
    """One pass over the ordered rows. kind "done": the report of a whole
    conversation, or with ``messages`` its repaired rows; kind "open": the
    rows of conversations that need more than this partition, with their mark
    (see ``symbol_of``); an open row that was dropped has no role."""
    ordered = _ordered(rows)
    schema = T.StructType([T.StructField("kind", T.StringType()), ordered.schema["conv_id"]])
    for name in (*_NUMBERS, "audit", "repaired_sha256", "mark", "edit", "role", "text"):
        schema.add(name, T.LongType() if name in _NUMBERS else T.StringType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, memory, sink = TaskContext.get().partitionId(), {}, None
        talk, conv, first, over, pos = None, None, True, False, 0

        def close(is_open: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pos
            if is_open:
                for turn, role, text in talk.rows:
                    mark = None if role is None else symbol_of(role, text, False)[0]
                    yield from sink.add(len(text), kind="open", conv_id=conv, part=part, pos=pos, turn=turn, role=role, text=text, mark=mark)
                    pos += 1
                talk.rows.clear()
                talk.size = 0
                return
            talk.rows = [row for row in talk.rows if row[1] is not None]
            report, edits = talk.report(memory)
            if messages:
                for at, (edit, role, text) in enumerate(talk.repaired(edits)):
                    yield from sink.add(len(text), kind="done", conv_id=conv, part=part, pos=at, edit=edit, role=role, text=text)
                return
            digest = hashlib.sha256()
            _tell(((role, text) for _, role, text in talk.repaired(edits)), digest)
            yield from sink.add(len(report["audit"]), kind="done", conv_id=conv, **report, repaired_sha256=digest.hexdigest())

        for batch in portions(batches):
            if sink is None:
                field_type = batch.schema.field("conv_id").type
                sink = _Sink(pa.schema([(n, field_type if n == "conv_id" else pa.int64() if n in _NUMBERS else pa.string()) for n in schema.names]))
            for conv_id, turn, role, text, times in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "times"))):
                if talk is None or conv_id != conv:
                    if talk is not None:
                        yield from close(first or over)
                        first = False
                    talk, conv, over, pos = Talk(), conv_id, False, 0
                talk.rows += [(turn, role, text)] * times or [(turn, None, "")]
                talk.size += len(text) * times
                if len(talk.rows) > HELD or talk.size > HELD_BYTES:
                    over = True
                    yield from close(True)
        if talk is not None:
            yield from close(True)
            yield from sink.flush()

    return staged(map_rows(ordered, work, schema), "read")


def _segments(staged: Stage, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the open rows: these with ``fault`` and ``symbol``, and segments
    (conv, part, seg, places, symbols)."""
    text = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    here = F.struct("part", "pos")
    alive = rows.where("role IS NOT NULL")
    # Where a role and text stand first; a text that fills a conversation is
    # one row here, and the rows look themselves up by their place.
    first = alive.groupBy("conv", text.alias("h")).agg(F.min(here).alias("at")).select("conv", "at.*", F.lit(True).alias("new"))
    seen = alive.join(first, ["conv", "part", "pos"], "left").withColumn("seen", F.col("new").isNull())
    blank, cut = F.col("mark").endswith("x"), F.col("mark").endswith("t")
    fault = F.when(blank, "blank").when(F.col("seen"), "duplicate").when(cut, "truncated")
    marked = seen.select("*", fault.alias("fault"), F.when(F.col("seen"), F.concat(F.substring("mark", 1, 1), F.lit("x"))).otherwise(F.col("mark")).alias("symbol"))
    marked = staged(marked, "marked")
    inside = F.array_sort(F.collect_list(F.struct("pos", "symbol")))
    grouped = marked.groupBy("conv", "part", F.floor(F.col("pos") / SEGMENT).cast("long").alias("seg")).agg(inside.alias("inside"))
    return marked, staged(grouped.select("conv", "part", "seg", F.col("inside.pos").alias("places"), F.col("inside.symbol").alias("symbols")), "segments")


def _few(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _ways(segments: DataFrame) -> DataFrame:
    """For each segment and stack it may begin with: the stacks it may end
    with, their costs and their order (four numbers each)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in _few(batches):
            ways, inner, ends = [], [], []
            for symbols in batch.column("symbols").to_pylist():
                found: list[int] = []
                for first in range(len(STACKS)):
                    parser = Parser(memory, first)
                    for symbol in symbols:
                        parser.read(symbol)
                    for last, cost, rank in parser.frontier:
                        found += [first, last, parser.cost + cost, rank]
                ways.append(found)
                inner.append(sum(not legal(a[0], b[0]) for a, b in zip(symbols, symbols[1:])))
                ends.append(symbols[0][0] + symbols[-1][0])
            columns = [*(batch.column(c) for c in ("conv", "part", "seg")), pa.array(ways, pa.list_(pa.int64())), pa.array(inner, pa.int64()), pa.array(ends)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "part", "seg", "ways", "inner", "ends"])

    return map_rows(segments.drop("places"), work, "conv STRING, part BIGINT, seg BIGINT, ways ARRAY<BIGINT>, inner BIGINT, ends STRING")


def _joined(ways: DataFrame) -> DataFrame:
    """Along each conversation: the stack each segment begins and ends with,
    the edits behind the last one, and in its row cost and illegal borders."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, frontier, border, illegal = None, [], (), "", 0
        names = ["conv", "part", "seg", "first", "last", "closing", "cost", "illegal"]

        def close() -> pa.RecordBatch:
            cost, last, closing = end(frontier)
            out = []
            for part, seg, origins in reversed(held):
                out.append((conv, part, seg, origins[last], last, closing, cost, illegal))
                last, closing, cost = origins[last], "", None
            columns = list(zip(*reversed(out)))
            counts = [None] * (len(out) - 1) + [illegal]
            kinds = [pa.string(), *[pa.int64()] * 4, pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*columns[:-1], counts], kinds)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    if held:
                        yield close()
                    conv, held, frontier, border, illegal = row["conv"], [], ((0, 0, 0),), "", 0
                now = {n: (cost, rank) for n, cost, rank in frontier}
                best: dict[int, tuple[int, int, int, int]] = {}
                flat = row["ways"]
                for first, last, cost, rank in zip(flat[::4], flat[1::4], flat[2::4], flat[3::4]):
                    if first in now:
                        entry = (now[first][0] + cost, now[first][1], rank, first)
                        if last not in best or entry < best[last]:
                            best[last] = entry
                order = sorted(best, key=lambda n: best[n][1:3])
                frontier = tuple((n, best[n][0], order.index(n)) for n in sorted(best))
                held.append((row["part"], row["seg"], {n: best[n][3] for n in best}))
                illegal += row["inner"] + (border != "" and not legal(border, row["ends"][0]))
                border = row["ends"][1]
        if held:
            yield close()

    sorted_ = ways.repartition("conv").sortWithinPartitions("conv", "part", "seg")
    return map_rows(sorted_, work, "conv STRING, part BIGINT, seg BIGINT, first BIGINT, last BIGINT, closing STRING, cost BIGINT, illegal BIGINT")


def _edited(segments: DataFrame, joined: DataFrame) -> DataFrame:
    """The edits of the rows of each segment; those behind the last row of a
    conversation stand at a place after it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in _few(batches):
            places, edits = [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("places", "symbols", "first", "last", "closing")))
            for at, symbols, first, last, closing in rows:
                parser = Parser(memory, first)
                for symbol in symbols:
                    parser.read(symbol)
                places.append([*at, at[-1] + 1] if closing else at)
                edits.append([*parser.edits(last), closing] if closing else parser.edits(last))
            columns = [*(batch.column(c) for c in ("conv", "part", "seg")), pa.array(places, pa.list_(pa.int64())), pa.array(edits, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "part", "seg", "places", "edits"])

    both = segments.join(joined.select("conv", "part", "seg", "first", "last", "closing"), ["conv", "part", "seg"])
    return map_rows(both, work, "conv STRING, part BIGINT, seg BIGINT, places ARRAY<BIGINT>, edits ARRAY<STRING>")


def _stream(rows: DataFrame, digests: bool) -> DataFrame:
    """Rows (conv, part, pos, edits, role, text) of open conversations, one
    conversation after the other: its digest, or its repaired rows. Nothing
    but the stack is kept from row to row."""
    if digests:
        schema = "conv STRING, repaired_sha256 STRING"
    else:
        schema = "conv STRING, part BIGINT, pos BIGINT, edit STRING, role STRING, text STRING"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, stack, begun = None, None, 0, False
        for batch in portions(batches):
            done, made = [], []
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    if conv is not None:
                        done.append({"conv": conv, "repaired_sha256": digest.hexdigest()})
                    conv, digest, stack, begun = row["conv"], hashlib.sha256(), 0, False
                some = list(apply([(row["edits"], row["role"], row["text"])], stack))
                for edit, role, _ in some:
                    stack = NUMBER[shift(STACKS[stack], role[0])]
                if digests:
                    begun = _tell(((role, text) for _, role, text in some), digest, begun)
                else:
                    made += [{"conv": conv, "part": row["part"], "pos": row["pos"], "edit": e, "role": r, "text": t} for e, r, t in some]
            if done and digests:
                yield pa.RecordBatch.from_pylist(done)
            if made:
                yield pa.RecordBatch.from_pylist(made, pa.schema([("conv", pa.string()), ("part", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
        if conv is not None and digests:
            yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": digest.hexdigest()}])

    return map_rows(rows.repartition("conv").sortWithinPartitions("conv", "part", "pos"), work, schema)


def _open(staged: Stage, read: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Repair what was left open: (rows, marked rows, joined segments, edits
    of segments, rows with their edits in the order of the conversation)."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    rows = read.where("kind = 'open'").select(key.alias("conv"), "conv_id", "part", "pos", "turn", "role", "text", "mark")
    marked, segments = _segments(staged, rows)
    joined = staged(_joined(_ways(segments)), "joined")
    edited = staged(_edited(segments, joined), "edited")
    by_row = edited.select("conv", "part", F.explode(F.arrays_zip("places", "edits")).alias("e")).select("conv", "part", F.col("e.places").alias("pos"), "e.edits")
    texts = marked.select("conv", "part", "pos", "role", "text")
    # An edit without a row of its own is the end of a conversation.
    with_text = by_row.join(texts, ["conv", "part", "pos"], "left")
    filled = with_text.withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    return rows, marked, joined, edited, filled


def repair_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    times_col: str | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    The roles of a repaired conversation are nothing, or pairs of user and
    assistant, with or without a system row before them. A row without text
    (white space only) or whose role and text stood earlier has to go; one
    that does not end in ``.!?`` may stay at an extra cost. ``audit`` are the
    edits (Keep, Rerole, Delete, Insert) of the cheapest repair, of equally
    cheap ones the first in ASCII order.

    Rows come by turn, null turns first; rows of one turn by role and text. A
    null role or text is one space; a null turn counts in no gap; rows without
    a conversation are one conversation. With ``times_col`` a row stands as
    often as that says; a conversation whose rows all stand 0 times has zeros,
    an empty audit and the digest of nothing. An empty table gives no rows.
    The type of the conversation id is kept; other columns are not looked at.
    Conversations and texts may have any length; the audit of one is one
    value, a character per edit.
    """
    staged = Stage(conversations.sparkSession, "repair")
    read = _read(staged, _named(conversations, conv_col, turn_col, role_col, text_col, times_col), messages=False)
    rows, marked, joined, edited, filled = _open(staged, read)

    spans = rows.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    counts = marked.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *(F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")),
    )
    costs = joined.groupBy("conv").agg(F.max("illegal").alias("illegal"), F.max("cost").alias("cost"))
    some = edited.select("conv", "part", "seg", F.array_join("edits", "").alias("edits"))
    audits = some.groupBy("conv").agg(F.array_join(F.array_sort(F.collect_list(F.struct("part", "seg", "edits"))).getField("edits"), "").alias("audit"))
    opened = spans
    for more in (counts, costs, audits, _stream(filled, digests=True)):
        opened = opened.join(more, "conv", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    opened = opened.na.fill(0, list(COUNTS)).na.fill({"audit": "", "repaired_sha256": nothing})
    return read.where("kind = 'done'").select(names).union(opened.select(names))


def repaired_rows(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    times_col: str | None = None,
) -> DataFrame:
    """The repaired conversations themselves: conv_id, part, pos, edit, role,
    text. Rows of a conversation come in order of (part, pos, insertions
    first); deleted rows are left out. Rows are read as by
    ``repair_conversations``."""
    staged = Stage(conversations.sparkSession, "repaired-rows")
    read = _read(staged, _named(conversations, conv_col, turn_col, role_col, text_col, times_col), messages=True)
    rows, _, _, _, filled = _open(staged, read)
    ids = rows.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    names = ["conv_id", "part", "pos", "edit", "role", "text"]
    return read.where("kind = 'done'").select(names).union(_stream(filled, digests=False).join(ids, "conv").select(names))


def _named(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, times_col: str | None) -> DataFrame:
    times: Column = F.lit(1) if times_col is None else F.coalesce(F.col(times_col), F.lit(0))
    return conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        *(F.coalesce(F.col(c), F.lit(" ")).alias(name) for c, name in ((role_col, "role"), (text_col, "text"))),
        times.cast("int").alias("times"),
    )
