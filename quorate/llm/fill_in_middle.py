"""Fill-in-middle by piece tables.

A document is a list of descriptors (buffer, start, stop) over buffers that
never change: its own bytes and the three sentinels. Cutting a document splits
a descriptor in two; an arrangement is a permutation of the descriptors with
sentinels put in between; the inverse permutation restores the text. Nothing
is copied until somebody asks for the text: digests are streamed over the
descriptors.

The units a document is cut at, and its size in code points, are counted on the
UTF-8 bytes of many documents at once: a byte that continues a code point
starts nothing, a letter behind a letter starts no unit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.llm.common import map_rows, normal, portions

# The sentinels, and the order of parts in each form.
SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
ORDERS = {"psm": "PSM", "spm": "SPM"}
TEXT_ORDER = "PMS"
NUMBERS = ("n", "prefix_chars", "middle_chars")

Table = list[tuple[bytes, int, int]]


def whole(text: bytes) -> Table:
    return [(text, 0, len(text))]


def split(table: Table, at: int) -> tuple[Table, Table]:
    """The tables of the first ``at`` bytes and of the rest; a descriptor that
    has the border inside becomes two."""
    for place, (buffer, start, stop) in enumerate(table):
        if at < stop - start:
            left = [(buffer, start, start + at)] if at else []
            return table[:place] + left, [(buffer, start + at, stop), *table[place + 1 :]]
        at -= stop - start
    return table, []


def cut(table: Table, first: int, second: int) -> dict[str, Table]:
    """Prefix, middle and suffix; a part may be empty."""
    prefix, rest = split(table, first)
    middle, suffix = split(rest, second - first)
    return {"P": prefix, "M": middle, "S": suffix}


def arrange(parts: dict[str, Table], form: str) -> Table:
    """The parts in the order of ``form``, each behind its sentinel."""
    return [piece for name in ORDERS[form] for piece in (*whole(SENTINELS[name]), *parts[name])]


def restore(output: bytes, form: str) -> Table:
    """The table of the text that ``output`` was made from: the output is
    split at its sentinels, and the inverse permutation brings its pieces back
    into order. A text that has a sentinel of its own is never arranged, so
    the first place of each is the right one."""
    table, parts = whole(output), {}
    if form == "plain":
        return table
    for name in reversed(ORDERS[form]):
        table, tail = split(table, output.index(SENTINELS[name]))
        parts[name] = split(tail, len(SENTINELS[name]))[1]
    return [piece for name in TEXT_ORDER for piece in parts[name]]


def stream(table: Table) -> Iterator[memoryview]:
    for buffer, start, stop in table:
        yield memoryview(buffer)[start:stop]


def digest(table: Table) -> str:
    found = hashlib.sha256()
    for view in stream(table):
        found.update(view)
    return found.hexdigest()


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of texts: all bytes, the offsets of the texts in them, the
    places at which units start, and the places at which code points start."""
    offsets = np.frombuffer(column.buffers()[1], "<i4", len(column) + 1, column.offset * 4)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, "u1")[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, "u1")
    offsets = offsets.astype("i8") - offsets[0]
    head = (data & 0xC0) != 0x80
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    starts = head.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[offsets[:-1][offsets[:-1] < len(data)]] = True  # of every text, whatever stands before it
    return data, offsets, np.flatnonzero(starts), np.flatnonzero(head)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain: int = 90, spm: int = 20, with_output: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars,
    middle_chars, output_sha256, restored_sha256 and, unless left out, output.

    A text has n units: a run of A-Z and a-z, or one other code point. Two
    numbers of the hash of seed and id say after how many units the prefix and
    the middle end; a third leaves the text plain if its last two digits are
    ``plain`` or more, a fourth chooses spm if they are below ``spm``, else
    psm. Texts that are empty or hold a sentinel stay plain and have null
    sizes. A null text is empty; a null id hashes like an empty one; repeated
    rows are cut alike; an empty table gives no rows; the type of the id is
    kept; other columns are not looked at. The length of a text is not
    limited.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = normal(docs, id_col, text_col).select("doc_id", "text", F.sha2(key, 256).alias("hash"))
    schema = T.StructType([rows.schema["doc_id"]])
    for name in ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", *["output"] * with_output):
        schema.add(name, T.LongType() if name in NUMBERS else T.StringType())
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            data, offsets, starts, heads = _units(batch.column("text"))
            first_unit = np.searchsorted(starts, offsets).tolist()
            made: list[list] = [[] for _ in names[1:]]
            for row, hexes in enumerate(batch.column("hash").to_pylist()):
                low, high = int(offsets[row]), int(offsets[row + 1])
                text = data[low:high].tobytes()
                n = first_unit[row + 1] - first_unit[row]
                h1, h2, h3, h4 = (int(hexes[i : i + 8], 16) for i in (0, 8, 16, 24))
                form, chars, table = "plain", (None, None), whole(text)
                if text and h3 % 100 < plain and not any(s in text for s in SENTINELS.values()):
                    form = "spm" if h4 % 100 < spm else "psm"
                    ends = sorted((h1 % (n + 1), h2 % (n + 1)))
                    first, second = (int(starts[first_unit[row] + e]) if e < n else high for e in ends)
                    points = np.searchsorted(heads, (low, first, second)).tolist()
                    chars = points[1] - points[0], points[2] - points[1]
                    table = arrange(cut(table, first - low, second - low), form)
                output = b"".join(stream(table))
                values = [n, form, *chars, digest(table), digest(restore(output, form)), output.decode()]
                for held, value in zip(made, values):
                    held.append(value)
            arrays = [pa.array(held, pa.int64() if name in NUMBERS else pa.string()) for name, held in zip(names[1:], made)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    return map_rows(rows, work, schema)
