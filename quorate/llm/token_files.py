"""Token ids in directly addressable files.

An id is cut into chunks of eight bits, the lowest first. Level 0 holds the
first chunk of every token; a bit per chunk tells whether the token goes on,
and a directory of ranks tells where in the next level it does. So token i is
read by one chunk and one rank per level, without decoding what lies before
it; a run of tokens is one run of chunks per level.

A file: the magic word, a length and a JSON header (counts and the place of
each section), then the sections: document ids, a null mark per document, the
first token of each document, and for each level chunks, bitmap and ranks.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorate.llm.common import Remembered, Runs, binary_array, map_rows, normal, portions
from quorate.sources.staging import new_folder, stage

MAGIC = b"QDAC1\n"
BLOCK = 512  # bits for which the directory has one rank
#: Tokens after which a partition starts another file.
FILE_TOKENS = 16_000_000


class WordBpe:
    """Ids of the tokenizers library, asked once for each distinct word.

    White space is dropped by the tokenizer and no pre-token crosses it, so a
    text is the sequence of its words. A word's trailing ASCII punctuation is
    a pre-token of its own when a letter or digit comes before it. A-Z are
    lowered first, as the tokenizer does; a text with the mark of a special
    token goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words = Remembered(self._encode_words)

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        plain = [w for w in words if _LETTERS.fullmatch(w)]
        odd = [w for w in words if not _LETTERS.fullmatch(w)]
        coded: dict[bytes, bytes] = {}
        for at in range(0, len(plain), 1000):
            # Words of plain letters are a pre-token each, and the last token
            # of a pre-token is marked in the vocabulary.
            some = plain[at : at + 1000]
            ids = np.array(self.library.encode(b" ".join(some).decode(), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                odd.extend(some)
                continue
            raw, bounds = ids.tobytes(), (cuts * 4).tolist()
            coded.update((w, raw[a:b]) for w, a, b in zip(some, [0, *bounds], bounds))
        for at in range(0, len(odd), 500):
            # Tokens of other words are told apart by where they begin.
            some = odd[at : at + 500]
            texts = [w.decode() for w in some]
            found = self.library.encode(" ".join(texts), add_special_tokens=False)
            raw = np.array(found.ids, "<u4").tobytes()
            begins = np.array([begin for begin, _ in found.offsets], "i8")
            ends = np.cumsum([len(t) + 1 for t in texts])
            bounds = (np.searchsorted(begins, ends) * 4).tolist()
            coded.update((w, raw[a:b]) for w, a, b in zip(some, [0, *bounds], bounds))
        return [coded[w] for w in words]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the first of each text
        (and the end). Lowering, splitting and finding the distinct words are
        Arrow's, the library is asked for those only."""
        special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        plain = texts
        if len(special):
            mask = np.zeros(len(texts), bool)
            mask[special] = True
            plain = pc.if_else(pa.array(mask), "", texts)
        split = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        words = split.flatten().dictionary_encode()
        # Trailing punctuation is a pre-token of its own, so that it and the
        # word before it are remembered apart.
        parts = pc.extract_regex(words.dictionary, _TAIL)
        no_tail = pc.is_null(parts)
        first = pc.if_else(no_tail, words.dictionary, pc.struct_field(parts, "word")).cast(pa.binary())
        tail = pc.fill_null(pc.struct_field(parts, "tail"), "").cast(pa.binary())
        both = pa.concat_arrays([first, tail]).dictionary_encode()
        runs, at = self.words.look(both.dictionary)
        at = at[both.indices.to_numpy()]
        which = words.indices.to_numpy()
        pairs = np.stack([at[: len(first)][which], at[len(first) :][which]], 1)
        lengths = pc.list_value_length(split).to_numpy()
        firsts = np.concatenate([[0], np.cumsum(lengths)])
        if len(special):
            # A text without words has one empty piece; that of a special text
            # becomes the whole text.
            pairs[firsts[:-1][special], 0] = np.arange(len(special)) + len(runs)
            runs = runs.with_more(Runs(self._direct([texts[int(i)].as_py() for i in special])))
        return runs.of_texts(pairs.reshape(-1), firsts * 2)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return binary_array(*self.encode_array(pa.array(texts, pa.string()))).to_pylist()


_TAIL = r"^(?s)(?P<word>.*[a-z0-9])(?P<tail>[!-/:-@\[-`{-~]+)$"
_LETTERS = re.compile(rb"[a-z]+")


@cache
def _coder(path: str) -> WordBpe:
    """The library's tables stay with a worker; words are a task's own."""
    return WordBpe(path)


def encode_words(docs: DataFrame, path: str, end_id: int | None = None) -> DataFrame:
    """(doc_id, ids) for rows of (doc_id, text), in their order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        coder.words.forget()
        for batch in portions(batches, size=4_000_000):
            ids, firsts = coder.encode_array(batch.column("text"))
            if end_id is not None:
                ids, firsts = np.insert(ids, firsts[1:], end_id), firsts + np.arange(len(firsts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), binary_array(ids, firsts)], names=["doc_id", "ids"])
        coder.words.forget()

    return map_rows(docs.select("doc_id", "text"), work, "doc_id BIGINT, ids BINARY")


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One file's bytes."""
    sections: list[bytes] = [
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array([i is None for i in doc_ids], "u1").tobytes(),
        np.concatenate([[0], np.cumsum(lengths)]).astype("<i8").tobytes(),
    ]
    levels, rest = [], np.ascontiguousarray(ids, "<u4")
    while True:
        more = rest > 255
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype="i8") if len(more) else np.zeros(0, "i8")
        ranks = np.concatenate([[0], np.cumsum(ones)]).astype("<i8")
        levels.append(len(rest))
        sections += [(rest & 255).astype("u1").tobytes(), np.packbits(more, bitorder="little").tobytes(), ranks.tobytes()]
        rest = rest[more] >> 8
        if not len(rest):
            break
    places, at = [], 0
    for section in sections:
        places.append([at, len(section)])
        at += len(section)
    header = json.dumps({"docs": len(doc_ids), "tokens": len(ids), "levels": levels, "sections": places}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *sections])


class TokenFile:
    """Random access to one file, through any object with seek and read."""

    def __init__(self, source):
        self.source = source
        source.seek(0)
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(source.read(4), "little")
        header = json.loads(source.read(size))
        self.base = len(MAGIC) + 4 + size
        self.n_docs, self.n_tokens, self.levels, self.places = (header[k] for k in ("docs", "tokens", "levels", "sections"))

    def _section(self, number: int, dtype: str, first: int = 0, n: int | None = None) -> np.ndarray:
        at, size = self.places[number]
        width = np.dtype(dtype).itemsize
        n = size // width - first if n is None else n
        self.source.seek(self.base + at + first * width)
        return np.frombuffer(self.source.read(n * width), dtype)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids and, one longer, the first token of each."""
        ids, null = self._section(0, "<i8").tolist(), self._section(1, "u1").tolist()
        return [None if gone else i for i, gone in zip(ids, null)], self._section(2, "<i8")

    def read(self, first: int, n: int) -> np.ndarray:
        """Tokens first to first + n - 1. Reads as many chunks as they have,
        and less than one block of bits before them."""
        if first < 0 or n < 0 or first + n > self.n_tokens:
            raise IndexError("no such tokens")
        return self._level(0, first, n) if n else np.zeros(0, "<u4")

    def _level(self, level: int, first: int, n: int) -> np.ndarray:
        number = 3 + 3 * level
        values = self._section(number, "u1", first, n).astype("<u4")
        if level + 1 == len(self.levels):
            return values
        block = first // BLOCK
        from_byte = block * BLOCK // 8
        bits = np.unpackbits(self._section(number + 1, "u1", from_byte, -(-(first + n) // 8) - from_byte), bitorder="little")
        skip = first - block * BLOCK
        more = bits[skip : skip + n].astype(bool)
        going = int(more.sum())
        if going:
            rank = int(self._section(number + 2, "<i8", block, 1)[0]) + int(bits[:skip].sum())
            values[more] |= self._level(level + 1, rank, going) << 8
        return values

    def token(self, i: int) -> int:
        return int(self.read(i, 1)[0])


def write_files(coded: DataFrame, folder: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write (doc_id, ids) rows, partition by partition and in their order, as
    files below ``folder``, and return the manifest: part, seq, n_docs,
    n_tokens, path. The manifest is a table below the same folder.

    A file is written under a name of its own and then renamed, and its
    content depends on the rows only, so that a repeated or speculative task
    leaves the same files. A partition without rows writes none. ``folder``
    must be open to all executors.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        store, top = pa.fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        doc_ids: list[int | None] = []
        chunks: list[bytes] = []

        def flush() -> pa.RecordBatch:
            lengths = [len(c) // 4 for c in chunks]
            name = f"{top}/part-{part:06d}-{seq:04d}.dac"
            draft = f"{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(pack(doc_ids, lengths, np.frombuffer(b"".join(chunks), "<u4")))
            store.move(draft, name)
            row = [[part], [seq], [len(doc_ids)], [sum(lengths)], [f"{folder}/{name.rpartition('/')[2]}"]]
            doc_ids.clear()
            chunks.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in row], names=["part", "seq", "n_docs", "n_tokens", "path"])

        held = 0
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                doc_ids.append(doc_id)
                chunks.append(ids)
                held += len(ids) // 4
                if held >= file_tokens:
                    yield flush()
                    seq, held = seq + 1, 0
        if doc_ids:
            yield flush()

    manifest = map_rows(coded, work, "part BIGINT, seq BIGINT, n_docs BIGINT, n_tokens BIGINT, path STRING")
    return stage(manifest, folder, "manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (tokens of all documents
    before it, in the order of files), n_tokens, ids_crc32."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                store, name = pa.fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as source:
                    file = TokenFile(source)
                    ids, firsts = file.documents()
                    sums = []
                    for at in range(0, len(ids), 1000):
                        # One read for a thousand documents, then one sum each.
                        low, stop = int(firsts[at]), firsts[min(at + 1000, len(ids))]
                        tokens = file.read(low, int(stop) - low)
                        cuts = (firsts[at : at + 1001] - low).tolist()
                        sums += [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
                columns = [pa.array(ids, pa.int64()), pa.array(firsts[:-1] + base), pa.array(np.diff(firsts)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = placed.select("path", "base").repartition("path")
    return map_rows(spread, work, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")


def read_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> dict[int, np.ndarray]:
    """Tokens of a few documents, by random access; for use on the driver."""
    out = {}
    for row in spark.read.parquet(f"{folder}/manifest").toLocalIterator():
        store, name = pa.fs.FileSystem.from_uri(row["path"])
        with store.open_input_file(name) as source:
            file = TokenFile(source)
            ids, firsts = file.documents()
            for i in set(doc_ids).intersection(ids):
                at = ids.index(i)
                out[i] = file.read(int(firsts[at]), int(firsts[at + 1] - firsts[at]))
    return out


def token_files(
    docs: DataFrame, path: str, end_id: int | None = 2, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode whole texts, write them in ascending order of the id, and give
    what the files hold: doc_id, start, n_tokens, ids_crc32.

    A null text is empty and holds the end id only. Null ids come first. Rows
    of one id come in the order of the scan. An empty table writes no files
    and gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    rows = normal(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Ranges split a repeated id by its place, so that none is held by one task.
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    return read_files(write_files(encode_words(ordered, path, end_id), folder))


def buffer(raw: bytes) -> TokenFile:
    return TokenFile(io.BytesIO(raw))
