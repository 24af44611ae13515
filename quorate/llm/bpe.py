"""Byte-level BPE through a sentencepiece model made from a rank file.

The ranks of a byte-level vocabulary are written as a sentencepiece BPE model:
each token becomes a piece whose bytes are mapped to printable characters, its
score is the negative rank (so the best merge is the lowest rank), and the
normaliser is the identity. Pre-tokens are encoded one by one; decoding maps
ids back to bytes.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Remembered, Runs, binary_array, id_type, map_rows, normal, portions

def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints in Latin-1,
    else the next free code point from 256."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printing else next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a serialised message: varint, 32-bit float or bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a serialised sentencepiece model. Piece ids are
    ranks, and the unknown piece comes after the last."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    to_char = byte_characters()
    # Field numbers and type codes of the public model format.
    piece, score, kind, unknown, bpe = 1, 2, 3, 2, 2
    out = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        name = "".join(to_char[b] for b in token).encode()
        out.append(_field(1, _field(piece, name) + _field(score, float(-rank))))
    out.append(_field(1, _field(piece, b"<unk>") + _field(score, 0.0) + _field(kind, unknown)))
    trainer = _field(3, bpe) + _field(4, len(ranks) + 1) + _field(40, len(ranks))
    trainer += b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))  # no bos, eos, pad
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.tokens = [token for token, _ in sorted(ranks.items(), key=lambda item: item[1])]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.find = regex.compile(pattern).findall
        self.table = dict(enumerate(byte_characters()))
        # A pre-token that is in the vocabulary is that token, whether or not
        # merges lead to it.
        mapped = self.model.encode([t.decode("latin-1").translate(self.table) for t in self.tokens], num_threads=1)
        self.whole = {t: r for r, (t, ids) in enumerate(zip(self.tokens, mapped)) if ids != [r]}
        self.parts = Remembered(self._encode_spaced)
        self.token_bytes = Runs(self.tokens, "u1")

    def _encode_pretokens(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        ids = self.model.encode([b.decode("latin-1").translate(self.table) for b in raw], num_threads=1)
        return [np.array([self.whole[b]] if b in self.whole else i, "<u4").tobytes() for b, i in zip(raw, ids)]

    def _encode_spaced(self, parts: list[bytes]) -> list[bytes]:
        return self._encode_chunks([" " + part.decode() for part in parts])

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        split = [self.find(c) for c in chunks]
        pieces = list({p for ps in split for p in ps})
        coded = dict(zip(pieces, self._encode_pretokens(pieces)))
        return [b"".join([coded[p] for p in ps]) for ps in split]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the first of each text
        (and the end).

        A text is cut before single spaces, where a pre-token always ends, so
        that the parts repeat; Arrow cuts and finds the distinct ones, which
        are remembered. A space between other white space, or before white
        space at the end, is no such place; a text that has one is cut by the
        pattern alone.
        """
        whole = np.fromiter((bool(_RUNS.search(t)) for t in texts.to_pylist()), bool, len(texts))
        split = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        parts = split.flatten().cast(pa.binary()).dictionary_encode()
        runs, at = self.parts.look(parts.dictionary)
        which = at[parts.indices.to_numpy()]
        lengths = pc.list_value_length(split).to_numpy()
        firsts = np.concatenate([[0], np.cumsum(lengths)])
        # The first part of a text has no space before it.
        heads = pc.if_else(pa.array(whole), texts, pc.list_element(split, 0)).dictionary_encode()
        which[firsts[:-1]] = heads.indices.to_numpy() + len(runs)
        return runs.with_more(Runs(self._encode_chunks(heads.dictionary.to_pylist()))).of_texts(which, firsts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return binary_array(*self.encode_array(pa.array(texts, pa.string()))).to_pylist()

    def decode_array(self, ids: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts, and the first of each text (and the end)."""
        return self.token_bytes.of_texts(ids, firsts)

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        return self.decode_array(numbers, np.array([0, len(numbers)]))[0].tobytes()


_RUNS = re.compile(r"\s (?:\s|\Z)")


@cache
def _coder(path: str, pattern: str) -> ByteBpe:
    """The model stays with a worker; parts of texts are a task's own."""
    return ByteBpe(path, pattern)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False
) -> DataFrame:
    """(doc_id, ids) per row, or (doc_id, ids, decoded) with the decoded
    bytes; ``ids`` are little-endian unsigned 32-bit integers.

    Special tokens are ordinary text. A null text is empty and has no ids; a
    null id stays null; repeated rows stay; an empty table gives no rows;
    other columns are not looked at. The length of a text is not limited.
    """
    rows = normal(docs, id_col, text_col)
    fields = f"doc_id {id_type(rows)}, ids BINARY" + (", decoded BINARY" if decode else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        coder.parts.forget()
        for batch in portions(batches):
            ids, firsts = coder.encode_array(batch.column("text"))
            columns = [batch.column("doc_id"), binary_array(ids, firsts)]
            if decode:
                columns.append(binary_array(*coder.decode_array(ids, firsts)))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: 2 + decode])
        coder.parts.forget()

    return map_rows(rows, work, fields)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, and the digests of its ids and of the bytes
    they decode to."""
    coded = encode_documents(docs, path, pattern, id_col, text_col, decode=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
