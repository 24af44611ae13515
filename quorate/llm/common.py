"""What the operators share: inputs, staging, text chunks, sampling."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.sources.staging import new_folder, stage

__all__ = [
    "Remembered", "Runs", "Stage", "binary_array", "bounded_labels", "gather", "held_out", "id_type", "lower_ascii", "map_rows", "normal", "one_text",
    "portions", "ship", "table",
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is
    empty. Whatever else ``docs`` has, and however it is named, stays out."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def id_type(rows: DataFrame) -> str:
    """The type of the ids, which an operator hands on as it is."""
    return rows.schema["doc_id"].dataType.simpleString()


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(key: Column) -> Column:
    """The fifth of the documents whose labels no model may see. A null key
    counts as held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


class Stage:
    """A folder for the intermediate tables of one call, below the shared
    folder that ``spark.checkpoint.dir`` names."""

    def __init__(self, spark: SparkSession, label: str):
        self.folder = new_folder(spark, label)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, self.folder, name)


def portions(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, at least one
    row each: what Python makes of a text is many times as large."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype="i8") // size
        starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        for at, stop in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(at, stop - at)


class Runs:
    """Runs of numbers, kept in one array: run i are ``sizes[i]`` of
    ``values`` from ``starts[i]``."""

    def __init__(self, codes: list[bytes], dtype: str = "<u4"):
        self.values = np.frombuffer(b"".join(codes), dtype)
        self.sizes = np.fromiter(map(len, codes), "i8", len(codes)) // self.values.itemsize
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def with_more(self, other: Runs) -> Runs:
        out = Runs([])
        out.values = np.concatenate([self.values, other.values])
        out.sizes = np.concatenate([self.sizes, other.sizes])
        out.starts = np.concatenate([self.starts, other.starts + len(self.values)])
        return out

    def some(self, which: np.ndarray) -> Runs:
        out = Runs([])
        out.values, firsts = gather(self.values, self.starts, self.sizes, which)
        out.sizes, out.starts = self.sizes[which], firsts[:-1]
        return out

    def of_texts(self, which: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs ``which``, one after the other, and for each text, whose runs
        begin at ``firsts``, the first of its numbers (and the end)."""
        values, places = gather(self.values, self.starts, self.sizes, which)
        return values, places[firsts]


class Remembered:
    """Codes of pieces of text: a distinct piece is coded once, the new ones of
    a call together. Pieces and codes are kept in arrays, not as objects;
    ``limit`` bounds their number and ``bytes_`` their size, not the results."""

    def __init__(self, code: Callable[[list[bytes]], list[bytes]], limit: int = 400_000, bytes_: int = 16_000_000):
        self.code, self.limit, self.bytes = code, limit, bytes_
        self.forget()

    def forget(self) -> None:
        self.known, self.runs = pa.array([], pa.binary()), Runs([])

    def look(self, pieces: pa.Array) -> tuple[Runs, np.ndarray]:
        """Runs with the codes of distinct pieces, and where each piece's is."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype("i8")
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            new = pieces.take(pa.array(fresh))
            at[fresh] = np.arange(len(fresh)) + len(self.known)
            self.runs = self.runs.with_more(Runs(self.code(new.to_pylist())))
            self.known = pa.concat_arrays([self.known, new])
        if len(self.known) > self.limit or self.known.nbytes > self.bytes:
            self.known, self.runs = pieces, self.runs.some(at)
            at = np.arange(len(pieces))
        return self.runs, at


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values``, one after the other: run ``which[i]`` begins at
    ``starts`` and has ``sizes`` of it. Also the first place of each run in
    what comes out, and the end."""
    n = sizes[which]
    ends = np.cumsum(n)
    firsts = np.concatenate([[0], ends])
    at = np.arange(firsts[-1]) + np.repeat(starts[which] - firsts[:-1], n)
    return values[at], firsts


def binary_array(values: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """A binary column from the bytes of ``values``, cut at ``firsts``."""
    offsets = firsts * values.itemsize
    if offsets[-1] < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(firsts) - 1, [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(values)])
    return pa.array([values[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:])], pa.binary())


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="quorate-package-")
    shutil.copytree(f"{top}/quorate", f"{folder}/src/quorate", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/quorate", "zip", f"{folder}/src"))
    _SHIPPED.add(context.applicationId)


def map_rows(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers. What a task
    leaves in its worker goes back to the system at the end of the task."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release_memory()

    return df.mapInArrow(task, schema)


def release_memory() -> None:
    """Workers live on between tasks, and freed pieces of their heap would
    stay theirs; where the C library can give them back, it does."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def one_text(rows: DataFrame, *also: str) -> DataFrame:
    """Of rows (doc_id, text, ...) one text of each id, chosen by its hash:
    however many rows a chosen id has, a sample by id stays bounded."""
    return rows.groupBy("doc_id", *also).agg(F.min_by("text", F.xxhash64("text")).alias("text")).select(*also, "text")


def bounded_labels(labels: DataFrame, column: str, bound: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``bound`` labelled rows that are not held
    out, chosen by a hash of the id; two labels of one id: the larger. The
    bound is what makes it safe to broadcast."""
    usable = labels.select(F.col(id_col).alias("doc_id"), F.col(column).cast("int").alias("label"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(bound)
    return chosen.groupBy("doc_id").agg(F.max("label").alias("label"))
