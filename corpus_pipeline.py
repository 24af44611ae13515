"""Corpus pipeline: from raw documents to token ids.

``STAGES`` are applied in order. Each takes (spark, docs, sf_dir) and returns
a DataFrame; the caller writes it as Parquet and reads it again as the next
one's documents. All but the last keep the columns of ``docs``, whatever else
is among them and however it is named.

A null text is empty. Null and repeated ids do no harm: filters tell rows apart
by their place or by their text, never by their id. An empty table passes
through as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorate.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from quorate.llm.common import Stage, table

#: A quality model is a neural net fitted here; SQL can't say it.
ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; of an empty text
    it judges zero features. Without usable labels nothing is rejected that a
    constant score of a half would keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of equal texts;
    null and empty texts are one group. A row with an id goes before one
    without, and of equal ids the first in the scan stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies:
    five-word shingles, similarity 0.8 or more. Texts without words are in no
    group and stay; ties as above."""
    return near_dedup.drop_near_copies(docs, k=5, similarity=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; a document
    without words, or a benchmark without items, has no window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), and the digests
    of ids and of the text they decode to; a null text has no ids, a null id
    stays null."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN, decode=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written below the
    folder in ``spark.checkpoint.dir`` and read again."""
    staged = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = staged(work(spark, docs, sf_dir), name)
    return docs
