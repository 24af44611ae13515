"""The corpus pipeline against a plain version of its exact stages."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from quorate.llm import bpe, decontaminate, near_dedup, quality
from quorate.llm.common import table


def test_stages_take_effect(spark, data):
    docs = table(spark, data, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontaminate", "byte_bpe"]
    kept = [docs.count()]
    for name, work in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(work(spark, docs, data).collect(), docs.schema)
        assert after.columns == docs.columns and after.exceptAll(docs).isEmpty()
        docs = after
        kept.append(docs.count())
    assert all(a >= b for a, b in zip(kept, kept[1:])) and kept[-1] > 0.5 * kept[0]
    assert docs.select(F.lower("text")).distinct().count() == docs.count()
    assert near_dedup.near_duplicates(docs).where("NOT kept").isEmpty()
    coder = bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in docs.collect()}
    last = corpus_pipeline.encode(spark, docs, data).collect()
    assert {r.doc_id for r in last} == set(texts)
    for r in last:
        assert coder.decode(bytes(r.ids)).decode() == texts[r.doc_id] and r.n_tokens == len(r.ids) // 4
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def _rows():
    """Distinct words per text; null and repeated ids on copies and on others."""
    text = lambda key, n=40: " ".join(f"{key}{i}" for i in range(n))
    near = lambda key: text(key, 39) + " changed"
    item = "the item " + text("it", 12)
    texts = [
        (1, text("a")), (2, near("a")), (2, text("other")), (None, near("a") + " more"), (None, text("b")), (None, near("b")),
        (None, text("c")), (3, text("d")), (3, near("d")), (4, "x " + item), (4, text("clean")), (None, item + " y"), (None, None),
        (None, ""), (5, "one"),
    ]
    return [(i, t, "en", f"s{n}", n) for n, (i, t) in enumerate(texts)], item


def test_stages_keep_rows_not_ids(spark):
    """Held against plain versions, by the row number in n_chars."""
    rows, item = _rows()
    df = spark.createDataFrame(rows, SCHEMA)

    def shingles(t):
        w = (t or "").split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    group = list(range(len(rows)))
    for a in group[:]:
        for b in range(a):
            x, y = shingles(rows[a][1]), shingles(rows[b][1])
            if x and 100 * len(x & y) >= 80 * len(x | y):
                group = [group[b] if g == group[a] else g for g in group]
    want = {min((r for r, g in enumerate(group) if g == own), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, r)) for own in set(group)}
    got = sorted(r.n_chars for r in near_dedup.drop_near_copies(df.coalesce(1)).collect())
    assert got == sorted(want) and 2 in got and 5 not in got

    windows = [tuple(item.split()[i : i + 10]) for i in range(len(item.split()) - 9)]
    hit = lambda t: any(tuple((t or "").split()[i : i + 10]) in windows for i in range(len((t or "").split())))
    items = spark.createDataFrame([("q", item)], "item_id STRING, text STRING")
    got = sorted(r.n_chars for r in decontaminate.drop_contaminated(df, items).collect())
    assert got == [n for n, r in enumerate(rows) if not hit(r[1])] and {10, 12} <= set(got)


def test_quality_keeps_the_rows_that_score(spark, data):
    """Rows, not ids: null and repeated ids are judged by their own text."""
    docs = table(spark, data, "documents")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 1, 1).otherwise(F.col("doc_id")))
    known = table(spark, data, "labels")
    key = lambda r: (r.doc_id is not None, r.doc_id or 0)
    want = sorted((r for r in quality.score_quality(docs, known).collect() if r.score >= 0.3), key=key)
    got = sorted(corpus_pipeline.drop_low_quality(spark, docs, data).collect(), key=key)
    assert [r.doc_id for r in got] == [r.doc_id for r in want]
