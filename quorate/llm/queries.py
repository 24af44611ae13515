"""The queries of these operators, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorate.llm import bpe, decontaminate, exact_dedup, fill_in_middle, mixing, near_dedup, pii, quality, repair, secrets, sharding, token_files, toxicity
from quorate.llm.common import held_out, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest, "spans")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=2, similarity=80)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), with_output=False)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damage(table(spark, sf_dir, "conversations")), times_col="times")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_token_files": op3_token_files,
    "op4_secrets": op4_secrets,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_personal_data": op9_personal_data,
    "op10_near_dedup": op10_near_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_repair": op12_repair,
    "op13_mixing": op13_mixing,
}

ORACLES = {
    "op11_fill_in_middle": r"""
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
            FROM documents
        ), numbers AS (
            SELECT doc_id, text, units, len(units) AS n,
                ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS e1, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS e2,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90
                    THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM hashed
        ), parts AS (
            SELECT doc_id, text, n, form,
                array_to_string(units[1:least(e1, e2)], '') AS prefix,
                array_to_string(units[least(e1, e2) + 1:greatest(e1, e2)], '') AS middle,
                array_to_string(units[greatest(e1, e2) + 1:], '') AS suffix
            FROM numbers
        )
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM parts
    """,
    "op6_decontaminate": r"""
        WITH doc_words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), item_words AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n,
                unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS words
            FROM item_words WHERE len(w) > 0
        ), places AS (
            SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS place, w
            FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
        ), found AS (
            SELECT doc_id, place, p.n, item_id FROM places p JOIN windows v
            ON p.n = v.n AND array_to_string(w[place:place + p.n - 1], ' ') = v.words
        ), hit AS (
            SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc_id, unnest(range(place, place + n)) AS pos FROM found) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS items
            FROM found GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op5_exact_dedup": """
        WITH normal AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        SELECT doc_id,
            max(doc_id) OVER same AS keep_id,
            count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept,
            sha256(norm) AS text_sha256
        FROM normal WINDOW same AS (PARTITION BY norm)
    """,
}
