"""Exact dedup: a tree merge of sorted digest runs.

Every partition of the scan is one run of digests; it is cut into ``RANGES``
ranges of the digest, the same for all runs. In each round ``fan_in``
neighbouring runs meet (the run number loses a digit): the pieces of one range
come together in one task, in order of the digest, and are merged by one pass
over neighbouring entries; the entry of a digest keeps the smallest (or
largest) identifier and the number of rows. An entry is a digest of 256 bits
*with* the byte length and a second, independent hash of 64 bits; only entries
that agree in all three are merged, at every level. After the last round one
run is left, and the decision travels down the same tree.

A digest has one entry in a run, so a task of a round meets at most ``fan_in``
entries of it, however many rows have it; within a run of the scan they are
added up before they are dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Stage, lower_ascii, normal

KEY = ("digest", "n_bytes", "check_hash")
RANGES = 1 << 16  # by the first two bytes of the digest


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = 16
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 (hex), n_bytes, check_hash.

    Texts are equal when identical after lower-casing A-Z only. A null text is
    empty and equals the empty one. A null id ranks below every other. Rows
    that agree in id and text are still rows: each counts in ``group_size``
    and exactly one row of a group is ``kept``. An empty table gives no rows.
    Other columns of ``docs`` are not looked at.
    """
    # The place of a row in the scan is fixed by writing it once; it breaks
    # ties between rows of one id.
    rows = normal(docs, id_col, text_col).withColumn("place", F.monotonically_increasing_id())
    leaf, known = _decided(Stage(docs.sparkSession, "exact-dedup"), rows, keep, fan_in)
    out = leaf.join(known, ["run", *KEY], "left")
    return out.select(
        "doc_id",
        F.when(F.col("total").isNull(), F.col("doc_id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("total", F.lit(1)).cast("long").alias("group_size"),
        (F.col("total").isNull() | (F.col("top.place") == F.col("place"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_bytes",
        "check_hash",
    )


def _decided(staged: Stage, rows: DataFrame, keep: str, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """Of rows (doc_id, text, place): the runs of the leaves, and for each run
    and digest of a group of two or more rows (top, total): the row that stays
    and the size of the group."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be smallest or largest")
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    text = lower_ascii(F.col("text"))
    leaf = rows.select(
        "doc_id",
        F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check_hash"),
        F.spark_partition_id().alias("run"),
        "place",
    )
    leaf = staged(leaf.withColumn("range", F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")), "leaf")

    best = F.min if keep == "smallest" else F.max
    null_rank = F.col("doc_id").isNull() if keep == "smallest" else F.col("doc_id").isNotNull()
    entry = F.struct(null_rank.alias("rank"), F.col("doc_id").alias("id"), F.col("place").alias("place"))
    runs = leaf.agg(F.coalesce(F.max("run"), F.lit(0)) + 1).first()[0]
    # One run's rows of a digest are added up where they are read.
    added = leaf.groupBy("run", "range", *KEY).agg(best(entry).alias("best"), F.count("*").alias("n"))
    levels = [staged(added, "level0")]
    while runs > 1:
        runs = -(-runs // fan_in)
        levels.append(staged(merged(levels[-1], fan_in, best), f"level{len(levels)}"))

    # Down again: only groups of two or more rows have anything to tell.
    known = levels.pop().where("n > 1").select("run", "range", *KEY, F.col("best").alias("top"), F.col("n").alias("total"))
    while levels:
        below = levels.pop()
        up = known.withColumnRenamed("run", "up")
        below = below.withColumn("up", F.floor(F.col("run") / fan_in).cast("int"))
        known = below.join(up, ["up", "range", *KEY]).select("run", "range", *KEY, "top", "total")
    return leaf, staged(known.drop("range"), "known")


def merged(entries: DataFrame, fan_in: int, best) -> DataFrame:
    """One round. The exchange deals pieces (run, range), the sort brings the
    runs of a piece into one order, and the aggregate, whose keys are that
    order, passes over it without another exchange or sort."""
    dealt = entries.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).repartition("run", "range")
    in_order = dealt.sortWithinPartitions("run", "range", *KEY)
    return in_order.groupBy("run", "range", *KEY).agg(best("best").alias("best"), F.sum("n").alias("n"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = 16) -> DataFrame:
    """``docs`` with one row of every group of equal texts, all its columns
    as they were: that of the smallest (or largest) id, and of rows that agree
    in id and text the first of the scan. Rows are told apart by their place,
    so null and repeated ids do no harm. A null text is empty and equals the
    empty one. An empty table gives an empty one; columns of ``docs`` may have
    any names."""
    staged = Stage(docs.sparkSession, "exact-dedup")
    packed = staged(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("place")), "placed")
    text = F.col("doc").getField(text_col)
    rows = packed.select(F.col("doc").getField(id_col).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), "place")
    leaf, known = _decided(staged, rows, keep, fan_in)
    # Only the rows that go are looked up among the documents; where they are
    # few, Spark broadcasts them and no document is shuffled.
    gone = leaf.join(known, ["run", *KEY]).where("place != top.place").select("place")
    return packed.join(staged(gone, "gone"), "place", "left_anti").select("doc.*")
