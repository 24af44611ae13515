"""Mixing sources to target weights by pivotal dependent rounding.

A source is to give ``target`` words, a document of it ``target / source_size``
copies on average: the whole part is sure, the fraction is settled by pairs.
Of two documents with fractional copies, words of one are moved to the other,
or the other way round, until one of them has none or all of its copy; the
direction is drawn so that the expected copies of both stay what they were, and
the sum of words is kept exactly. The one that is still fractional meets the
next.

The pairs form a reduction tree: documents are dealt into groups of about
``FAN`` by a hash of what they are, each group is settled but for one document,
and these residuals are dealt into groups again, until every source is one
group. The last document of a source goes to the nearer side, so what a source
gives differs from its target by less than one of its documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Stage, normal

FAN = 64  # documents that meet in one group, on average
FEW = 100_000  # sources up to which their table is broadcast (some 60 bytes each)
SALTS = 32  # parts in which a source meets its row where there are more
BLOCK = 100_000  # repeated rows that one task writes out
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(staged: Stage, sources: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """Of (source, source_size, n_docs): these, number and target. Sources by
    code point, null last, weigh ``weights``, repeated. They share all words
    by weight; what a target has above ``cap`` times its source is shared by
    weight among the others, until none is above."""
    # A number in sorted order without one task for all: ranges first, then
    # the place in the range and the rows of the ranges before.
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last())
    ranged = ranged.sortWithinPartitions(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    part = F.shiftright("at", 33)
    ranged = staged(ranged.withColumns({"part": part, "place": F.col("at") - F.shiftleft(part, 33)}), "ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("rows")).collect()  # one row per range
    before, first = 0, {}
    for row in sorted(sizes, key=lambda r: r["part"]):
        first[row["part"]] = before
        before += row["rows"]
    if not first:
        return sources.select("*", F.lit(0).cast("long").alias("number"), F.lit(0.0).alias("target"))
    offset = F.create_map(*[F.lit(v) for pair in first.items() for v in pair])
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("number", F.lit(len(weights))).cast("int"))
    numbered = ranged.withColumn("number", (F.col("place") + offset[F.col("part")]).cast("long")).withColumn("weight", weight)
    numbered = staged(numbered.select("source", "source_size", "n_docs", "number", "weight"), "numbered")

    # The level at which min(cap * size, level * weight) adds up to all words.
    # Each step closes the sources that the level before took above the cap.
    level = 0.0
    full = F.col("source_size") * float(cap) <= F.lit(level) * F.col("weight")
    while True:
        sums = numbered.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, F.col("source_size") * float(cap)).otherwise(0.0)).alias("closed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not sums["open"]:
            break
        reached = (sums["total"] - sums["closed"]) / sums["open"]
        if reached <= level:
            break
        level = reached
        full = F.col("source_size") * float(cap) <= F.lit(level) * F.col("weight")
    target = F.least(F.col("source_size") * float(cap), F.lit(level) * F.col("weight"))
    return staged(numbered.select("source", "source_size", "n_docs", "number", target.alias("target")), "targets")


def _with_source(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of (source, ...) with their source's row. A few sources are
    broadcast; with more, each source's row is repeated under ``SALTS`` salts,
    so that a source on a third of all rows is no single task's."""
    if targets.count() <= FEW:
        return rows.join(F.broadcast(targets), rows["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    salted = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SALTS)).cast("int"))
    same = rows["source"].eqNullSafe(salted["source"]) & (rows["salt"] == salted["salt"])
    return rows.join(salted, same).drop(salted["source"]).drop("salt")


def _pair(seed: int):
    """One step of a group: the open document (or null) meets the next one."""

    def step(held: Column, new: Column) -> Column:
        old = held["open"]
        to_old = F.least(old["size"] - old["words"], new["words"])  # until old is whole or new is empty
        to_new = F.least(old["words"], new["size"] - new["words"])
        draw = F.pmod(F.xxhash64(F.lit(seed), old["doc_id"], old["h"], old["repeat"], new["doc_id"], new["h"], new["repeat"]), F.lit(1 << 53)) / float(1 << 53)
        up = draw * (to_old + to_new) < to_new
        old_words = F.when(up, old["words"] + to_old).otherwise(old["words"] - to_new)
        new_words = F.when(up, new["words"] - to_old).otherwise(new["words"] + to_new)
        # Which of the two is settled is told by what bounded the move, not by
        # the rounded sum.
        old_settled = F.when(up, to_old == old["size"] - old["words"]).otherwise(to_new == old["words"])
        settled = F.when(old_settled, _entry(old, F.when(up, old["size"].cast("double")).otherwise(0.0))).otherwise(
            _entry(new, F.when(up, 0.0).otherwise(new["size"].cast("double")))
        )
        still = F.when(old_settled, _entry(new, new_words)).otherwise(_entry(old, old_words))
        return F.when(old.isNull(), F.struct(new.alias("open"), held["done"].alias("done"))).otherwise(
            F.struct(still.alias("open"), F.concat(held["done"], F.array(settled)).alias("done"))
        )

    return step


def _entry(of: Column, words: Column) -> Column:
    return F.struct(*(of[c].alias(c) for c in ("size", "doc_id", "h", "repeat")), words.alias("words"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3.0,
    seed: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target,
    copies, taken.

    ``size`` is the number of words of the text, ``source_size`` the words of
    all texts of its source, ``target`` the words that its source shall give,
    ``copies`` how often the document is taken, at most the next whole number
    above ``cap`` and never more than ``cap`` where that is whole, ``taken``
    the words of all copies. The same rows give the same result, however they
    are dealt over partitions.

    A null text has no words; a document without words is taken no time. Rows
    without a source are one source, the last. Null ids are ids like others;
    repeated rows are documents of their own. An empty table gives no rows.
    Other columns are not looked at.
    """
    if not weights or min(weights) <= 0 or cap < 1:
        raise ValueError("weights must be positive, and the cap 1 or more")
    staged = Stage(docs.sparkSession, "mixing")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("h"),
    )
    # Equal rows are counted, so that each of them gets a number that does not
    # depend on where it stands.
    rows = staged(rows.groupBy("source", "doc_id", "size", "h").agg(F.count("*").alias("rows")), "rows")
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("n_docs"))
    targets = source_targets(staged, sources, weights, cap)

    many = rows.where("rows > 1").withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / BLOCK).cast("long"))))
    many = many.repartition("doc_id", "h", "block").withColumn(
        "repeat", F.explode(F.sequence(F.col("block") * BLOCK, F.least(F.col("rows"), (F.col("block") + 1) * BLOCK) - 1))
    )
    columns = ["source", "doc_id", "size", "h", "repeat"]
    single = rows.where("rows = 1").withColumn("repeat", F.lit(0).cast("long"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    full = _with_source(single.select(columns).union(many.select(columns)), targets).withColumn("rate", rate)
    # A rate a hair below a whole number, by rounding only, is that number.
    sure = F.when(F.abs(F.col("rate") - F.round("rate")) < 1e-12, F.round("rate")).otherwise(F.floor("rate")).cast("double")
    full = full.withColumn("sure", sure).withColumn("words", F.col("size") * F.greatest(F.lit(0.0), F.col("rate") - F.col("sure")))
    full = staged(full, "level0")

    keep = ["number", "source", "source_size", "target", "sure"]
    settled = full.where("words = 0").select(*keep, "size", "doc_id", F.lit(0.0).alias("words"))
    work = full.where("words > 0").select(*keep, "n_docs", "size", "doc_id", "h", "repeat", "words")
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    out, level, dealt = [settled], 0, 1
    while True:
        level, dealt = level + 1, dealt * FAN
        group = F.pmod(F.xxhash64(F.lit(seed + level), "doc_id", "h", "repeat"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n_docs") / dealt)))
        # Long documents first: what is open at the end tends to be short.
        members = F.sort_array(F.collect_list(F.struct("size", "h", "repeat", "doc_id", "words")), asc=False)
        grouped = work.groupBy("number", group.alias("group")).agg(
            *(F.first(c).alias(c) for c in [*keep[1:], "n_docs"]), members.alias("members")
        )
        entry = F.transform("members", lambda m: _entry(m, m["words"]))
        start = F.struct(F.lit(None).cast(entry_type(full)).alias("open"), F.array().cast(f"array<{entry_type(full)}>").alias("done"))
        met = staged(grouped.select(*keep, "n_docs", F.aggregate(entry, start, _pair(seed)).alias("met")), f"met{level}")
        out.append(met.select(*keep, F.explode("met.done").alias("e")).select(*keep, "e.size", "e.doc_id", "e.words"))
        work = met.select(*keep, "n_docs", "met.open.*").select(*keep, "n_docs", "size", "doc_id", "h", "repeat", "words")
        if dealt >= most:
            break
    # The one document of each source that is left.
    out.append(work.select(*keep, "size", "doc_id", F.when(F.col("words") * 2 >= F.col("size"), F.col("size").cast("double")).otherwise(0.0).alias("words")))
    result = out[0]
    for part in out[1:]:
        result = result.union(part)
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("sure") + (F.col("words") > 0).cast("int")).cast("long")
    result = result.withColumn("copies", copies)
    return result.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def entry_type(full: DataFrame) -> str:
    doc_id = full.schema["doc_id"].dataType.simpleString()
    return f"struct<size:bigint,doc_id:{doc_id},h:bigint,repeat:bigint,words:double>"
